"""The registered queries: shapes, SQL, and the pipeline stage by stage."""

import hashlib
import re
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
import xxhash
from clickstar.llm import pii, queries, toxicity
from clickstar.llm.common import tokenizer_path
from tokenizers import Tokenizer

from .test_dedup import brute_fingerprint, brute_groups, brute_lines

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_against_sql(spark, name):
    database = duckdb.connect()
    for table in ("documents", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    cursor = database.execute(queries.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    frame = queries.REGISTRY[name](spark, SF)
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(map(str, map(tuple, frame.select(*columns).collect()))) == sorted(map(str, cursor.fetchall()))


def test_all_thirteen_and_the_pipeline_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries.REGISTRY if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in queries.REGISTRY


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{number}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            counts.append(docs.count())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash", "pii", "packing"]
    assert counts[1] < counts[0] and counts[2] == counts[1] and counts[3] < counts[2] and counts[4] == counts[3]
    assert docs.where("start = 0").count() == counts[4]


def test_pipeline_of_odd_rows(spark, odd_docs, no_docs, tmp_path):
    for name, frame in (("odd", odd_docs), ("none", no_docs)):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            path = f"{tmp_path}/{name}{number}"
            stage(spark, frame, SF).write.parquet(path)
            frame = spark.read.parquet(path)
        assert (frame.count() > 0) == (name == "odd")


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    model = toxicity.fit(toxicity.training_rows(read("documents"), read("labels")))
    rows = toxicity.toxicity(toxicity.labelled_rows(read("documents"), read("labels"), held_out=True), model).collect()
    assert sum((r.toxicity >= 0.5) == bool(r.toxic) for r in rows) >= 0.95 * len(rows)


def test_pipeline_against_brute_force(spark):
    """Every stage again, row by row in plain Python, on what the one before left."""
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, spark.read.parquet(f"{SF}/labels.parquet")))
    rows = [tuple(r) for r in docs.collect() if model.score(r.text or "") < 0.5]
    lines = {i: text for i, _, _, text in brute_lines(rows, 5)}
    rows = [(r[0], lines[r[0]], *r[2:]) for r in rows]
    groups = brute_groups([brute_fingerprint(r[1]) for r in rows])
    least = {}
    for row, group in zip(rows, groups, strict=True):
        least[group] = min(least.get(group, row[0]), row[0])
    rows = sorted(r for r in rows if r[0] in set(least.values()))
    net = pii.fit(spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string"))
    want = {}
    for (i, text, *_), model_spans in zip(rows, pii.model_spans(net, [r[1] for r in rows]), strict=True):
        clean = pii.redacted(text, pii.all_spans(text, pii.base_spans(text), model_spans))
        want[i] = [*library.encode(clean, add_special_tokens=False).ids, 1]
    got, places = {}, []
    for r in sorted(corpus_pipeline.run(spark, SF).collect(), key=lambda r: (r.doc_id, r.start)):
        ids = got.setdefault(r.doc_id, [])
        assert r.start == len(ids) and r.doc_tokens == len(want[r.doc_id])
        ids += np.frombuffer(r.ids, "<u4").tolist()
        places += range(r.sequence_id * 2048 + r.offset, r.sequence_id * 2048 + r.offset + r.length)
    assert got == want
    assert sorted(places) == list(range(sum(map(len, want.values()))))


# The contract's columns of each query, from the contract's words alone ------------------------------


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def split(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def test_op1_columns(spark):
    docs = documents(spark)
    got = {r.doc_id: r for r in queries.REGISTRY["op1_simhash"](spark, SF).collect()}
    prints = []
    for doc in docs:
        words = split((doc.text or "").translate({c: c + 32 for c in range(65, 91)}))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    reach = list(range(len(docs)))

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                reach[root(i)] = root(j)
    least = {}
    for i, doc in enumerate(docs):
        least[root(i)] = min(least.get(root(i), doc.doc_id), doc.doc_id)
    assert len(got) == len(docs)
    for i, doc in enumerate(docs):
        assert (got[doc.doc_id].fingerprint, got[doc.doc_id].component_id) == (f"{prints[i]:016x}", least[root(i)])


def test_op2_columns(spark):
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {d.doc_id: [*library.encode(d.text or "", add_special_tokens=False).ids, 1] for d in documents(spark)}
    places, at = [], {i: 0 for i in want}
    for r in sorted(queries.REGISTRY["op2_packing"](spark, SF).collect(), key=lambda r: (r.doc_id, r.start)):
        ids = want[r.doc_id]
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
        at[r.doc_id] += r.length
        assert r.offset + r.length <= 2048
        places += range(r.sequence_id * 2048 + r.offset, r.sequence_id * 2048 + r.offset + r.length)
    assert at == {i: len(ids) for i, ids in want.items()} and sorted(places) == list(range(sum(at.values())))


def test_op3_columns(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=16) * (0.02 + 0.04 * (i % 5))]) for i in range(240)]
    rows += [(300, None), (301, [0.0] * 16), (302, [float("nan")] + [1.0] * 15), (303, [None] + [1.0] * 15), (304, rows[0][1])]
    spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, embedding array<double>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    got = {r.vec_id: r for r in queries.REGISTRY["op3_embedding"](spark, str(tmp_path)).collect()}
    fine = {i: np.array(v) / np.linalg.norm(v) for i, v in rows if i not in (300, 301, 302, 303)}
    links = {i: {j for j in fine if j != i and fine[i] @ fine[j] >= 0.9} for i in fine}
    found = total = 0
    for i, _ in rows:
        r = got[i]
        assert r.n_links <= len(links.get(i, ())) and r.kept == (r.vec_id == r.component_id)
        found, total = found + r.n_links, total + len(links.get(i, ()))
    assert total > 500 and found >= 0.95 * total
    assert all(got[i].n_links == 0 and got[i].kept for i in (300, 301, 302, 303)) and got[304].component_id == got[0].component_id


def test_op6_columns(spark):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    got = {r.doc_id: tuple(r)[1:] for r in queries.REGISTRY["op6_bpe"](spark, SF).collect()}
    for doc in documents(spark):
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        assert got[doc.doc_id] == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_op7_columns(spark):
    rows = queries.REGISTRY["op7_toxicity"](spark, SF).collect()
    assert len(rows) == len(documents(spark))
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_op8_columns(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.REGISTRY["op8_substring"](spark, SF).collect()}
    seen = set()
    for doc in sorted(documents(spark), key=lambda d: d.doc_id):
        words = split(doc.text)
        gone = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert got[doc.doc_id] == (len(words), len(gone), sha(kept))


def test_op10_columns(spark):
    got = {r.doc_id: r for r in queries.REGISTRY["op10_pii"](spark, SF).collect()}

    def luhn(digits):
        twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return sum(d - 9 * (d > 9) for d in twice) % 10 == 0

    digits = lambda s: re.sub("[^0-9]", "", s)
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    }
    for doc in documents(spark):
        spans = {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, doc.text or "") if fits(m[0])] for k, (p, fits) in kinds.items()}
        base = [s for k in kinds for s in spans[k]]
        r = got[doc.doc_id]
        assert r.base_sha256 == sha(",".join(base)) and set(base) <= set(r.spans.split(",") if r.spans else [])
        counts = [sum(s.startswith(k) for s in r.spans.split(",")) for k in kinds]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts


def test_op9_columns(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.REGISTRY["op9_html"](spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text) and r.text == " ".join(r.text.split())
