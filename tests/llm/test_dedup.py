"""SimHash, exact, line and passage duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from clickstar.llm import exact, graph, lines, simhash, substring

from .conftest import words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    found = WORD.findall((text or "").encode().lower())
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(found[i : i + 3]), 42) for i in range(max(1, len(found) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def test_fingerprint_of_blocks(monkeypatch):
    from clickstar.llm import common

    texts = [words(i, n) for i, n in enumerate((0, 1, 2, 3, 50, 400))] + ["A b\x0bC\x1cD", "x" * 900]
    monkeypatch.setattr(common, "BLOCK_BYTES", 64)
    for text in texts:
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("pair_group", [0, 256])
def test_links_connect_what_differs_in_two_bits(spark, pair_group):
    rng = random.Random(4)
    prints = {0}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.choice((0, 1, 2, 2, 3)))))
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint"), pair_group)
    rows = edges.collect()
    assert all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in rows)
    roots = {r.node: r.root for r in graph.components(edges).collect()}
    got = Counter(roots.get(p, p) for p in signed)
    want = Counter(brute_groups(prints))
    assert sorted(got.values()) == sorted(want.values())


def test_simhash_groups_of_odd_rows(odd_docs, no_docs, odd_rows):
    prints = [brute_fingerprint(r[1]) for r in odd_rows]
    groups = brute_groups(prints)
    least = {}
    for row, group in zip(odd_rows, groups, strict=True):
        if row[0] is not None:
            least[group] = min(least.get(group, row[0]), row[0])
    want = Counter((r[0], p, least.get(g)) for r, p, g in zip(odd_rows, prints, groups, strict=True))
    got = Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in simhash.simhash_groups(odd_docs).collect())
    assert got == want
    assert simhash.simhash_groups(no_docs).count() == 0
    kept = simhash.simhash_dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter(set(least.values())) + Counter({None: 2})


def test_components_of_paths_and_stars(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (3, 9), (9, 3)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]} | {3: 3, 9: 3}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("counters", [2, 1023])
def test_exact_groups(odd_docs, no_docs, odd_rows, counters):
    key = lambda t: hashlib.sha256((t or "").encode().lower()).digest()
    by_text = {}
    for row in odd_rows:
        by_text.setdefault(key(row[1]), []).append(row[0])
    best = {k: max((i for i in ids if i is not None), default=None) for k, ids in by_text.items()}
    got = exact.exact_groups(odd_docs, counters).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, bytes(r.digest)) for r in got) == Counter(
        (r[0], best[key(r[1])], len(by_text[key(r[1])]), key(r[1])) for r in odd_rows
    )
    kept = [r for r in got if r.kept]
    assert len(kept) == len(by_text) and all(r.doc_id == r.keep_id for r in kept)
    assert exact.exact_groups(no_docs).count() == 0


def test_misra_gries_holds_the_frequent():
    rng = random.Random(2)
    keys = [b"hot"] * 400 + [b"warm"] * 150 + [str(i).encode() for i in range(600)]
    rng.shuffle(keys)
    held = exact.misra_gries(iter(keys), 9)
    assert len(held) <= 9
    true = Counter(keys)
    assert {b"hot", b"warm"} <= set(held)
    assert all(true[k] - len(keys) / 10 <= n <= true[k] for k, n in held.items())


def brute_lines(rows, min_sites, short_chars=20, short_sites=10):
    sites, first = {}, {}
    strip = " \t\r\x0b\x0c"
    for i, text, _, site, *_ in rows:
        if i is not None:
            for pos, line in enumerate((text or "").split("\n")):
                key = line.strip(strip)
                if key:
                    sites.setdefault(key, set()).update({site} - {None})
                    first[key] = min(first.get(key, (i, pos)), (i, pos))
    bad = {k for k, s in sites.items() if len(s) >= (short_sites if len(k) < short_chars else min_sites)}
    out = []
    for i, text, *_ in rows:
        parts = (text or "").split("\n")
        left = [p for pos, p in enumerate(parts) if i is None or p.strip(strip) not in bad or first[p.strip(strip)] == (i, pos)]
        out.append((i, len(parts), len(parts) - len(left), None if text is None else "\n".join(left)))
    return Counter(out)


def test_line_dedup(spark, odd_docs, no_docs, odd_rows, odd_schema):
    rng = random.Random(8)
    pool = [words(100 + i, rng.choice((2, 4, 8))) for i in range(25)]
    rows = list(odd_rows)
    for i in range(60):
        text = "\n".join(rng.choice(pool) + rng.choice(["", " ", "\r"]) if rng.random() < 0.8 else words(500 + i, 9) for _ in range(8))
        rows.append((1000 + i, text, "en", f"s{rng.randrange(9)}", len(text), *[0] * 13))
    docs = spark.createDataFrame(rows, odd_schema).repartition(3)
    out = lines.dedup_lines(docs, min_sites=6, short_chars=12, short_sites=8)
    assert out.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    got = out.collect()
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == brute_lines(rows, 6, 12, 8)
    assert all(r.text is None or r.n_chars == len(r.text) for r in got)
    assert sum(r.n_removed for r in got) > 20
    assert lines.dedup_lines(no_docs).count() == 0


def brute_passages(rows, window):
    order = sorted({(-(1 << 63) if r[0] is None else r[0], r[1] or "") for r in rows})
    seen, out = set(), {}
    for i, text in order:
        found = WORD.findall(text.encode())
        gone = [False] * len(found)
        for s in range(len(found) - window + 1):
            key = tuple(found[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        out[i, text] = (len(found), sum(gone), b" ".join(w for w, g in zip(found, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("block", [1 << 21, 300])
def test_repeated_passages(spark, odd_rows, odd_schema, no_docs, monkeypatch, block):
    from clickstar.llm import common

    rng = random.Random(9)
    passage = [words(700 + i, 30).split() for i in range(6)]
    rows = [r for r in odd_rows if r[0] not in (9,)]
    for i in range(40):
        text = []
        for _ in range(rng.randrange(1, 5)):
            part = list(rng.choice(passage))
            if rng.random() < 0.4:
                part[rng.randrange(len(part))] = "edited"
            text += words(rng.randrange(10**6), rng.randrange(0, 15)).split() + part[rng.randrange(6) :]
        if rng.random() < 0.2:
            text += ["la"] * 45
        rows.append((2000 + i, " ".join(text), "en", "s1", 0, *[0] * 13))
    rows += [(2100, rows[-1][1], "en", "s1", 0, *[0] * 13)] * 2
    monkeypatch.setattr(common, "BLOCK_BYTES", block)
    docs = spark.createDataFrame(rows, odd_schema).repartition(3)
    want = brute_passages(rows, 20)
    got = substring.repeated_passages(docs).collect()
    assert len(got) == len(rows)
    by_id = {(-(1 << 63) if r[0] is None else r[0]): r[1] or "" for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is None:
            continue
        n, gone, left = want[r.doc_id, by_id[r.doc_id]]
        assert (r.n_words, r.n_removed) == (n, gone), r.doc_id
        if 0 < gone < n:
            assert r.kept.encode() == left
        covered = set()
        for f in r.factors or ():
            covered |= set(range(f.start, f.start + f.n_windows + 19))
            span = WORD.findall(by_id[r.doc_id].encode())[f.start : f.start + f.n_windows + 19]
            if f.source_id in by_id:
                assert WORD.findall(by_id[f.source_id].encode())[f.source_start : f.source_start + f.n_windows + 19] == span
        assert r.factors is None or len(covered) == gone
    assert substring.repeated_passages(no_docs).count() == 0


def test_windows_are_looked_up_part_by_part(spark, monkeypatch):
    docs = spark.createDataFrame([(i, words(i % 7, 90) + " " + words(50 + i, 30)) for i in range(21)], "doc_id bigint, text string")
    kept, written = [], substring.written
    monkeypatch.setattr(substring, "written", lambda df, name: kept.append((name, df.count())) or written(df, name))
    key = lambda r: (r["doc_id"], r["n_words"], r["n_removed"], r["kept"])
    got = sorted(map(key, substring.repeated_passages(docs).collect()))
    sizes = [n for name, n in kept if name == "reference"]
    assert len(sizes) == substring.ROUNDS and max(sizes) < sum(sizes) / 2 and sum(r[2] for r in got) >= 14 * 90
    monkeypatch.setattr(substring, "ROUNDS", 1)
    assert sorted(map(key, substring.repeated_passages(docs).collect())) == got
