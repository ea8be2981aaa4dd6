"""Periodic runs against a search of every period, and the query's digests against plain Python."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from clickstar.llm import periodic, queries

SF = "/root/testdata/sf0.001"
BLANK = re.compile("[\x20\x09-\x0d]+")


def split(text):
    return [w for w in BLANK.split(text or "") if w]


def brute_runs(words, min_length=6, min_exponent=4):
    found = []
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            stretch = words[start : start + length]
            if i > start and length >= max(min_length, min_exponent * q) and not any(
                stretch[p:] == stretch[: length - p] for p in range(1, q)
            ):
                found.append((start, length, q))
            i += i == start
    return sorted(found)


def brute_kept(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (7, 3)])
@pytest.mark.parametrize("size", [2, 1_024])
def test_runs_of_random_words(monkeypatch, limits, size):
    monkeypatch.setattr(periodic, "PLACES", size)
    rng = random.Random(size + limits[0])
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < 0.6:
                a = rng.randrange(len(words))
                p = 1 + (len(words) - a) // rng.randint(3, 10)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
            docs.append(words)
        sizes = [len(w) for w in docs]
        got = periodic.find_runs(
            np.array(sum(docs, []), np.int64), np.repeat(np.arange(len(docs)), sizes), *limits
        ).tolist()
        begin = np.cumsum(sizes) - sizes
        want = [[int(b) + s, n, q] for b, w in zip(begin, docs, strict=True) for s, n, q in brute_runs(w, *limits)]
        assert got == sorted(want)


def test_long_runs_take_no_quadratic_time():
    began = time.perf_counter()
    for words, want in ((np.zeros(200_000, np.int64), [[0, 200_000, 1]]), (np.arange(200_000) % 5_000, [[0, 200_000, 5_000]])):
        assert periodic.find_runs(words, np.zeros(len(words), np.int64), 6, 4).tolist() == want
    assert time.perf_counter() - began < 30


def test_a_key_shared_by_two_grams_adds_no_run(monkeypatch):
    """Every place counts as repeated, as if all hashes were equal."""
    words = np.array([1, 2, 1, 2, 1, 2, 1, 2, 3, 4, 5, 5, 5, 5, 5, 5, 6, 7, 8, 9, 10], np.int64)
    want = periodic.find_runs(words, np.zeros(len(words), np.int64), 6, 4).tolist()
    monkeypatch.setattr(periodic, "_repeated", lambda words, doc, gram: np.arange(len(words) - gram + 1))
    assert periodic.find_runs(words, np.zeros(len(words), np.int64), 6, 4).tolist() == want == [[0, 8, 2], [10, 6, 1]]


def test_odd_rows(spark, odd_docs, no_docs, odd_rows):
    loops = "a b " * 9 + "tail " + "x " * 40_000 + "é  " * 8
    extra = [(90, loops, *[None] * (len(odd_rows[0]) - 2)), (91, "x\n" * 5, *odd_rows[0][2:])]
    docs = odd_docs.union(spark.createDataFrame(extra, odd_docs.schema))
    want = []
    for doc_id, text, *_ in [*odd_rows, *extra]:
        words = split(text)
        # The long loop is known; the search of every period would take too long there.
        runs = [(0, 18, 2), (19, 40_000, 1), (40_019, 8, 1)] if doc_id == 90 else brute_runs(words)
        want.append((doc_id, len(words), runs, brute_kept(words, runs)))
    rows = periodic.periodic_runs(docs).collect()
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.kept) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(no_docs).collect() == []
    assert queries.with_periods(no_docs).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs, min_exponent=1)


def test_blocks_of_long_texts(spark, monkeypatch):
    text = " ".join(f"w{i % 700} v{i % 31}" for i in range(6_000)) + " end" * 9
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    whole = periodic.periodic_runs(docs).collect()
    rows = [(1, text)]
    batch = periodic._Batch(6, 4)
    monkeypatch.setattr("clickstar.llm.common.BLOCK_BYTES", 1_000)
    for doc_id, text in rows:
        batch.add(doc_id, text.encode())
    small = next(iter(batch.rows())).to_pylist()
    assert [(r.n_words, [x.asDict() for x in r.runs], r.kept) for r in whole] == [
        (r["n_words"], r["runs"], r["kept"]) for r in small
    ]


def test_query_against_plain_python(spark):
    rows = {r.doc_id: r for r in queries.REGISTRY["op11_periodic_runs"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        words = split(doc.text)
        h = zlib.crc32(str(doc.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3_000:
            continue
        runs, got = brute_runs(words), rows[doc.doc_id]
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        assert (got.n_runs, got.start, got.length, got.period) == (len(runs), *best)
        assert got.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert got.runs_sha256 == sha("".join("%d,%d,%d\n" % r for r in runs))
        assert got.collapsed_sha256 == sha(brute_kept(words, runs))
