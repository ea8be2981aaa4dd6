"""Repeated passages: documents are parsed against a reference of all earlier text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, text_bytes, word_blocks, written

# Words of a window, and words of the grams of which each window names its smallest.
WINDOW = 20
GRAM = 5
# Odd multipliers of the rolling hashes.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
NO_ID = -(1 << 63)
# Windows are looked up in this many parts by their hash, so that only one part is in shuffles at a time.
ROUNDS = 4


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def _rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash of each run of ``size`` word hashes, modulo 2**64."""
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for j, power in enumerate(_powers(base, size)):
        total += hashes[j : j + len(total)] * power
    total ^= total >> np.uint64(33)
    total *= _MIX
    total ^= total >> np.uint64(29)
    return total


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.uint64).reshape(-1, 2)


def hashed_blocks(text: bytes, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index of the first word, hashes): each block begins with the last words of the one before,
    so that every window is whole in one block, and in one only."""
    first, rest = 0, np.zeros((0, 2), np.uint64)
    for words in word_blocks(text):
        hashes = np.concatenate((rest, word_hashes(words)))
        if len(hashes) < window:
            rest = hashes
            continue
        yield first, hashes
        first += len(hashes) - window + 1
        rest = hashes[len(hashes) - window + 1 :]


def grams_and_anchors(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each gram, and of each window the smallest of its grams, its anchor."""
    grams = _rolling(hashes[:, 0], gram, _BASES[0])
    least, width, span = grams, 1, window - gram + 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return grams, least


def document_anchors(text: bytes, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Anchors of all windows; one that has several places in the document is given twice."""
    anchors, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    kept = []
    for first, hashes in hashed_blocks(text, window):
        grams, least = grams_and_anchors(hashes, window, gram)
        changes = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        anchors.append(least[changes])
        # Grams at the start of a later block were seen at the end of the one before.
        kept.append(grams if not first else grams[window - gram :])
    known = np.unique(np.concatenate(anchors))
    if not len(known):
        return known
    for grams in kept:
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        places.append(known[at[known[at] == grams]])
    values, counts = np.unique(np.concatenate(places), return_counts=True)
    return np.concatenate((known, values[counts > 1]))


def summaries(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(id, text_key, doc_id, n_words, words_key, words_sha256, anchors) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, sha, anchors = [], [], []
            for text in batch.column(2):
                text, digest, n = text.as_py(), hashlib.sha256(), 0
                for words in word_blocks(text):
                    if words:
                        digest.update((b" " if n else b"") + b" ".join(words))
                        n += len(words)
                sizes.append(n)
                sha.append(digest.digest())
                anchors.append(document_anchors(text, window, gram).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sha, pa.binary()), pa.array(anchors, pa.binary())],
                names=["doc_id", "text_key", "n_words", "words_sha256", "anchors"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), text_bytes().alias("t")
    ).mapInArrow(run, "doc_id bigint, text_key bigint, n_words bigint, words_sha256 binary, anchors binary").withColumn(
        "id", F.coalesce("doc_id", F.lit(NO_ID))
    )


def _unpacked(rows: DataFrame) -> DataFrame:
    """(anchor, id, text_key) of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [np.frombuffer(a, np.int64) for a in batch.column(2).to_pylist()]
            sizes = [len(m) for m in made]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*made, np.zeros(0, np.int64)])), *(
                    pa.array(np.repeat(batch.column(i).to_numpy(), sizes)) for i in (0, 1)
                )], names=["anchor", "id", "text_key"],
            )

    return rows.select("id", "text_key", "anchors").mapInArrow(run, "anchor bigint, id bigint, text_key bigint")


def _windows(held: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, key2, id, text_key, start): the windows whose anchor is among ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (doc, text_key, text, anchors) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                wanted = np.sort(np.array(anchors, np.int64).view(np.uint64))
                for first, hashes in hashed_blocks(text, window):
                    least = grams_and_anchors(hashes, window, gram)[1]
                    at = np.minimum(np.searchsorted(wanted, least), len(wanted) - 1)
                    found = np.flatnonzero(wanted[at] == least)
                    if len(found):
                        keys = [_rolling(hashes[:, j], window, _BASES[j])[found].view(np.int64) for j in (0, 1)]
                        yield pa.RecordBatch.from_arrays(
                            [*map(pa.array, keys), pa.array(np.full(len(found), doc)), pa.array(np.full(len(found), text_key)),
                             pa.array(found + first)], names=["key", "key2", "id", "text_key", "start"],
                        )

    return held.select("id", "text_key", "t", "anchors").mapInArrow(
        run, "key bigint, key2 bigint, id bigint, text_key bigint, start bigint"
    )


def parse(starts: np.ndarray, sources: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors of a document: which windows begin one, and how many windows each has.

    ``starts`` are the windows that the reference holds, in order; ``sources`` (id, text_key, start)
    their places there.  A factor goes on while the next window follows in the document and in its
    source; where it ends the next window, also one across the boundary, begins a factor of its own.
    """
    follows = (np.diff(starts) == 1) & (np.diff(sources[:2]) == 0).all(axis=0) & (np.diff(sources[2]) == 1)
    begins = np.flatnonzero(np.concatenate(([True], ~follows)))
    return begins, np.diff(np.append(begins, len(starts)))


def words_left(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The words outside of ``spans`` (begin, end; sorted, may overlap), joined, and the count inside."""
    left, gone, at, next_span = [], 0, 0, 0
    for words in word_blocks(text):
        keep, end = np.ones(len(words), bool), at + len(words)
        while next_span < len(spans) and spans[next_span][0] < end:
            keep[max(spans[next_span][0] - at, 0) : max(spans[next_span][1] - at, 0)] = False
            if spans[next_span][1] > end:
                break
            next_span += 1
        gone += int((~keep).sum())
        left.extend(compress(words, keep))
        at = end
    return b" ".join(left), gone


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Which words of each document (doc_id, text) stand in passages that occur earlier.

    Words are what ASCII white space separates.  A word goes if one of the windows of ``window``
    words that cover it also starts earlier: at a smaller doc_id, or earlier in the document.

    The reference is the first place of each window, in an index that is spread over the cluster by
    the window's hash and made part by part.  Only windows whose anchor (smallest hash of a gram, the same for equal
    windows) has a second place anywhere are looked up.  Each document is then parsed greedily into
    factors against all parts of the index; windows across factor boundaries are looked up as well,
    so every repeated one is found.  Documents with the same words as an earlier one are settled
    beforehand by their digest.  Windows are compared by 128 bits of hash.

    One row per row: doc_id, n_words, n_removed, kept (text of the words left, null if all or none
    go), words_sha256 (of all words joined by blanks), factors (array of start, n_windows, source_id,
    source_start; null for whole copies).  Null and empty texts have no words.  Rows that repeat a
    doc_id and a text are one document; rows of one doc_id with different texts are ordered by a
    hash of the text; rows without doc_id come before all others.  Other columns are ignored.
    """
    known = written(summaries(docs, window, gram), "summaries")
    light = written(known.select("id", "text_key", "doc_id", "n_words", "words_sha256"), "documents")
    first = written(
        light.where(F.col("n_words") >= window).groupBy("words_sha256").agg(
            F.min(F.struct("id", "text_key")).alias("first"), F.count(F.lit(1)).alias("n")
        ).where("n > 1").select("words_sha256", "first"), "first_copies",
    )
    copies = written(
        light.join(first, "words_sha256").where(F.struct("id", "text_key") != F.col("first")).select("id", "text_key").distinct(),
        "copies",
    )
    anchors = _unpacked(known.join(copies, ["id", "text_key"], "left_anti"))
    shared = written(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "shared")
    of_doc = written(
        # The index grows with the corpus: shuffled at every size, so that AQE can split hot anchors.
        anchors.join(shared.hint("merge"), "anchor").groupBy("id", "text_key").agg(F.collect_set("anchor").alias("anchors")),
        "anchors_of_documents",
    )
    freed(known, shared)
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("text_key"),
        text_bytes().alias("t"),
    )
    held = written(texts.join(of_doc.hint("merge"), ["id", "text_key"]), "parsed")
    windows = written(_windows(held, window, gram), "windows")
    place = F.struct("id", "text_key", "start")
    rounds = []
    for part in range(ROUNDS):
        some = windows.where(F.pmod("key", F.lit(ROUNDS)) == part)
        reference = written(
            some.groupBy("key", "key2").agg(F.min(place).alias("source"), F.max(place).alias("last"))
            .where("source <> last").select("key", "key2", "source"), "reference",
        )
        rounds.append(written(
            some.join(reference.hint("merge"), ["key", "key2"]).where(place != F.col("source"))
            .select("id", "text_key", "start", "source"), "hits",
        ))
        freed(reference)
    freed(windows)
    found = written(
        reduce(DataFrame.unionByName, rounds).groupBy("id", "text_key")
        .agg(F.collect_set(F.struct("start", "source")).alias("hits")), "found",
    )
    freed(*rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "text_key", "gone", "left", "factors"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct(
            [(n, pa.int64()) for n in ("start", "n_windows", "source_id", "source_start")]
        ))]
        for batch in batches:
            rows = []
            flat = batch.column(3).flatten()
            source = flat.field("source")
            all_starts = flat.field("start").to_numpy()
            all_sources = np.array([source.field(n).to_numpy() for n in ("id", "text_key", "start")])
            ends = np.cumsum(batch.column(3).value_lengths().to_numpy())
            for i, (doc, text_key, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)):
                part = slice(ends[i - 1] if i else 0, ends[i])
                order = np.argsort(all_starts[part])
                starts, sources = all_starts[part][order], all_sources[:, part][:, order]
                begins, sizes = parse(starts, sources)
                firsts = starts[begins].tolist()
                left, gone = words_left(text, [(f, f + n + window - 1) for f, n in zip(firsts, sizes.tolist(), strict=True)])
                columns = (firsts, sizes.tolist(), sources[0, begins].tolist(), sources[2, begins].tolist())
                rows.append((doc, text_key, gone, left.decode(), [
                    dict(zip(("start", "n_windows", "source_id", "source_start"), f, strict=True))
                    for f in zip(*columns, strict=True)
                ]))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    parsed = written(
        held.select("id", "text_key", "t").dropDuplicates(["id", "text_key"]).join(found.hint("merge"), ["id", "text_key"])
        .select("id", "text_key", "t", "hits").mapInArrow(
            run, "id bigint, text_key bigint, gone bigint, left string, "
            "factors array<struct<start: bigint, n_windows: bigint, source_id: bigint, source_start: bigint>>"
        ), "factors",
    )
    copies = copies.withColumn("copy", F.lit(True))
    return light.join(copies, ["id", "text_key"], "left").join(parsed, ["id", "text_key"], "left").select(
        "doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.col("left").alias("kept"), "words_sha256", "factors",
    )
