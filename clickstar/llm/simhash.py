"""Near-duplicate documents by SimHash, found with deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_ids, text_bytes, word_blocks, written
from .graph import components

SHINGLE_WORDS = 3
MAX_BITS = 2
# Fingerprints that share a signature are compared directly up to this group size; larger groups
# take the signatures with two wildcards, where a group has four members at most.
PAIR_GROUP = 256


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the word shingles, repeats included; 0 without words."""
    counts, total, rest, short = np.zeros(64, np.int64), 0, [], True
    for words in word_blocks(text.lower()):
        words = rest + words
        if len(words) < shingle_words:
            rest = words
            continue
        short, rest = False, words[len(words) - shingle_words + 1 :] if shingle_words > 1 else []
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate(([0], ends[:-1])).tolist()
        digest, seed = xxhash.xxh64_intdigest, 42
        hashes = np.array(
            [digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle_words - 1 :] - 1).tolist(), strict=False)],
            np.uint64,
        )
        total += len(hashes)
        for i in range(0, len(hashes), 8192):
            part = hashes[i : i + 8192].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if short:
        return xxhash.xxh64_intdigest(b" ".join(rest), 42) if rest else 0
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of each row, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle_words) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64), pa.int64())], names=["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("t")).mapInArrow(
        run, "doc_id bigint, fp bigint"
    )


def links(distinct: DataFrame, pair_group: int = PAIR_GROUP) -> DataFrame:
    """(a, b): edges that connect all fingerprints (``fp``, distinct) at two or fewer differing bits.

    Two such fingerprints have a half of 32 bits that differs in one bit at most, so they share one
    of 64 signatures: a half with one bit struck out.  Rows with a common signature are verified by
    their bit count; a pair is taken from one signature only.  Where a signature is common to more
    than ``pair_group`` fingerprints, these get all 2,016 signatures with two bits of the whole
    struck out: equal ones are links without a check, and a group has four members at most.
    """
    slots = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("slot"))
    signed = slots.select(
        "fp", F.expr(
            "(cast(slot as bigint) << 32) | "
            "((CASE WHEN slot < 32 THEN fp ELSE shiftrightunsigned(fp, 32) END) & 4294967295L & ~(1L << (slot % 32)))"
        ).alias("key"),
    )
    shared = written(signed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "signatures")
    # Keys grow with the corpus: shuffled at every size, so that AQE can split a hot one.
    hits = written(signed.join(shared.hint("merge"), "key"), "signature_rows")
    few = hits.where(F.col("n") <= pair_group)
    one, two = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    low, slot = "((a ^ b) & 4294967295L)", "(key >> 32)"
    pairs = one.join(two, "key").where(
        f"a < b AND bit_count(a ^ b) <= {MAX_BITS} AND ("
        f"{slot} < 32 AND ({low} = 0 AND {slot} = 0 OR {low} = (1L << cast({slot} as int)))"
        f" OR {slot} = 32 AND bit_count({low}) = 2)"
    ).select("a", "b")

    masks = [(1 << i | 1 << j) - (1 << 64 if j == 63 else 0) for j in range(64) for i in range(j)]
    many = hits.where(F.col("n") > pair_group).select("fp").distinct()
    wild = many.select("fp", F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks])).alias("mask"))
    # ``low_bit`` is the lower struck bit; which of the four members exist is kept as four flags.
    groups = wild.selectExpr(
        "mask", "fp & ~mask AS rest", "mask & -mask AS low_bit", "fp",
    ).selectExpr(
        "mask", "rest",
        "1 << (CASE WHEN fp & low_bit <> 0 THEN 1 ELSE 0 END + CASE WHEN fp & (mask ^ low_bit) <> 0 THEN 2 ELSE 0 END) AS flag",
    ).groupBy("mask", "rest").agg(F.bit_or("flag").alias("flags")).where("bit_count(flags) > 1")
    members = groups.selectExpr(
        "transform(filter(array(0, 1, 2, 3), c -> getbit(flags, c) = 1), c -> rest"
        " | (CASE WHEN getbit(c, 0) = 1 THEN mask & -mask ELSE 0L END)"
        " | (CASE WHEN getbit(c, 1) = 1 THEN mask ^ (mask & -mask) ELSE 0L END)) AS m"
    )
    stars = members.select(F.col("m")[0].alias("a"), F.explode(F.expr("slice(m, 2, 3)")).alias("b"))
    return pairs.union(stars)


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, pair_group: int = PAIR_GROUP) -> DataFrame:
    """(doc_id, fp, component_id) of each row of ``docs`` (doc_id, text).

    Rows belong together if a chain of fingerprints with two or fewer differing bits connects them;
    component_id is the smallest doc_id of the group.  Null and empty texts have fingerprint 0 and
    are linked like any other; so are repeated rows.  A row without doc_id keeps its group together;
    component_id is null if no row of the group has an id.  Other columns are ignored.  An empty
    table gives an empty one.
    """
    prints = written(fingerprints(docs, shingle_words), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    roots = written(components(links(classes.select("fp"), pair_group)), "roots")
    linked = classes.join(roots, classes["fp"] == roots["node"]).select("fp", "root", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("least_id"))
    found = linked.join(least, "root").select(F.col("fp").alias("node"), "least_id")
    by_print = written(
        classes.join(found, classes["fp"] == found["node"], "left")
        .select("fp", F.coalesce("least_id", "first_id").alias("component_id")), "components",
    )
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def simhash_dedup(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each group of :func:`simhash_groups`, that of the smallest doc_id.

    All columns stay.  Of rows that repeat the kept doc_id one stays: one whose text is smallest.
    Rows without doc_id stay, since no id decides between them.
    """
    groups = simhash_groups(docs, shingle_words)
    decided = written(groups.where("doc_id = component_id"), "kept")
    kept = keep_ids(docs, decided.select("doc_id").distinct(), "doc_id")
    without = docs.where("doc_id IS NULL")
    repeated = written(decided.groupBy("doc_id").count().where("count > 1"), "repeated")
    if repeated.isEmpty():
        return kept.union(without)
    again = keep_ids(kept, repeated, "doc_id")
    one = again.groupBy("doc_id").agg(
        F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("__llm_row")
    ).select("__llm_row.*")
    return keep_ids(kept, repeated, "doc_id", "left_anti").union(one).union(without)
