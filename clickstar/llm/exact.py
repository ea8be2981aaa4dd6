"""Exact duplicates: frequent digests are split off and settled map-side, the others by shuffle."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, written

# Counters of a Misra-Gries summary.  A digest of more than 2 / (COUNTERS + 1) of all rows is
# certain to be split off; no more than COUNTERS + 1 digests can be.
COUNTERS = 1023


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, row, digest): SHA-256 of the text with A-Z lower-cased; row numbers the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # lower() of bytes changes A-Z only.
            made = [hashlib.sha256(t.as_py().lower()).digest() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(made, pa.binary())], names=["doc_id", "row", "digest"]
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        text_bytes().alias("t"),
    ).mapInArrow(run, "doc_id bigint, row bigint, digest binary")


def misra_gries(keys: Iterator[bytes], counters: int) -> dict[bytes, int]:
    """At most ``counters`` keys; a count is too low by at most rows / (counters + 1)."""
    held: dict[bytes, int] = {}
    for key in keys:
        if key in held or len(held) < counters:
            held[key] = held.get(key, 0) + 1
        else:
            # All counters and the new key give up one; as many rows were counted before, so this
            # costs a constant time per row.
            held = {k: n - 1 for k, n in held.items() if n > 1}
    return held


def frequent(rows: DataFrame, total: int, counters: int = COUNTERS) -> DataFrame:
    """Candidates (digest): every digest with more than 2 / (counters + 1) of ``total`` rows.

    Summaries of the partitions are merged by adding up; counts of a digest are then too low by at
    most total / (counters + 1), so those that reach this sum hold all that are wanted, and there
    are at most counters + 1 of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = misra_gries((key for batch in batches for key in batch.column(0).to_pylist()), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["digest", "n"]
        )

    summaries = rows.select("digest").mapInArrow(run, "digest binary, n bigint")
    return summaries.groupBy("digest").agg(F.sum("n").alias("n")).where(
        F.col("n") >= max(2.0, total / (counters + 1))
    ).select("digest")


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, row, keep_id, group_size, kept, digest) of each row of ``docs`` (doc_id, text).

    Texts are equal if they are identical after lower-casing A-Z; null counts as empty.  Of equal
    texts the row with the largest doc_id stays; of rows that repeat this doc_id the last read.  A
    row without doc_id stays only if no equal row has one; keep_id is null then.  Other columns are
    ignored.  An empty table gives an empty one.
    """
    rows = written(digests(docs), "digests")
    total = rows.count()
    heavy = frequent(rows, total, counters)
    winner = [F.max(F.struct("doc_id", "row")).alias("best"), F.count(F.lit(1)).alias("group_size")]
    # Exact winners of the candidates, found before the broadcast: at most ``counters`` + 1 rows.
    winners = written(rows.join(F.broadcast(heavy), "digest").groupBy("digest").agg(*winner), "winners")
    settled = rows.join(F.broadcast(winners), "digest")
    others = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = written(others.groupBy("digest").agg(*winner), "groups")
    return settled.unionByName(others.join(groups, "digest")).select(
        "doc_id", "row", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), "digest",
    )
