"""State that lives in tables instead of operator memory.

Every micro-batch is reduced to a small delta that merges associatively, and written to a folder
named after the query and the batch.  A replayed batch counts once; a new checkpoint is a new query and
adds to what others left.  Folders are merged level by level (:mod:`.levels`), so readers merge few of
them after however many batches; state never has to be rewritten as a whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.candidates import MAX_URLS, product_sightings
from ..operators.failures import ledger_delta, ledger_view, merge_ledger
from ..operators.first_n import first_n
from ..operators.increment import increment_table
from ..session import table_exists
from .levels import FAN, Levels


def _run(stream: DataFrame, checkpoint: str, each_batch: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_deltas(
    stream: DataFrame, table: str, checkpoint: str, reduce: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame], fan: int = FAN,
) -> None:
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        Levels(spark, table, merge, fan).add(reduce(batch), query_id(spark, checkpoint), batch_id)

    _run(stream, checkpoint, each_batch)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query that owns a checkpoint; Spark notes it there when the query first starts."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def compact_deltas(spark: SparkSession, table: str, merge: Callable[[DataFrame], DataFrame], target: str) -> None:
    """Write the merged state as the first delta of a new table."""
    merge(Levels(spark, table, merge).read()).write.parquet(f"{target}/query_id=compacted/batch_id=-1")


# First N URLs per product across runs -------------------------------------------------------


def stream_candidates(events: DataFrame, table: str, checkpoint: str, n: int = MAX_URLS, order: str = "_id") -> None:
    """Each batch adds at most ``n`` URLs per product; more cannot enter the overall first ``n``."""

    merge = _first_urls(n, order)
    stream_deltas(events, table, checkpoint, lambda batch: merge(product_sightings(batch, order)), merge)


def _first_urls(n: int, order: str) -> Callable[[DataFrame], DataFrame]:
    return lambda seen: first_n(seen, "product_id", "url", "source", order, n).drop("priority")


def current_candidates(spark: SparkSession, table: str, n: int = MAX_URLS, order: str = "_id") -> DataFrame:
    deltas = Levels(spark, table, _first_urls(n, order)).read()
    return first_n(deltas, "product_id", "url", "source", order, n).select(
        "product_id", "url", "source", "priority"
    )


# Failure ledger across runs -----------------------------------------------------------------


def stream_failures(attempts: DataFrame, table: str, checkpoint: str) -> None:
    stream_deltas(attempts, table, checkpoint, ledger_delta, merge_ledger)


def current_failures(spark: SparkSession, table: str) -> DataFrame:
    return ledger_view(merge_ledger(Levels(spark, table, merge_ledger).read()))


# High-water-mark increments -----------------------------------------------------------------


def stream_increments(
    stream: DataFrame, table: str, checkpoint: str, keys: list[str], mark: str, lateness: str = "drop",
    partition: str | None = None,
) -> None:
    """Feed micro-batches through :func:`increment_table`; late rows follow its rule.

    With ``partition``, merging a batch rewrites only the partitions it touches.

    A batch that failed after its write and runs again finds its rows not above the mark
    (``drop``) or replaces them by themselves (``merge``).
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if table_exists(batch.sparkSession, table) or batch.take(1):
            increment_table(batch.sparkSession, table, batch, keys, mark, lateness=lateness, partition=partition)

    _run(stream, checkpoint, each_batch)

