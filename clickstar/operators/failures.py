"""Ledger of failed attempts, and status counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import last_chars

# The states of a product in the collection job.
STATUSES = ("pending", "in_progress", "done", "failed")


def ledger_delta(attempts: DataFrame, error_chars: int | None = None) -> DataFrame:
    """Partial ledger of attempts (product_id, url, error, ts, recovered_via).

    Errors are kept whole unless ``error_chars`` asks for their end only.

    The latest attempt is one struct, so that partial ledgers merge by ``max`` and ``sum``.  A
    product that was not recovered by its latest attempt has a NULL there, which must win.
    """
    latest = F.struct("ts", last_chars(F.col("error"), error_chars).alias("error"), "recovered_via")
    return attempts.groupBy("product_id", "url").agg(
        F.max(latest).alias("latest"), F.count("*").alias("occurrences")
    )


def merge_ledger(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("product_id", "url").agg(
        F.max("latest").alias("latest"), F.sum("occurrences").alias("occurrences")
    )


def ledger_view(ledger: DataFrame) -> DataFrame:
    return ledger.select(
        "product_id",
        "url",
        F.col("latest.error").alias("last_error"),
        "occurrences",
        F.col("latest.ts").alias("last_failed_at"),
        F.col("latest.recovered_via").alias("recovered_via"),
    )


def failure_ledger(attempts: DataFrame, error_chars: int | None = None) -> DataFrame:
    """Per (product, url): last error, number of failures, last time, how it was recovered."""
    return ledger_view(ledger_delta(attempts, error_chars))


def status_counts(df: DataFrame, status: str = "status", statuses: Sequence[str] = STATUSES) -> DataFrame:
    """Rows per status in one row; known statuses without rows show 0."""
    return df.agg(*[F.count_if(F.col(status) == name).alias(name) for name in statuses])


def job_statistics(products: DataFrame, results: DataFrame, candidates: DataFrame, failed: DataFrame) -> DataFrame:
    """Status counts plus the number of results, candidate URLs and failed URLs."""
    tagged = products.select(F.col("status").alias("kind"))
    for name, table in (("results", results), ("candidate_urls", candidates), ("failed_urls", failed)):
        tagged = tagged.unionByName(table.select(F.lit(name).alias("kind")))
    return status_counts(tagged, "kind", (*STATUSES, "results", "candidate_urls", "failed_urls"))


def next_pending(df: DataFrame, k: int, key: str = "product_id", status: str = "status") -> DataFrame:
    """The first ``k`` pending items by key (a top-k, no full sort)."""
    return df.where(F.col(status) == "pending").orderBy(key).limit(k)
