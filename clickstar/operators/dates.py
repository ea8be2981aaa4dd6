"""Distinct local dates of checkouts, and how the scan went."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import local_date

CHECKOUT = "checkout_success"


def checkouts(events: DataFrame) -> DataFrame:
    return events.where(F.col("collection") == CHECKOUT)


def _per_date(events: DataFrame, column: str) -> DataFrame:
    day = local_date(F.col(column), events.schema[column].dataType)
    return events.select(day.alias("date")).groupBy("date").agg(F.count("*").alias("values"))


def local_dates(events: DataFrame, column: str = "local_time") -> DataFrame:
    """Sorted distinct valid dates."""
    return _per_date(events, column).where(F.col("date").isNotNull()).select("date").orderBy("date")


def date_scan_statistics(events: DataFrame, column: str = "local_time") -> DataFrame:
    """One row: scanned, unique, invalid and duplicate dates.

    Counting per date first leaves only calendar days for the final aggregate.
    """
    valid = F.col("date").isNotNull()
    counts = _per_date(events, column).agg(
        F.coalesce(F.sum("values"), F.lit(0)).alias("scanned"),
        F.count_if(valid).alias("unique_dates"),
        F.coalesce(F.sum(F.when(~valid, F.col("values"))), F.lit(0)).alias("invalid_dates"),
    )
    return counts.withColumn(
        "duplicate_dates", F.col("scanned") - F.col("invalid_dates") - F.col("unique_dates")
    )
