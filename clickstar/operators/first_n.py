"""First N distinct values per key in order of arrival."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_sightings(df: DataFrame, key: str, value: str, source: str, order: str) -> DataFrame:
    """One row per (key, value): its first position and the source that was seen there."""
    return df.where(F.col(value).isNotNull()).groupBy(key, value).agg(
        F.min(order).alias(order), F.min_by(source, order).alias(source)
    )


def first_n(df: DataFrame, key: str, value: str, source: str, order: str, n: int) -> DataFrame:
    """The ``n`` values of each key that arrived first, with ``priority`` 0 … n-1.

    The rank filter lets Spark keep only ``n`` rows per key and task before the shuffle, so a
    key with very many values stays cheap.
    """
    window = Window.partitionBy(key).orderBy(order, value)
    return (
        first_sightings(df, key, value, source, order)
        .withColumn("priority", F.row_number().over(window))
        .where(F.col("priority") <= n)
        .withColumn("priority", F.col("priority") - 1)
    )
