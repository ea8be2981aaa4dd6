"""Data-quality checks.  Each returns the violating rows or keys; no rows means passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY
from ..functions.text import mask_email


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def compound_unique(df: DataFrame, columns: Sequence[str], row_condition: str | None = None) -> DataFrame:
    """Column combinations that occur more than once, unless all of them are NULL."""
    rows = df if row_condition is None else df.where(F.expr(row_condition))
    return (
        rows.where(_any_filled(columns))
        .groupBy(*columns)
        .agg(F.count("*").alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def _any_filled(columns: Sequence[str]):
    filled = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        filled = filled | F.col(name).isNotNull()
    return filled


def relationship(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null values of a foreign key that the parent lacks, with their number of rows.

    Counting per value first shuffles each value once however many rows hold it.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n_records"))
    keys = parent.select(F.col(field).alias(column))
    return used.join(keys, column, "left_anti")


def without_active_version(dim: DataFrame, entity: str, key: str, current: str = "is_current") -> DataFrame:
    """One row with both counts if some entity has no current version, else no row."""
    return (
        dim.where(F.col(key) != UNKNOWN_KEY)
        .groupBy(entity)
        .agg(F.bool_or(F.coalesce(current, F.lit(False))).alias("active"))
        .agg(
            F.count(entity).alias("total_unique_customers"),
            F.count_if(F.col("active") & F.col(entity).isNotNull()).alias("total_active_customers"),
        )
        .where(F.col("total_unique_customers") != F.col("total_active_customers"))
    )


def not_in(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Rows whose value is not in the parent, by the SQL rules of ``NOT IN``.

    A NULL in the parent lets nothing through; a NULL in the child passes only if the parent is
    empty.  Counting the parent first makes this a plain anti join, which can be shuffled, where
    a null-aware one must broadcast the parent.
    """
    known = parent.select(F.col(field).alias(column)).distinct()
    size = parent.agg(F.count("*")).scalar()
    nulls = parent.agg(F.count_if(F.col(field).isNull())).scalar()
    missing = child.join(known, column, "left_anti").select(*child.columns)
    return missing.where((size == 0) | ((nulls == 0) & F.col(column).isNotNull()))


def masked_view(df: DataFrame, column: str, tag: str) -> DataFrame:
    """The frame for readers without the right to see ``column``: a digest, tagged in the schema."""
    return df.withColumn(column, mask_email(F.col(column))).withMetadata(column, {"policy": tag})


def check_table(df: DataFrame, rules: dict[str, Sequence[str]]) -> DataFrame:
    """Number of violations of ``not_null`` and ``unique`` rules per column, in one row each.

    ``rules`` maps a column to its checks.  All not-null counts share one scan.
    """
    null_columns = [name for name, checks in rules.items() if "not_null" in checks]
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in null_columns])
    listed = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit("not_null").alias("check"), F.col(name).alias("violations"))
        for name in null_columns
    ]))
    report = counts.select(listed.alias("r")).select("r.*") if null_columns else None
    for name, checks in rules.items():
        if "unique" in checks:
            row = unique(df, name).agg(F.count("*").alias("violations")).select(
                F.lit(name).alias("column_name"), F.lit("unique").alias("check"), "violations"
            )
            report = row if report is None else report.unionByName(row)
    return report
