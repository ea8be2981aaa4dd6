"""Incremental loads: high-water marks, upserts and the late-row rule."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import DENSE_PAGES, cut_lineage, replace_table, shuffles_freed, table_exists

# Option of a write that leaves out the mark of a finished one.
SUCCESS_MARK = "mapreduce.fileoutputcommitter.marksuccessfuljobs"


def after_mark(df: DataFrame, key: str, mark: object | None) -> DataFrame:
    """Rows strictly beyond a stored mark; all rows when there is none yet.

    The mark is a literal, so the filter reaches the Parquet row groups.
    """
    return df if mark is None else df.where(F.col(key) > F.lit(mark))


def high_water_mark(df: DataFrame, key: str) -> object | None:
    return df.agg(F.max(key).alias("mark")).first()["mark"]


def check_object_id(mark: str | None) -> str | None:
    """A document id mark must be 24 hex digits; those sort as text."""
    if mark is None:
        return None
    if len(mark) != 24 or any(ch not in "0123456789abcdef" for ch in mark.lower()):
        raise ValueError(f"not a document id: {mark!r}")
    return mark.lower()


def newer_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` beyond the target's maximum; late and NULL keys are dropped.

    An empty target has no maximum and lets nothing through, as in SQL; the first load must not
    come here.
    """
    return source.where(F.col(key) > target.agg(F.max(key)).scalar())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of equal keys, the others are inserted.

    NULL keys never match, so such rows are always inserted.  Source rows that share a key are
    all inserted if the target lacks it; if it has it, one target row would have two successors
    and the merge is refused.
    """
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti")
    # Few keys repeat, so they are the side to send to the target.
    repeated = duplicate_keys(source, keys).select(*keys)
    clashes = target.select(*keys).join(repeated, list(keys), "left_semi").distinct()
    checked = source.join(clashes.withColumn("__clash", F.lit(True)), list(keys), "left").where(
        F.when(F.col("__clash"), F.raise_error(F.lit("two source rows match one target row")).cast("boolean"))
        .otherwise(True)
    ).select(*source.columns)
    return kept.unionByName(checked)


def write_parts(parts: Sequence[DataFrame], path: str, mode: str) -> None:
    """Write frames one after the other into one table; the mark of a finished write comes with the last.

    The shuffle files of one part are given back before the next one begins.
    """
    for number, part in enumerate(parts, 1):
        writer = part.write.mode(mode if number == 1 else "append")
        with shuffles_freed(part.sparkSession):
            writer.options(**DENSE_PAGES).option(SUCCESS_MARK, str(number == len(parts)).lower()).parquet(path)


def increment_table(
    spark: SparkSession,
    path: str,
    source: DataFrame | Sequence[DataFrame],
    keys: Sequence[str],
    mark: str,
    *,
    partition: str | None = None,
    lateness: str = "drop",
    strict: bool = False,
) -> DataFrame:
    """Bring a Parquet table up to date and return it.

    First run: the whole source is written.  ``lateness="drop"`` then keeps rows beyond the
    stored maximum only, so nothing can match and the new rows are appended without touching
    old files.  ``lateness="merge"`` upserts; with ``partition`` (a function of the merge keys,
    such as the date of the time stamp) only the partitions that receive rows are rewritten.

    ``source`` may be several frames, cut where ``mark`` has cuts and in its order: a table without
    ``partition`` is then written part by part, and a run that broke between two parts goes on behind
    the last one.  The merge takes them together.
    """
    parts = [source] if isinstance(source, DataFrame) else list(source)
    source = reduce(DataFrame.unionByName, parts)
    if strict and duplicate_keys(source, keys).take(1):
        raise ValueError(f"source has repeated keys {list(keys)}")

    def write(parts: Sequence[DataFrame], mode: str, partitions: str = "dynamic") -> None:
        if partition is None:
            return write_parts(parts, path, mode)
        df = reduce(DataFrame.unionByName, parts)
        # Rows of one partition go to few tasks, a large partition to several.
        writer = df.hint("rebalance", partition).write.mode(mode).partitionBy(partition)
        writer.option("partitionOverwriteMode", partitions).parquet(path)

    replace_table(spark, path)
    if not table_exists(spark, path):
        # Replacing everything leaves the mark of a finished write, which later writes keep.
        write(parts, "overwrite", "static")
        return spark.read.parquet(path)

    target = spark.read.parquet(path).select(*source.columns)
    if lateness == "drop":
        stored = high_water_mark(target, mark)
        # Rows without any mark are no mark: as in SQL nothing lies beyond it.  An empty table has
        # no rows to repeat and takes all.
        if stored is not None or target.isEmpty():
            write([after_mark(part, mark, stored) for part in parts], "append")
    elif lateness == "merge":
        # The merge reads the new rows several times; they are computed once.
        source, touched = cut_lineage(source), target
        if partition:
            touched = target.join(source.select(partition).distinct(), partition, "left_semi")
        merged = upsert(touched, source, keys)
        if partition:
            # A reliable checkpoint: the files read here are the ones about to be replaced.
            write([cut_lineage(merged)], "overwrite")
        else:
            replace_table(spark, path, merged)
    else:
        raise ValueError(f"unknown lateness {lateness!r}")
    return spark.read.parquet(path)
