"""Whether written output is in order: places of rows as the files have them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.files import name_below
from ..sources.filescan import text_rows

# Column with the place of a row, from 1.
PLACE = "place"
_FILE, _ROW = "__file", "__row"


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with the file they stand in and their number there → rows with their place in all files.

    Output of a sort has its files in the order of their names, and one count per file puts them behind
    each other.
    """
    sizes = rows.groupBy(_FILE).agg(F.count(F.lit(1)).alias("__size"))
    earlier = Window.orderBy(_FILE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(_FILE, F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__start"))
    return rows.join(starts, _FILE).withColumn(PLACE, F.col("__start") + F.col(_ROW) + 1).drop(_FILE, _ROW, "__start")


def parquet_places(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a written Parquet folder with their place."""
    return _placed(spark.read.parquet(path).select(
        "*", name_below(path).alias(_FILE), F.col("_metadata.row_index").alias(_ROW)
    ))


def line_places(files: DataFrame) -> DataFrame:
    """The lines (``value``) of text files (uri, name) with their place; ``name`` orders the files."""
    rows = text_rows(files, ["name"], number=_ROW)
    return _placed(rows.withColumnRenamed("name", _FILE).drop("uri"))


def out_of_order(placed: DataFrame, keys: Sequence[Column], per_chunk: int = 1_000_000) -> DataFrame:
    """Rows of :func:`parquet_places` or :func:`line_places` that come before the row in front of them.

    ``keys`` rise where the order holds; NULL is lowest.  A window holds a stretch of places; the first
    row of a stretch is compared with the last one of the stretch before.
    """
    keyed = placed.withColumns({"__key": F.struct(*keys), "__chunk": F.floor((F.col(PLACE) - 1) / per_chunk)})
    inside = Window.partitionBy("__chunk").orderBy(PLACE)
    ends = keyed.groupBy("__chunk").agg(F.max_by("__key", PLACE).alias("__last")).select(
        (F.col("__chunk") + 1).alias("__chunk"), "__last"
    )
    compared = keyed.withColumn("__before", F.lag("__key").over(inside)).join(ends, "__chunk", "left")
    before = F.coalesce("__before", "__last")
    return compared.where(before.isNotNull() & (F.col("__key") < before)).drop("__key", "__chunk", "__before", "__last")
