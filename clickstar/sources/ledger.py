"""Routing of arrived files to landing tables, and appends that happen once per file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import load_id
from ..session import cut_lineage, path_exists


@dataclass(frozen=True)
class Route:
    prefix: str
    extension: str
    table: str


# Which files belong to which landing table.
ROUTES = (
    Route("mongodb_data_string/", ".parquet", "raw_mongo"),
    Route("location_data/", ".jsonl", "raw_location"),
    Route("product_data/", ".jsonl", "raw_product"),
    Route("exchange_rate_data/", ".jsonl", "raw_exchange_rate"),
)


def _required(c: Column, what: str) -> Column:
    return F.when(F.coalesce(c, F.lit("")) != "", c).otherwise(
        F.raise_error(F.lit(f"a file event needs a {what}")).cast("string")
    )


def route_files(files: DataFrame, bucket: str, routes: tuple[Route, ...] = ROUTES) -> DataFrame:
    """Files(bucket, name, generation) that belong to a landing table, with ``destination``.

    Prefixes count case, extensions do not; other files are ignored, an event without bucket or
    name is an error.
    """
    name = _required(F.col("name"), "name")
    target = F.lit(None).cast("string")
    for route in reversed(routes):
        fits = F.startswith(name, F.lit(route.prefix)) & F.endswith(F.lower(name), F.lit(route.extension))
        target = F.when(fits, route.table).otherwise(target)
    return (
        files.withColumn("destination", F.when(_required(F.col("bucket"), "bucket") == bucket, target))
        .where(F.col("destination").isNotNull())
    )


def with_load_id(files: DataFrame) -> DataFrame:
    return files.withColumn("load_id", load_id(F.col("bucket"), F.col("name"), F.col("generation")))


def unloaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Routed files whose generation was never loaded, each once however often it was announced."""
    return (
        with_load_id(files)
        .dropDuplicates(["load_id"])
        .join(ledger.select("load_id"), "load_id", "left_anti")
    )


def landed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The rows of a landing table; a column that only some batches have is NULL in the others."""
    return spark.read.option("mergeSchema", "true").parquet(f"{root}/{table}")


def append_once(spark: SparkSession, files: DataFrame, root: str, table: str, reader) -> DataFrame:
    """Append the not yet loaded files(…, uri) of one landing table; returns what this run did.

    Three steps make a crash harmless.  The batch is first written to the ledger as planned; its
    rows then go to a folder named after the batch, overwriting what a broken run left there;
    last the batch is marked as done.  A run also finishes batches that were planned before.
    ``reader(files)`` gives the rows of the files (uri, batch) with the column ``batch``, as
    :func:`~.filescan.parquet_rows` and :func:`~.filescan.json_rows` do: the names stay a table, and
    tasks open them.  Batches may differ in their columns, see :func:`landed`.
    """
    plans, data, marks = f"{root}/ledger/{table}", f"{root}/{table}", f"{root}/done/{table}"
    plan_schema, mark_schema = "load_id string, uri string, batch string", "batch string"

    def stored(path: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)

    fresh = unloaded(files.where(F.col("destination") == table), stored(plans, plan_schema)).select("load_id", "uri")
    # No id is ever planned twice, so the smallest id of a batch names it.
    first = fresh.agg(F.min("load_id").alias("id")).first()["id"]
    if first is not None:
        fresh.write.mode("overwrite").parquet(f"{plans}/batch={first[-32:]}")
    done = stored(marks, mark_schema).distinct()
    open_files = cut_lineage(stored(plans, plan_schema).join(done, "batch", "left_anti"))
    if not open_files.isEmpty():
        reader(open_files.select("uri", "batch")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch").parquet(data)
        open_files.select("batch").distinct().write.mode("append").parquet(marks)
    return open_files.select("load_id", "uri", "batch")
