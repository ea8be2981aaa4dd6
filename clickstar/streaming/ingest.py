"""Files that land once are appended once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import path_exists
from ..sources.ledger import ROUTES, Route


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet",
    pattern: str | None = None, files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the files that arrive in a folder.  Files must not be replaced in place."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(kind).load(folder)


def append_stream(stream: DataFrame, table: str, checkpoint: str) -> None:
    """Append everything that has arrived, then stop.

    The source offsets in ``checkpoint`` and the commit log of the Parquet sink make the append
    exactly-once across restarts; running again without new files adds nothing.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def any_case(extension: str) -> str:
    """Glob for file names with an extension in upper or lower case."""
    return "*" + "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in extension)


def ingest_routes(
    spark: SparkSession, bucket: str, schemas: Mapping[str, T.StructType], tables: str, checkpoints: str,
    routes: tuple[Route, ...] = ROUTES, files_per_batch: int | None = None,
) -> list[str]:
    """Append what arrived in a bucket to the landing tables, one stream per route.

    Streams exist for tables with a schema and a folder; returns the tables that were brought up
    to date.
    """
    fed = []
    for route in routes:
        folder = f"{bucket}/{route.prefix}"
        if route.table not in schemas or not path_exists(spark, folder):
            continue
        kind = "parquet" if route.extension == ".parquet" else "json"
        stream = file_stream(
            spark, folder, schemas[route.table], kind, any_case(route.extension), files_per_batch
        )
        append_stream(stream, f"{tables}/{route.table}", f"{checkpoints}/{route.table}")
        fed.append(route.table)
    return fed
