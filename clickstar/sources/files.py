"""Reading landing files, batches of fixed size with a manifest, and the bulk rewrite."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import split_uri
from ..session import cut_lineage, path_exists, scratch_path
from . import filescan, snapshots
from .harmonize import harmonize_frame

DOCUMENTS_PER_FILE = 10_000


def read_documents(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Event documents from Parquet or JSON lines; a scan needs no order."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path) if path.endswith((".json", ".jsonl")) else reader.parquet(path)


def write_documents(
    df: DataFrame, path: str, per_file: int = DOCUMENTS_PER_FILE, mode: str = "error", partition: Sequence[str] = (),
    codec: str = "snappy", options: Mapping[str, str] | None = None,
) -> None:
    """Parquet with at most ``per_file`` rows per file.

    ``partition`` by the event type lets every job that wants one type skip the others.
    """
    writer = df.write.mode(mode).options(**options or {}).option("compression", codec).option("maxRecordsPerFile", per_file)
    (writer.partitionBy(*partition) if partition else writer).parquet(path)


def write_jsonl(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """JSON lines, replacing earlier ones, with NULL fields kept; files follow ``order``."""
    ordered = df.orderBy(*order) if order else df
    ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_products(products: DataFrame, path: str, metadata: bool = True) -> None:
    """Product rows as JSON lines ordered by id, with the ``_crawl`` struct if wanted."""
    write_jsonl(products if metadata else products.drop("_crawl"), path, ["product_id"])


def _rows_before(sizes: DataFrame, levels: Sequence[str], size: str, out: str) -> DataFrame:
    """Rows in earlier buckets: those of the same coarser bucket, plus those before that one."""
    *coarse, fine = levels
    earlier = Window.partitionBy(*coarse).orderBy(fine).rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn(out, F.coalesce(F.sum(size).over(earlier), F.lit(0)))
    if not coarse:
        return inside
    outer = sizes.groupBy(*coarse).agg(F.sum(size).alias(size))
    before = _rows_before(outer, coarse, size, f"{out}_outer").drop(size)
    return inside.join(before, coarse).withColumn(out, F.col(out) + F.col(f"{out}_outer")).drop(f"{out}_outer")


def export_failures(ledger: DataFrame, path: str) -> None:
    """The failure ledger as JSON lines ordered by product and URL."""
    write_jsonl(ledger.withColumnRenamed("url", "failed_url"), path, ["product_id", "failed_url"])


def global_rank(df: DataFrame, order: str, buckets: Sequence[Column], out: str = "rank") -> DataFrame:
    """1-based rank over the whole frame without a single-task sort.

    ``buckets``, from coarse to fine, must rise with ``order``; the finest are of bounded size,
    and so is the number of finer buckets in a coarser one (for document ids: more and more of
    their leading digits, which are a time).  Rows are numbered inside the finest buckets and
    shifted by the rows of earlier ones.  The rank is a function of the data alone, so a retried
    task numbers alike.
    """
    levels = [f"__bucket_{i}" for i in range(len(buckets))]
    bucketed = df.withColumns(dict(zip(levels, buckets)))
    sizes = bucketed.groupBy(*levels).agg(F.count("*").alias("__size"))
    shifts = _rows_before(sizes, levels, "__size", "__shift").drop("__size")
    inside = F.row_number().over(Window.partitionBy(*levels).orderBy(order))
    return (
        bucketed.withColumn("__inside", inside)
        .join(shifts, levels)
        .withColumn(out, F.col("__inside") + F.col("__shift"))
        .drop(*levels, "__inside", "__shift")
    )


def object_id_buckets(column: str) -> list[Column]:
    """Buckets for :func:`global_rank` from coarse to fine for ids of 24 hex digits.

    Their first eight digits are the second of creation, so a bucket holds what one second brought.
    """
    return [F.substring(column, 1, digits) for digits in (4, 6, 8)]


def number_files(
    df: DataFrame, order: str, buckets: Sequence[Column], size: int = DOCUMENTS_PER_FILE, first: int = 1
) -> DataFrame:
    """Add ``file_no``: exact batches of ``size`` rows in order, the last one may be short."""
    if size < 1:
        raise ValueError("documents per file must be at least 1")
    ranked = global_rank(df, order, buckets, "__rank")
    return ranked.withColumn(
        "file_no", F.floor((F.col("__rank") - 1) / size).cast("bigint") + first
    ).drop("__rank")


def manifest(numbered: DataFrame, key: str) -> DataFrame:
    """First id, last id and number of documents of each batch."""
    return numbered.groupBy("file_no").agg(
        F.min(key).alias("first_id"), F.max(key).alias("last_id"), F.count("*").alias("document_count")
    )


def compare_manifests(planned: DataFrame, stored: DataFrame) -> DataFrame:
    """Planned batches with ``state``: ``new``, ``recovered`` (same as stored) or ``conflict``."""
    fields = ("first_id", "last_id", "document_count")
    found = stored.select("file_no", F.struct(*fields).alias("stored"))
    return planned.join(found, "file_no", "left").withColumn(
        "state",
        F.when(F.col("stored").isNull(), "new")
        .when(F.struct(*fields) == F.col("stored"), "recovered")
        .otherwise("conflict"),
    ).drop("stored")


def commit_batches(spark: SparkSession, numbered: DataFrame, key: str, path: str) -> DataFrame:
    """Add the numbered batches that ``path`` lacks, one file each; returns all with ``state``.

    The batches of a run and their manifest belong to one snapshot, which becomes current when all of
    it is written: a run that broke leaves the table as it was and is repeated without harm.  A stored
    batch with other contents is an error.  :func:`read_batches` gives the rows.
    """
    planned = manifest(numbered, key)
    stored = stored_manifest(spark, path, planned.schema)
    # One row per batch, kept because the manifest it compares with is about to grow.
    states = cut_lineage(compare_manifests(planned, stored))
    if states.where(F.col("state") == "conflict").take(1):
        raise ValueError(f"{path} holds other documents under the same batch number")
    new = states.where(F.col("state") == "new").drop("state")
    if not new.isEmpty():
        snapshot = uuid.uuid4().hex
        # Counts for nothing until the snapshot of this name is current.
        new.write.parquet(f"{path}/batches/snapshot={snapshot}")
        rows = numbered.join(new.select("file_no"), "file_no", "left_semi").select(numbered.columns)
        snapshots.append(
            rows.repartitionByRange("file_no").sortWithinPartitions("file_no", key), path, cut="file_no", snapshot=snapshot
        )
    return states


def stored_manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """First id, last id and count of the batches in the current snapshot."""
    head = snapshots.head_of(path, snapshots.current(path))
    if head is None:
        return spark.createDataFrame([], schema)
    kept = T.StructType([*schema.fields, T.StructField("snapshot", T.StringType())])
    found = spark.read.schema(kept).parquet(f"{path}/batches")
    return found.where(F.col("snapshot").isin(head["snapshots"])).drop("snapshot")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches."""
    rows = snapshots.read(spark, path)
    if rows is None:
        raise ValueError(f"no batch was ever committed at {path}")
    return rows


def load_state(loaded: DataFrame, prefix: str) -> DataFrame:
    """Progress of a load from its manifest: last id, next file, documents, last object."""
    last = F.max("file_no")
    return loaded.agg(
        F.max_by("last_id", "file_no").alias("last_mongo_id"),
        F.greatest(F.coalesce(last, F.lit(0)) + 1, F.lit(1)).alias("next_file_number"),
        F.greatest(F.coalesce(F.sum("document_count"), F.lit(0)), F.lit(0)).alias("documents_uploaded"),
        F.concat(F.lit(prefix.strip("/") + "/" if prefix.strip("/") else ""), last.cast("string"),
                 F.lit(".parquet")).alias("last_object"),
    )


def preferred_state(remote: DataFrame, local: DataFrame) -> DataFrame:
    """The remote state row if there is one, else the local one (each has at most one row)."""
    both = remote.withColumn("__rank", F.lit(0)).unionByName(local.withColumn("__rank", F.lit(1)))
    return both.orderBy("__rank").limit(1).drop("__rank")


def load_report(df: DataFrame) -> DataFrame:
    """Rows and schema of a table: one row per column with name, type and mode."""

    def mode(f: T.StructField) -> str:
        if isinstance(f.dataType, T.ArrayType):
            return "REPEATED"
        return "NULLABLE" if f.nullable else "REQUIRED"

    columns = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(mode(f)).alias("mode"),
        )
        for i, f in enumerate(df.schema.fields)
    ]))
    return df.agg(F.count("*").alias("total_rows")).select("total_rows", columns.alias("c")).select("total_rows", "c.*")


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder: path, relative name, size and modification time; no contents are read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", name_below(path).alias("name"), "length", "modificationTime")
    )


def name_below(folder: str) -> Column:
    """Path of the file of each row relative to the folder that was read."""
    tail = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*:/*", "", folder).strip("/") + "/"
    uri = F.col("_metadata.file_path")
    return F.substring(uri, F.instr(uri, tail) + len(tail), F.length(uri))


def check_rewrite_paths(source: str, destination: str) -> None:
    src, dst = source.rstrip("/"), destination.rstrip("/")
    if src == dst:
        raise ValueError("source and destination are the same")
    if dst.startswith(src + "/"):
        raise ValueError("destination lies inside the source")


def rewrite_files(spark: SparkSession, source: str, destination: str, max_files: int | None = None) -> DataFrame:
    """Rewrite Parquet files with text leaves; returns source, status, rows, error per file.

    Output keeps one folder per source file (``source_file=…``, its path below the source); these
    and, for files without rows, a list beside the output tell later runs what to skip.  Names,
    footers and statuses are tables that tasks read and write; files of equal schema are rewritten by
    one job; a file whose footer cannot be read is reported as failed and does not stop the others.
    """
    check_rewrite_paths(source, destination)
    listed = list_files(spark, source, "*.parquet").select("path", "name")
    if path_exists(spark, destination):
        done = spark.read.schema("source_file string").parquet(destination).distinct().toDF("name")
    else:
        done = spark.createDataFrame([], "name string")
    empty_list = f"{destination.rstrip('/')}__empty"
    if path_exists(spark, empty_list):
        done = done.union(spark.read.schema("name string").parquet(empty_list)).distinct()
    flagged = listed.join(done.withColumn("done", F.lit(True)), "name", "left")
    if max_files is not None:
        flagged = flagged.orderBy("path").limit(max_files)
    # Kept, because the output it is compared with is about to grow.
    plan = scratch_path(spark, "rewrite")
    flagged.write.parquet(plan)
    planned = spark.read.schema("name string, path string, done boolean").parquet(plan)
    found = filescan.footers(planned.where("done is null").select("name", "path"), "path")
    for schema in filescan.schemas(found):
        group = filescan.rows_of(found, schema, ["name"], "path")
        named = group.withColumn("source_file", F.col("__file.name")).drop("__file")
        columns = harmonize_frame(named.drop("source_file")).columns
        (
            harmonize_frame(named).select(*[F.col(f"`{c}`") for c in columns], "source_file")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy("source_file")
            .parquet(destination)
        )
    # Partitioned output of no rows leaves no folder.
    empty = found.where("error is null and rows = 0").select("name")
    if not empty.isEmpty():
        empty.write.mode("append").parquet(empty_list)
    status = F.when(F.col("error").isNull(), "migrated").otherwise("failed")
    return found.select(F.col("name").alias("source"), status.alias("status"), "rows", "error").unionByName(
        planned.where("done").select(
            F.col("name").alias("source"), F.lit("skipped").alias("status"), F.lit(0).cast("bigint").alias("rows"),
            F.lit(None).cast("string").alias("error"),
        )
    )


def uri_parts(df: DataFrame, column: str) -> DataFrame:
    return df.select("*", split_uri(F.col(column)).alias("__uri")).select(
        *df.columns, F.col("__uri.bucket").alias("bucket"), F.col("__uri.prefix").alias("prefix")
    )
