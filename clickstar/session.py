"""Session settings, and the shared folder used for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on.  The least number of shuffle partitions is left to the
# cluster: AQE coalesces small ones, and a fixed number would be wrong at another scale.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The co-located side of a join keeps its partitions when it is partitioned by some of the join's keys.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A side of a join whose partitions all turn out small is hashed, so that neither side is sorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    # Rows of one order lie side by side in a shuffle and are ten times as large in memory as there.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Keys are hexadecimal digests, of which zstd leaves half.
    "spark.sql.parquet.compression.codec": "zstd",
    # A task that writes few folders needs no sort of its rows; beyond these it sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # The JVM never compiles a method of more bytes than this, so a stage of one such method would be interpreted;
    # its operators run one by one then, each in methods of its own.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables kept by day have thousands of folders: many of them to a task that lists.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


# Options of a write of tables that are mostly keys: pages of Parquet's second version hold them without a length
# before each and say once what a key shares with the one before.  Columns with a key of their own for each order
# have no use for a dictionary.
DENSE_PAGES = {"parquet.writer.version": "PARQUET_2_0"} | {
    f"parquet.enable.dictionary#{name}": "false"
    for name in (
        "detail_key", "customer_key", "product_key", "order_id", "time_stamp", "_id", "device_id", "email_address", "user_id_db",
        "sales_local_price", "sales_usd_price",
    )
}

# Input of one shuffle partition: unpacked, with its order on each line, it is some fifty times as large.
INPUT_PER_PARTITION = 3 << 20
PARTITIONS = "spark.sql.shuffle.partitions"
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def configure(spark: SparkSession, source: str | None = None) -> SparkSession:
    """Set what the jobs rely on; shuffles have as many partitions as the folder ``source`` asks for.

    A fixed number would let the memory of a task grow with the tables; AQE joins what is small.
    """
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    if source is not None:
        wanted = -(-folder_size(spark, source) // INPUT_PER_PARTITION)
        spark.conf.set(FIRST_PARTITIONS, str(max(wanted, int(spark.conf.get(PARTITIONS)))))
    return spark


def folder_size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


# Setting that ends the life of shuffle files with their query; older releases ignore it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block give their shuffle files back as soon as they end.

    For writes: a frame that was itself run inside must not be run again.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def local_session(cpus: int = 8, app: str = "clickstar", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach: the one the cluster names for checkpoints.

    Only a local session without one may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="clickstar-"))
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared folder, whatever happens to executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/clickstar/{app}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a write to this path ever finished; a broken first write leaves no mark."""
    return path_exists(spark, f"{path}/_SUCCESS")


def replace_table(spark: SparkSession, path: str, df: DataFrame | None = None) -> None:
    """Put ``df`` in place of the table at ``path``, which it may read, without ever losing both.

    The rows are written next to the table first.  Without ``df`` a replacement that was broken
    after that is completed, if there is one.
    """
    successor = f"{path.rstrip('/')}__next"
    if df is not None:
        df.write.mode("overwrite").parquet(successor)
    elif table_exists(spark, path) or not table_exists(spark, successor):
        return
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    old, new = hadoop(path), hadoop(successor)
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    # Without its mark the old table is known to be on its way out.
    files.delete(hadoop(f"{path}/_SUCCESS"), False)
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"cannot move {successor} to {path}")
