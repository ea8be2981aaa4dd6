"""Helpers shared by the operators: tables that cut lineage, blocks of words, a store per worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstar.session import scratch_path

# Setting that ends the life of shuffle files with their query; older releases lack it.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes of one text that are cut into words at a time.
BLOCK_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once below the shared folder and read again.

    Its rows survive lost executors, and joins of such tables start from plain shuffles, which AQE
    can split where a key is hot.  Shuffle files of the job are given back as soon as it ends; the
    frame itself is not used again.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(CLEANUP, None)
    if before is not None:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is not None:
            spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def freed(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more."""
    for read in tables:
        spark = read.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(read.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this box; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_bytes(column: str = "text"):
    """The UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words between ASCII white space, a bounded number at a time."""
    if len(text) <= BLOCK_BYTES:
        yield text.split()
        return
    start, rest = 0, b""
    while start < len(text):
        block = rest + text[start : start + BLOCK_BYTES]
        start += BLOCK_BYTES
        words = block.split()
        # The last word may go on in the next block.
        rest = words.pop() if words and start < len(text) and not block[-1:].isspace() else b""
        yield words
    if rest:
        yield [rest]


def worker_store() -> dict:
    """A dictionary that a reused Python worker keeps from task to task."""
    name = "clickstar_worker_store"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def keep_ids(docs: DataFrame, ids: DataFrame, column: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` is (or, with left_anti, is not) in a column of ``ids``.

    Ids grow with the corpus, so both sides are shuffled at every size.
    """
    names = ids.select(F.col(column).alias("__llm_key")).hint("merge")
    return docs.join(names, docs["doc_id"] == names["__llm_key"], how)


class Recent:
    """Values by key, worked out together for all new keys; about ``limit`` to twice as many stay.

    When ``now`` is full it becomes ``before``, from which keys that are met again move over, so
    frequent keys stay and memory is bounded.
    """

    def __init__(self, limit: int):
        self.limit, self.now, self.before = limit, {}, {}

    def learn(self, keys: set, work_out: Callable[[set], Iterable[tuple]]) -> Callable:
        """Look-up that knows all of ``keys``."""
        if len(self.now) > self.limit:
            self.now, self.before = {}, self.now
        new = {key for key in keys if key not in self.now}
        if new and self.before:
            met = {key: self.before[key] for key in new if key in self.before}
            self.now.update(met)
            new.difference_update(met)
        self.now.update(work_out(new))
        return self.now.__getitem__
