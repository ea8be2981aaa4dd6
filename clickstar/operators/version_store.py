"""A type-2 dimension that is kept up to date by what is new.

Three tables lie below one folder.  ``observed`` has every state an entity was seen in, one row per
entity, second and batch.  ``open`` has the version in force of each entity and when the entity was
last seen.  ``closed`` has the ended versions, by the stretch of time in which they ended.

A batch reads the open versions of the buckets its entities fall in.  Entities that are only seen later
than before go on from there: what they close is written to the present stretch of time and no earlier
event is read.  A late event splits or joins stored intervals: for its entity alone the versions that
end at the late time or after it are taken out and found again from the states seen since.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, table_exists
from .carry import time_chunk
from .scd2 import CHUNK_DAYS, best_row, build_versions

PARTS = {"closed": ["chunk", "bucket"], "open": ["bucket"]}


def one_of(column: str, values: Sequence[object]) -> Column:
    """A filter on a partition column that also takes NULL as a value."""
    known = [v for v in values if v is not None]
    found = F.col(column).isin(known)
    return found | F.col(column).isNull() if len(known) < len(values) else found


class VersionStore:
    """Versions of ``entity`` below ``root``; the same as :func:`~.scd2.build_versions` of all batches.

    ``buckets`` divides the entities by a hash; it and ``chunk_days`` stay as they were when the store
    was begun.  ``types`` names the attributes' types where they are not text.
    """

    def __init__(
        self, spark: SparkSession, root: str, entity: str, attributes: Sequence[str],
        preference: Sequence[str] | None = None, *, key: str = "version_key", chunk_days: int = CHUNK_DAYS,
        buckets: int = 16, types: dict[str, str] | None = None,
    ):
        self.spark, self.root, self.entity, self.key = spark, root.rstrip("/"), entity, key
        self.attributes, self.preference = list(attributes), preference
        self.chunk_days, self.buckets, self.types = chunk_days, buckets, types or {}

    # Tables -------------------------------------------------------------------------------------

    def _schema(self, name: str) -> T.StructType:
        states = ", ".join(f"{a} {self.types.get(a, 'string')}" for a in [self.entity, *self.attributes])
        columns = {
            "observed": f"{states}, start_time timestamp, batch string, chunk bigint, bucket int",
            "closed": f"{self.key} string, {states}, start_time timestamp, end_time timestamp, chunk bigint, bucket int",
            "open": f"{self.key} string, {states}, start_time timestamp, last_seen timestamp, bucket int",
        }
        return T.StructType.fromDDL(columns[name])

    def table(self, name: str) -> DataFrame:
        path, schema = f"{self.root}/{name}", self._schema(name)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def versions(self, since: datetime | None = None) -> DataFrame:
        """The dimension; with ``since`` only versions that hold at that time or later, for which the
        folders of what ended before are not opened."""
        closed, names = self.table("closed"), [self.key, self.entity, *self.attributes, "start_time"]
        if since is not None:
            moment = F.lit(since).cast("timestamp")
            closed = closed.where((F.col("chunk") >= time_chunk(moment, self.chunk_days)) & (F.col("end_time") > moment))
        end = F.lit("9999-01-01 00:00:00").cast("timestamp")
        return closed.select(*names, "end_time", F.lit(False).alias("is_current")).unionByName(
            self.table("open").select(*names, end.alias("end_time"), F.lit(True).alias("is_current"))
        )

    # Loading ------------------------------------------------------------------------------------

    def load(self, events: DataFrame, ts: str, batch: str) -> None:
        """Take in the rows of a batch, whose name is a folder name; the same batch again changes nothing.

        Rows without entity or time are left out.
        """
        self._finish()
        rows = self._observe(events, ts, batch)
        touched = self._touched(rows)
        facts = touched.agg(
            F.collect_set("bucket").alias("buckets"), F.min(F.when(F.col("late"), F.col("since"))).alias("since"),
            F.collect_set(F.when(F.col("late"), F.col("bucket"))).alias("late_buckets"),
            F.min(F.when(F.col("late"), time_chunk(F.col("since"), self.chunk_days))).alias("chunk"),
        ).first()
        if not facts["buckets"]:
            return
        late = touched.where("late").select(self.entity, "since")
        candidates = [touched.where("open_start < since").select(self.entity, *self.attributes, F.col("open_start").alias("start_time"))]
        fresh = rows.join(touched.where("not late").select(self.entity), self.entity, "left_semi")
        pieces, removed = [fresh.select(self.entity, *self.attributes, "start_time")], None
        if facts["late_buckets"]:
            # Only these folders of the two histories are opened.
            here = (F.col("chunk") >= facts["chunk"]) & F.col("bucket").isin(facts["late_buckets"])
            removed = self.table("closed").where(here).join(late, self.entity).where("end_time >= since")
            candidates.append(removed.where("start_time < since").select(candidates[0].columns))
            seen = self.table("observed").where(here).join(late, self.entity).where("start_time >= since")
            pieces.append(seen.select(pieces[0].columns))
        # What held just before: the last version that began earlier.
        before = candidates[0] if len(candidates) == 1 else candidates[0].unionByName(candidates[1])
        state = F.struct(*self.attributes, "start_time")
        seeds = before.groupBy(self.entity).agg(F.max_by(state, "start_time").alias("seed")).select(self.entity, "seed.*")
        for piece in pieces:
            seeds = seeds.unionByName(piece)
        found = build_versions(
            seeds, self.entity, "start_time", self.attributes, self.preference, key=self.key, chunk_days=self.chunk_days
        )
        made = self._stage("new", self._placed(found))
        self._replace(touched, made, removed, late, facts["buckets"])
        self._finish()

    def _observe(self, events: DataFrame, ts: str, batch: str) -> DataFrame:
        """Write the best state of each entity and second in the batch, in a folder of the batch."""
        seen = events.where(F.col(self.entity).isNotNull() & F.col(ts).isNotNull())
        states = best_row(
            seen.withColumn("start_time", F.col(ts)), [self.entity, "start_time"], self.attributes,
            self.preference or self.attributes,
        )
        path = f"{self.root}/observed/batch={batch}"
        placed = states.withColumns({"chunk": time_chunk(F.col("start_time"), self.chunk_days), "bucket": self._bucket()})
        placed.hint("rebalance", "chunk", "bucket").write.mode("overwrite").partitionBy("chunk", "bucket").parquet(path)
        schema = T.StructType([f for f in self._schema("observed") if f.name != "batch"])
        return self.spark.read.schema(schema).parquet(path) if table_exists(self.spark, path) else placed

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.entity), F.lit(self.buckets)).cast("int")

    def _touched(self, rows: DataFrame) -> DataFrame:
        """One row per entity of the batch: since when it changes, what is open, whether it is late."""
        batch = rows.groupBy(self.entity, "bucket").agg(F.min("start_time").alias("since"), F.max("start_time").alias("until"))
        buckets = [r["bucket"] for r in rows.select("bucket").distinct().collect()]
        known = self.table("open").where(F.col("bucket").isin(buckets)).withColumnRenamed("start_time", "open_start")
        joined = batch.join(known.drop("bucket", self.key), self.entity, "left")
        late = F.coalesce(F.col("since") <= F.col("last_seen"), F.lit(False))
        return self._stage("touched", joined.withColumns(
            {"late": late, "last_seen": F.greatest("until", "last_seen")}
        ).drop("until"))

    def _placed(self, versions: DataFrame) -> DataFrame:
        ended = F.when(~F.col("is_current"), time_chunk(F.col("end_time"), self.chunk_days))
        return versions.withColumns({"chunk": ended, "bucket": self._bucket()})

    def _stage(self, name: str, df: DataFrame, parts: Sequence[str] = ()) -> DataFrame:
        path = f"{self.root}/pending/{name}"
        df.write.mode("overwrite").partitionBy(*parts).parquet(path) if parts else df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _replace(self, touched: DataFrame, made: DataFrame, removed: DataFrame | None, late: DataFrame, buckets: list[int]) -> None:
        """Stage the new content of every folder that changes; the open versions come last."""
        ended = made.where("not is_current").drop("is_current")
        places = ended.select("chunk", "bucket")
        if removed is not None:
            places = places.unionByName(removed.select("chunk", "bucket"))
        # As many rows as there are folders of changed stretches of time.
        parts = [tuple(r) for r in self._stage("parts", places.distinct()).collect()]
        names = [f.name for f in self._schema("closed")]
        if parts:
            by_chunk: dict[int, list[int]] = {}
            for chunk, bucket in parts:
                by_chunk.setdefault(chunk, []).append(bucket)
            here = F.lit(False)
            for chunk, of in sorted(by_chunk.items()):
                here = here | ((F.col("chunk") == chunk) & F.col("bucket").isin(sorted(of)))
            kept = self.table("closed").where(here)
            if removed is not None:
                kept = kept.join(late, self.entity, "left").where("since is null or end_time < since").drop("since")
            ended = kept.select(*names).unionByName(ended.select(*names))
        self._stage("closed", ended.select(*names).hint("rebalance", *PARTS["closed"]), PARTS["closed"])
        names = [f.name for f in self._schema("open")]
        others = self.table("open").where(F.col("bucket").isin(buckets)).join(touched.select(self.entity), self.entity, "left_anti")
        current = made.where("is_current").join(touched.select(self.entity, "last_seen"), self.entity)
        self._stage("open", others.select(*names).unionByName(current.select(*names)).hint("rebalance", "bucket"), PARTS["open"])

    def _finish(self) -> None:
        """Put staged folders in the place of the old ones.

        A run that broke while it staged leaves no mark and is forgotten; one that broke here is
        done again from the start of this step, which gives the same folders.
        """
        pending = f"{self.root}/pending"
        if not table_exists(self.spark, f"{pending}/open"):
            return
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        files = hadoop(pending).getFileSystem(self.spark._jsc.hadoopConfiguration())
        for name, parts in PARTS.items():
            schema = self._schema(name)
            staged = self.spark.read.schema(schema).parquet(f"{pending}/{name}")
            staged.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *parts
            ).parquet(f"{self.root}/{name}")
        # Folders of ended versions that have none left.
        changed = {tuple(r) for r in self.spark.read.schema("chunk bigint, bucket int").parquet(f"{pending}/parts").collect()}
        filled = self.spark.read.schema(self._schema("closed")).parquet(f"{pending}/closed").select("chunk", "bucket").distinct()
        for chunk, bucket in changed - {tuple(r) for r in filled.collect()}:
            files.delete(hadoop(f"{self.root}/closed/chunk={chunk}/bucket={bucket}"), True)
        # The mark goes first: without it the rest is no longer applied.
        files.delete(hadoop(f"{pending}/open/_SUCCESS"), False)
        files.delete(hadoop(pending), True)
