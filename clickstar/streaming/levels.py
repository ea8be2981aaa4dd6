"""Deltas in levels: what every read has to merge stays small, however many batches there were.

Batches write a folder each.  When a level has ``fan`` folders they are merged into one of the next
level, so that after n batches there are at most ``fan`` folders on each of log n levels.  A manifest
names the folders that count and the last batch of each query that is in them; a pointer names the
manifest.  A batch that is replayed finds itself counted; a run that breaks leaves folders that nothing
names.  One run writes to a table at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import path_exists
from ..sources import snapshots
from ..sources.filescan import file_system

FAN = 8


def overfull(levels: list[list[str]], fan: int) -> int | None:
    """The lowest level that has to be merged into the next one."""
    return next((i for i, folders in enumerate(levels) if len(folders) >= fan), None)


class Levels:
    """The deltas of a table; ``merge`` makes one delta of several and may be applied again and again."""

    def __init__(self, spark: SparkSession, table: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        if fan < 2:
            raise ValueError("a level holds two folders at least")
        self.spark, self.table, self.merge, self.fan = spark, table.rstrip("/"), merge, fan
        self._state = f"{self.table}/_state"

    def manifest(self) -> dict:
        name = snapshots.current(self._state)
        if name is None:
            return {"done": {}, "levels": [[]]}
        return json.loads(snapshots.read_text(self._state, f"{name}.json"))

    def add(self, delta: DataFrame, query: str, batch: int) -> bool:
        """Count a batch of a query; false if it was counted before."""
        manifest = self.manifest()
        if batch <= manifest["done"].get(query, -1):
            return False
        folder = f"query_id={query}/batch_id={batch}"
        delta.write.mode("overwrite").parquet(f"{self.table}/{folder}")
        levels = manifest["levels"]
        levels[0].append(folder)
        manifest["done"][query] = batch
        dropped: list[str] = []
        while (full := overfull(levels, self.fan)) is not None:
            merged = f"_merged/level={full + 1}/{uuid.uuid4().hex}"
            self.merge(self._read(levels[full])).write.parquet(f"{self.table}/{merged}")
            dropped += levels[full]
            levels[full] = []
            if full + 1 == len(levels):
                levels.append([])
            levels[full + 1].append(merged)
        self._commit(manifest)
        self._delete(dropped)
        return True

    def _commit(self, manifest: dict) -> None:
        system, path = file_system(self._state)
        system.create_dir(path, recursive=True)
        before, name = snapshots.current(self._state), uuid.uuid4().hex
        snapshots.write_text(system, f"{path}/{name}.json", json.dumps(manifest))
        snapshots.point_to(self._state, name)
        if before is not None:
            system.delete_file(f"{path}/{before}.json")

    def _delete(self, folders: list[str]) -> None:
        """Folders that are merged and no longer named; they may be gone or still lie about."""
        for folder in folders:
            system, path = file_system(f"{self.table}/{folder}")
            system.delete_dir_contents(path, missing_dir_ok=True)

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.table}/{folder}" for folder in folders])

    def folders(self) -> list[str]:
        return [folder for level in self.manifest()["levels"] for folder in level]

    def read(self) -> DataFrame:
        """All deltas that count, a bounded number of folders; not merged among themselves."""
        if snapshots.current(self._state) is None and path_exists(self.spark, self.table):
            # A table of one compacted delta, or of deltas from before there were manifests.
            whole = self.spark.read.parquet(self.table)
            return whole.drop("query_id", "batch_id")
        return self._read(self.folders())
