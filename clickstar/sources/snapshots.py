"""Tables of files under a manifest: what a pointer names is the table, whatever else lies beside it.

A task writes its rows to files under new names and reports them; the commit lists them, with those of
the snapshot before, in a new manifest and turns the pointer to it.  A run that breaks leaves the old
snapshot as it was, and nothing is ever renamed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
import pyarrow.fs as arrow_fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from .filescan import file_system, footers, rows_of, schemas

FORMAT = "clickstar_snapshot"
POINTER = "CURRENT"
ROWS_PER_FILE = 1_000_000
MANIFEST = "uri string, rows bigint, snapshot string"
# Manifests that a snapshot consists of at most; then they are put together.
MANIFESTS = 32


@dataclass
class Written(WriterCommitMessage):
    """Files (name, rows) of one task."""

    files: list[tuple[str, int]]


class SnapshotWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.schema, self.root, self.snapshot = schema, options["path"].rstrip("/"), options["snapshot"]
        self.per_file, self.cut = int(options["rows"]), options.get("cut") or None

    def _parts(self, rows: pa.Table) -> Iterator[tuple[object, pa.Table]]:
        """Stretches of rows with one value of the column that cuts files."""
        if self.cut is None:
            yield None, rows
            return
        values = rows.column(self.cut).to_pylist()
        edges = [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1]), len(values)]
        for start, end in pairwise(edges):
            if end > start:
                yield values[start], rows.slice(start, end - start)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Write the rows of a task to files of at most ``rows`` rows, new ones where ``cut`` changes."""
        system, root = file_system(self.root)
        system.create_dir(f"{root}/data", recursive=True)
        target, files, out, room, known = to_arrow_schema(self.schema), [], None, 0, None
        for batch in iterator:
            for value, rows in self._parts(pa.Table.from_batches([batch]).cast(target)):
                while rows.num_rows:
                    if out is not None and (not room or value != known):
                        out.close()
                        out = None
                    if out is None:
                        name, room, known = f"data/{self.snapshot}-{uuid.uuid4().hex}.parquet", self.per_file, value
                        out = pq.ParquetWriter(system.open_output_stream(f"{root}/{name}"), target, compression="snappy")
                        files.append([name, 0])
                    part = rows.slice(0, room)
                    out.write_table(part)
                    files[-1][1] += part.num_rows
                    room -= part.num_rows
                    rows = rows.slice(part.num_rows)
        if out is not None:
            out.close()
        return Written([tuple(f) for f in files])

    def commit(self, messages: list[Written | None]) -> None:
        """List the files with those of the snapshot before and turn the pointer."""
        system, root = file_system(self.root)
        system.create_dir(f"{root}/manifests", recursive=True)
        before = head_of(self.root, current(self.root)) or {"snapshots": [], "manifests": []}
        lines = [{"uri": name, "rows": rows, "snapshot": self.snapshot} for m in messages if m for name, rows in m.files]
        text, manifests = "".join(json.dumps(line) + "\n" for line in lines), before["manifests"]
        if len(manifests) >= MANIFESTS:
            text = "".join(read_text(self.root, f"manifests/{m}.jsonl") for m in manifests) + text
            manifests = []
        write_text(system, f"{root}/manifests/{self.snapshot}.jsonl", text)
        head = {
            "snapshots": [*before["snapshots"], self.snapshot], "manifests": [*manifests, self.snapshot],
            "schema": json.loads(self.schema.json()),
        }
        write_text(system, f"{root}/manifests/{self.snapshot}.head.json", json.dumps(head))
        point_to(self.root, self.snapshot)

    def abort(self, messages: list[Written | None]) -> None:
        """Delete what the tasks that finished have written."""
        system, root = file_system(self.root)
        for message in messages:
            for name, _ in message.files if message else ():
                system.delete_file(f"{root}/{name}")


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> SnapshotWriter:
        return SnapshotWriter(schema, dict(self.options))


def write_text(system: arrow_fs.FileSystem, path: str, text: str) -> None:
    with system.open_output_stream(path) as out:
        out.write(text.encode())


def read_text(root: str, name: str) -> str | None:
    """A small file below a folder, None where there is none."""
    system, path = file_system(f"{root}/{name}")
    if system.get_file_info(path).type == arrow_fs.FileType.NotFound:
        return None
    with system.open_input_stream(path) as source:
        return source.read().decode()


def point_to(root: str, snapshot: str) -> None:
    """Make a snapshot the current one, also an earlier one again.

    File systems with folders replace the pointer by a move; object stores show a new object whole.
    """
    system, path = file_system(f"{root.rstrip('/')}/{POINTER}")
    if isinstance(system, (arrow_fs.LocalFileSystem, arrow_fs.HadoopFileSystem)):
        write_text(system, f"{path}.{snapshot}", snapshot)
        system.move(f"{path}.{snapshot}", path)
    else:
        write_text(system, path, snapshot)


def current(root: str) -> str | None:
    """Name of the current snapshot, if there is one."""
    return read_text(root.rstrip("/"), POINTER)


def head_of(root: str, snapshot: str | None) -> dict | None:
    """The snapshots and manifests that a snapshot consists of, and its schema."""
    return None if snapshot is None else json.loads(read_text(root.rstrip("/"), f"manifests/{snapshot}.head.json"))


def append(
    df: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE, cut: str | None = None, snapshot: str | None = None
) -> str:
    """Add rows to the table as a new snapshot and return its name, which must be new.

    Where the column ``cut`` changes within a task a new file begins.  One run writes at a time.
    """
    spark, root, snapshot = df.sparkSession, root.rstrip("/"), snapshot or uuid.uuid4().hex
    spark.dataSource.register(SnapshotSource)
    writer = df.write.format(FORMAT).option("path", root).option("snapshot", snapshot).option("rows", str(rows_per_file))
    (writer.option("cut", cut) if cut else writer).mode("append").save()
    return snapshot


def files_of(spark: SparkSession, root: str, snapshot: str | None = None) -> DataFrame:
    """(uri, rows, snapshot) of the files of a snapshot, or of the current one: its manifests as a table."""
    root = root.rstrip("/")
    head = head_of(root, snapshot or current(root))
    if head is None:
        return spark.createDataFrame([], MANIFEST)
    lines = spark.read.schema(MANIFEST).json([f"{root}/manifests/{name}.jsonl" for name in head["manifests"]])
    return lines.withColumn("uri", F.concat(F.lit(f"{root}/"), "uri"))


def read(spark: SparkSession, root: str, snapshot: str | None = None) -> DataFrame | None:
    """The rows of a snapshot, or of the current one; None where there is none yet.

    Names go from the manifests to the tasks that open the files, not through a list.
    """
    root = root.rstrip("/")
    snapshot = snapshot or current(root)
    if snapshot is None:
        return None
    schema = T.StructType.fromJson(head_of(root, snapshot)["schema"])
    found = footers(files_of(spark, root, snapshot).where("rows > 0").select("uri"))
    frames = [rows_of(found, text).drop("__file") for text in schemas(found)]
    out = spark.createDataFrame([], schema)
    for frame in frames:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def leftovers(spark: SparkSession, root: str) -> DataFrame:
    """Data files that the current snapshot does not name: remains of broken runs."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{root.rstrip('/')}/data").select("path")
        .withColumn("name", F.element_at(F.split("path", "/"), -1))
    )
    named = files_of(spark, root).select(F.element_at(F.split("uri", "/"), -1).alias("name"))
    return listed.join(named, "name", "left_anti").select("path")
