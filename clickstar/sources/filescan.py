"""Files whose names are rows: footers and contents are read inside the tasks.

The names may be as many as they like: they stay in a DataFrame, a task opens those of its partition,
and only the distinct schemas come to the driver.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as arrow_fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from ..session import scratch_path

# Rows of a file that are in memory at a time, bytes of a text file that are, and files per task.
ROWS = 10_000
TEXT_BYTES = 1 << 20
FILES_PER_TASK = 64
# Fixed value: where Spark keeps its own form of the schema in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a URI or local path, and the path in it."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return arrow_fs.LocalFileSystem(), uri
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return arrow_fs.FileSystem.from_uri(quote(uri, safe=":/@?&=%+"))


def _nullable(kind: object) -> object:
    """The JSON form of a type with NULL allowed everywhere, as files are read."""
    if isinstance(kind, list):
        return [_nullable(k) for k in kind]
    if not isinstance(kind, dict):
        return kind
    return {k: True if k in ("nullable", "containsNull", "valueContainsNull") else _nullable(v) for k, v in kind.items()}


def _spread(files: DataFrame) -> DataFrame:
    """A few files to a task, however many there are."""
    tasks = -(-files.count() // FILES_PER_TASK)
    least = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(tasks, least), *files.columns)


def footers(files: DataFrame, column: str = "uri") -> DataFrame:
    """``files`` with the schema (Spark's JSON), rows and row groups of each Parquet file, or an error.

    The footers are written once and read back, as several jobs use them.
    """
    names, place = files.columns, files.columns.index(column)

    def footer(uri: str) -> tuple:
        try:
            system, path = file_system(uri)
            with system.open_input_file(path) as source:
                data = pq.ParquetFile(source)
                own = (data.metadata.metadata or {}).get(SPARK_SCHEMA)
                schema = own.decode() if own else from_arrow_schema(data.schema_arrow).json()
                schema = json.dumps(_nullable(json.loads(schema)))
                return schema, data.metadata.num_rows, data.metadata.num_row_groups, None
        except Exception as error:  # whatever is wrong with a file is told in its row
            return None, 0, 0, f"{type(error).__name__}: {error}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [footer(uri) for uri in batch.column(place).to_pylist()]
            made = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, "schema", "rows", "groups", "error"])

    added = "schema string, rows bigint, groups bigint, error string"
    schema = T.StructType([*files.schema.fields, *T.StructType.fromDDL(added).fields])
    path = scratch_path(files.sparkSession, "footers")
    _spread(files).mapInArrow(run, schema).write.parquet(path)
    return files.sparkSession.read.schema(schema).parquet(path)


def schemas(found: DataFrame) -> list[str]:
    """The distinct schemas of :func:`footers`, the only thing that comes to the driver."""
    known = found.where("schema is not null").select("schema").distinct().orderBy("schema")
    return [r["schema"] for r in known.collect()]


def rows_of(found: DataFrame, schema: str, keep: Sequence[str] = (), column: str = "uri") -> DataFrame:
    """The rows of those files of :func:`footers` that have this schema, with the columns ``keep`` of
    their file in a struct ``__file``.

    A row group is read by one task, a few thousand rows at a time.
    """
    keep = list(dict.fromkeys([column, *keep]))
    fields = T.StructType.fromJson(json.loads(schema))
    file_type = found.select(*keep).schema
    groups = found.where((F.col("schema") == schema) & (F.col("groups") > 0)).select(
        *keep, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)).alias("group")
    )
    target, file_target = to_arrow_schema(fields), to_arrow_schema(file_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                group = row.pop("group")
                system, path = file_system(row[column])
                with system.open_input_file(path) as source:
                    data = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
                    for rows in data.iter_batches(ROWS, row_groups=[group]):
                        columns = [rows.column(f.name).cast(f.type) for f in target]
                        files = pa.array([row] * rows.num_rows, pa.struct(list(file_target)))
                        yield pa.RecordBatch.from_arrays([*columns, files], names=[*target.names, "__file"])

    out = T.StructType([*fields.fields, T.StructField("__file", file_type)])
    return _spread(groups).mapInArrow(run, out)


def _with_file(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    names = [n for n in rows.columns if n != "__file" and n not in keep]
    return rows.select(*[F.col(f"`{n}`") for n in names], *[F.col(f"__file.{n}").alias(n) for n in keep])


def parquet_rows(files: DataFrame, keep: Sequence[str] = (), column: str = "uri") -> DataFrame:
    """Rows of the Parquet files named in ``files`` with the columns ``keep`` of their file.

    Files may differ in their columns; what a file lacks is NULL.  A file that cannot be read fails
    the job and is named.
    """
    found = footers(files, column)
    broken = found.where("error is not null").first()
    if broken is not None:
        raise ValueError(f"cannot read {broken[column]}: {broken['error']}")
    parts = [_with_file(rows_of(found, schema, keep, column), keep) for schema in schemas(found)]
    if not parts:
        return files.select(*keep).limit(0)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def text_rows(files: DataFrame, keep: Sequence[str] = (), column: str = "uri", number: str | None = None) -> DataFrame:
    """Lines of the text files named in ``files`` (``value``, without their ends) with the columns
    ``keep`` of their file and, if ``number`` names a column for it, their number in the file from 0.
    Files that end in a name of a compression are unpacked; empty lines go and are not counted."""
    keep = list(dict.fromkeys([column, *keep]))
    file_type = files.select(*keep).schema
    file_target = pa.struct(list(to_arrow_schema(file_type)))

    def lines(uri: str) -> Iterator[list[str]]:
        system, path = file_system(uri)
        decode, rest = codecs.getincrementaldecoder("utf-8")("replace").decode, ""
        with system.open_input_stream(path) as source:
            while chunk := source.read(TEXT_BYTES):
                *whole, rest = (rest + decode(chunk)).replace("\r\n", "\n").split("\n")
                yield whole
            yield [rest + decode(b"", True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                count = 0
                for found in lines(row[column]):
                    found = [line for line in found if line.strip()]
                    if found:
                        places = pa.array(range(count, count + len(found)), pa.int64())
                        count += len(found)
                        columns = [pa.array(found, pa.string()), places, pa.array([row] * len(found), file_target)]
                        yield pa.RecordBatch.from_arrays(columns, names=["value", "__line", "__file"])

    out = T.StructType([
        T.StructField("value", T.StringType()), T.StructField("__line", T.LongType()), T.StructField("__file", file_type)
    ])
    rows = _with_file(_spread(files.select(*keep)).mapInArrow(run, out), keep)
    return rows.withColumnRenamed("__line", number) if number else rows.drop("__line")


def json_rows(schema: T.StructType | str, keep: Sequence[str] = ()):
    """A reader of JSON-lines files: ``files`` → rows of ``schema`` with the columns ``keep``."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def read(files: DataFrame) -> DataFrame:
        lines = text_rows(files, keep)
        return lines.select(F.from_json("value", fields).alias("row"), *keep).select("row.*", *keep)

    return read
