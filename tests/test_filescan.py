"""Files named by rows: footers, contents and statuses without lists in the driver."""

import gzip
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from clickstar.sources import files, filescan


@pytest.fixture
def collected(monkeypatch):
    """Rows that each collect brings to the driver."""
    sizes, collect = [], DataFrame.collect

    def counted(self):
        rows = collect(self)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(DataFrame, "collect", counted)
    return sizes


def test_a_hundred_thousand_names_stay_in_tables(spark, tmp_path, collected):
    folder = tmp_path / "in"
    folder.mkdir()
    pq.write_table(pa.table({"v": [1, 2]}), folder / "0.parquet")
    pq.write_table(pa.table({"v": ["x"]}), folder / "1.parquet")
    for i in range(2, 100_000):
        os.link(folder / f"{i % 2}.parquet", folder / f"{i}.parquet")
    (folder / "broken.parquet").write_bytes(b"no parquet")
    found = filescan.footers(files.list_files(spark, str(folder), "*.parquet").select("path", "name"), "path")
    assert len(filescan.schemas(found)) == 2
    assert max(collected) <= 2
    total = found.agg(F.sum("rows"), F.count("error"), F.count("schema")).first()
    assert tuple(total) == (150_000, 1, 100_000)


def test_rewriting_brings_no_names_to_the_driver(spark, tmp_path, collected):
    for i in range(40):
        (tmp_path / "in" / f"f{i % 4}").mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"v": pa.array([i] * (i % 3), pa.int64())}), tmp_path / "in" / f"f{i % 4}" / f"{i}.parquet")
    status = files.rewrite_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert max(collected) == 1
    assert status.agg(F.sum("rows"), F.count("*")).first() == (39, 40)
    again = files.rewrite_files(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [tuple(r) for r in again.groupBy("status").count().collect()] == [("skipped", 40)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 39


def test_types_are_those_that_spark_reads(spark, tmp_path):
    wide = spark.sql(
        "SELECT id, cast(id AS short) s, timestamp_seconds(id) t, cast(timestamp_seconds(id) AS timestamp_ntz) n,"
        " date_add(date'2020-01-01', cast(id AS int)) d, cast(id AS decimal(20,4)) m, array(named_struct('a', id, 'b', 'x')) l,"
        " map('k', id) p, cast('ab' AS binary) y, if(id % 2 = 0, NULL, 1.5F) f FROM range(2500)"
    )
    wide.repartition(3).write.option("maxRecordsPerFile", 300).parquet(str(tmp_path / "in"))
    listed = files.list_files(spark, str(tmp_path / "in"), "*.parquet").select(F.col("path").alias("uri"), "name")
    rows = filescan.parquet_rows(listed, ["name"])
    assert rows.drop("name").schema == spark.read.parquet(str(tmp_path / "in")).schema
    assert sorted(map(str, rows.drop("name").collect())) == sorted(map(str, wide.collect()))
    assert rows.select("name").distinct().count() == listed.count()


def test_columns_that_some_files_lack(spark, tmp_path):
    pq.write_table(pa.table({"a": [1], "uri": ["own"]}), tmp_path / "1.parquet")
    pq.write_table(pa.table({"a": [2], "b": ["x"]}), tmp_path / "2.parquet")
    listed = spark.createDataFrame([(f"{tmp_path}/{i}.parquet", f"b{i}") for i in (1, 2)], "uri string, batch string")
    rows = filescan.parquet_rows(listed, ["batch"])
    assert sorted(map(str, rows.select("a", "b", "uri", "batch").collect())) == [
        "Row(a=1, b=None, uri='own', batch='b1')", "Row(a=2, b='x', uri=None, batch='b2')"
    ]
    assert filescan.parquet_rows(listed.where("false"), ["batch"]).count() == 0
    (tmp_path / "3.parquet").write_bytes(b"")
    with pytest.raises(ValueError, match="3.parquet"):
        filescan.parquet_rows(spark.createDataFrame([(f"{tmp_path}/3.parquet", "b")], "uri string, batch string"))


def test_lines_of_text_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filescan, "TEXT_BYTES", 7)
    text = '{"v": "é€😀"}\r\n\n{"v": "b", "w": 2}\n{"v": 3}\nbroken\n{"v": "last"}'
    (tmp_path / "a b.jsonl").write_text(text, "utf-8", newline="")
    (tmp_path / "c.jsonl.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "empty.jsonl").write_bytes(b"")
    uris = [f"{tmp_path}/a b.jsonl", f"file:{tmp_path}/c.jsonl.gz", f"file://{tmp_path}/empty.jsonl"]
    listed = spark.createDataFrame([(u, str(i)) for i, u in enumerate(uris)], "uri string, batch string")
    rows = filescan.json_rows("v string, w int", ["batch"])(listed).collect()
    one = [("3", None), ("b", 2), ("last", None), ("é€😀", None), (None, None)]
    for batch in ("0", "1"):
        assert sorted(((r.v, r.w) for r in rows if r.batch == batch), key=str) == sorted(one, key=str)
    assert len(rows) == 10
