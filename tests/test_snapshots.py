"""Tables under a manifest: a broken run leaves what was there."""

import os

import pytest
from pyspark.sql import functions as F

from clickstar.sources import files, snapshots


@pytest.fixture
def frame(spark):
    return spark.sql(
        "SELECT id, array(named_struct('a', id, 'b', cast(id AS string))) l, timestamp_seconds(id) t, map('k', id) m,"
        " if(id % 3 = 0, NULL, cast(id AS decimal(12,2))) d FROM range(40)"
    )


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_snapshots_of_a_table(spark, tmp_path, frame):
    root = f"{tmp_path}/table"
    assert snapshots.read(spark, root) is None and snapshots.files_of(spark, root).count() == 0
    first = snapshots.append(frame.where("id < 25").repartition(3), root, rows_per_file=4)
    assert ids(snapshots.read(spark, root)) == list(range(25))
    assert snapshots.read(spark, root).schema == frame.schema or snapshots.read(spark, root).columns == frame.columns
    sizes = [r["rows"] for r in snapshots.files_of(spark, root).collect()]
    assert sum(sizes) == 25 and max(sizes) == 4
    second = snapshots.append(frame.where("id >= 25"), root)
    assert ids(snapshots.read(spark, root)) == list(range(40))
    assert sorted(map(str, snapshots.read(spark, root).collect())) == sorted(map(str, frame.collect()))
    assert ids(snapshots.read(spark, root, first)) == list(range(25))
    snapshots.point_to(root, first)
    assert ids(snapshots.read(spark, root)) == list(range(25)) and snapshots.leftovers(spark, root).count() >= 1
    snapshots.point_to(root, second)
    assert snapshots.leftovers(spark, root).count() == 0
    # Nothing to add is a snapshot as well.
    snapshots.append(frame.where("false"), root)
    assert ids(snapshots.read(spark, root)) == list(range(40))


def test_a_broken_run_leaves_the_table(spark, tmp_path, frame):
    root = f"{tmp_path}/table"
    snapshots.append(frame.where("id < 5"), root)
    fails = F.when(F.col("id") == 39, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("id"))
    with pytest.raises(Exception, match="lost"):
        snapshots.append(frame.repartition(4, "id").withColumn("id", fails), root)
    assert ids(snapshots.read(spark, root)) == list(range(5))
    snapshots.append(frame.where("id >= 5"), root)
    assert ids(snapshots.read(spark, root)) == list(range(40))


def test_manifests_are_put_together(spark, tmp_path, frame, monkeypatch):
    root = f"{tmp_path}/table"
    # The commit runs in a process of its own, which gets the module by value.
    monkeypatch.setattr(snapshots, "MANIFESTS", 3)
    for i in range(8):
        snapshots.append(frame.where(f"id % 8 = {i}"), root)
        head = snapshots.head_of(root, snapshots.current(root))
        assert len(head["manifests"]) <= 4 and len(head["snapshots"]) == i + 1
    assert ids(snapshots.read(spark, root)) == list(range(40))


def test_one_file_per_batch_and_a_manifest_that_counts_with_its_snapshot(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")

    def commit(count):
        frame = spark.sql(f"SELECT lpad(id, 24, '0') AS _id FROM range({count})")
        numbered = files.number_files(frame, "_id", [F.floor(F.col("_id").cast("bigint") / 16)], 10)
        return sorted(r["state"] for r in files.commit_batches(spark, numbered, "_id", path).collect())

    with pytest.raises(ValueError):
        files.read_batches(spark, path)
    assert commit(30) == ["new"] * 3
    assert [r["rows"] for r in snapshots.files_of(spark, path).collect()] == [10] * 3
    # Lost after the manifest of the run was written, before its snapshot was.
    with monkeypatch.context() as broken:
        broken.setattr(snapshots, "append", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            commit(50)
    assert files.read_batches(spark, path).count() == 30
    assert len(os.listdir(f"{path}/batches")) == 2
    assert commit(50) == ["new"] * 2 + ["recovered"] * 3
    assert files.read_batches(spark, path).count() == 50
    assert commit(50) == ["recovered"] * 5
