"""Streams give the batch result, once."""

from pyspark.sql import functions as F

from clickstar.operators import failures
from clickstar.streaming import ingest, state_tables


def test_files_arrive_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    spark.range(5).write.parquet(source)
    stream = lambda: ingest.file_stream(spark, source, spark.range(1).schema)
    for _ in range(2):
        ingest.append_stream(stream(), target, checkpoint)
    assert spark.read.parquet(target).count() == 5
    spark.range(5, 7).write.mode("append").parquet(source)
    ingest.append_stream(stream(), target, checkpoint)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(7))


def test_routes(spark, tmp_path):
    bucket = tmp_path / "bucket"
    for name, text in (("location_data/a.JSONL", '{"ip": "1"}'), ("location_data/b.txt", '{"ip": "2"}'), ("other/c.jsonl", '{"ip": "3"}')):
        (bucket / name).parent.mkdir(parents=True, exist_ok=True)
        (bucket / name).write_text(text)
    schemas = {"raw_location": spark.createDataFrame([], "ip string").schema}
    run = lambda: ingest.ingest_routes(spark, str(bucket), schemas, str(tmp_path / "t"), str(tmp_path / "m"))
    assert run() == ["raw_location"]
    (bucket / "location_data/d.jsonl").write_text('{"ip": "4"}')
    run()
    assert sorted(r["ip"] for r in spark.read.parquet(str(tmp_path / "t/raw_location")).collect()) == ["1", "4"]


ATTEMPT = "product_id string, url string, error string, ts int, recovered_via string"


def test_failures_add_up_over_runs(spark, tmp_path):
    source, state, checkpoint = (str(tmp_path / n) for n in ("in", "state", "offsets"))
    runs = [[("1", "u", "a", 1, "v"), ("1", "u", "b", 2, "v")], [("1", "u", "c", 3, None), ("2", "u", "d", 1, None)]]
    for rows in runs:
        df = spark.createDataFrame(rows, ATTEMPT)
        df.write.mode("append").parquet(source)
        state_tables.stream_failures(ingest.file_stream(spark, source, df.schema), state, checkpoint)
    streamed = sorted(map(tuple, state_tables.current_failures(spark, state).collect()))
    batch = failures.failure_ledger(spark.createDataFrame([r for rows in runs for r in rows], ATTEMPT))
    assert streamed == sorted(map(tuple, batch.select(*state_tables.current_failures(spark, state).columns).collect()))


EVENT = "_id string, collection string, product_id string, viewing_product_id string, current_url string, referrer_url string"


def test_first_urls_over_runs(spark, tmp_path):
    source, state, checkpoint = (str(tmp_path / n) for n in ("in", "state", "offsets"))
    for run in range(3):
        rows = [(f"{run}{i}", "view_product_detail", "p", None, f"https://x/{(run + i) % 4}", None) for i in range(3)]
        df = spark.createDataFrame(rows, EVENT)
        df.write.mode("append").parquet(source)
        state_tables.stream_candidates(ingest.file_stream(spark, source, df.schema), state, checkpoint)
    got = sorted((r["priority"], r["url"]) for r in state_tables.current_candidates(spark, state).collect())
    assert got == [(0, "https://x/0"), (1, "https://x/1"), (2, "https://x/2")]
    merged = str(tmp_path / "merged")
    state_tables.compact_deltas(
        spark, state, lambda d: d.groupBy("product_id", "url").agg(F.min("_id").alias("_id"), F.min_by("source", "_id").alias("source")), merged)
    assert state_tables.current_candidates(spark, merged).count() == 3


def test_increments_drop_late_rows(spark, tmp_path):
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "offsets"))
    for rows in ([(1, 5), (2, 6)], [(3, 4), (4, 7)]):
        df = spark.createDataFrame(rows, "k int, t int")
        df.coalesce(1).write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, df.schema)
        state_tables.stream_increments(stream, table, checkpoint, ["k"], "t")
    assert sorted(r["k"] for r in spark.read.parquet(table).collect()) == [1, 2, 4]


def counted(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def test_many_batches_leave_few_folders(spark, tmp_path):
    from clickstar.streaming.levels import Levels, overfull

    # Folder counts alone, for a thousand batches.
    levels, most = [[]], 0
    for batch in range(1_000):
        levels[0].append(str(batch))
        while (full := overfull(levels, 8)) is not None:
            levels[full] = []
            if full + 1 == len(levels):
                levels.append([])
            levels[full + 1].append("merged")
        most = max(most, sum(map(len, levels)))
    assert most <= 7 * 4
    # With real folders.
    table = Levels(spark, str(tmp_path / "t"), counted, fan=2)
    for batch in range(12):
        delta = spark.createDataFrame([(batch % 3, 1)], "k int, n long")
        assert table.add(delta, "q", batch)
        # The batch again counts once.
        assert not table.add(delta, "q", batch)
        assert len(table.folders()) <= 4
    table.add(spark.createDataFrame([(0, 5)], "k int, n long"), "other", 0)
    assert sorted(tuple(r) for r in counted(table.read()).collect()) == [(0, 9), (1, 4), (2, 4)]


def test_a_merge_that_breaks_counts_nothing_twice(spark, tmp_path):
    import pytest

    from clickstar.streaming.levels import Levels

    broken = []

    def merge(df):
        if broken:
            raise RuntimeError("lost")
        return counted(df)

    table = Levels(spark, str(tmp_path / "t"), merge, fan=2)
    one = lambda k: spark.createDataFrame([(k, 1)], "k int, n long")
    table.add(one(1), "q", 0)
    broken.append(1)
    with pytest.raises(RuntimeError):
        table.add(one(1), "q", 1)
    assert [tuple(r) for r in counted(table.read()).collect()] == [(1, 1)]
    broken.clear()
    assert table.add(one(1), "q", 1)
    assert [tuple(r) for r in counted(table.read()).collect()] == [(1, 2)]
    with pytest.raises(ValueError):
        Levels(spark, "t", merge, fan=1)
