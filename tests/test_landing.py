"""Text leaves, harmonised schemas, batches, rewrite, routing and ledgers."""

import json
import random
import struct
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstar.functions.text import split_uri
from clickstar.sources import files, filescan, harmonize, leaves, ledger, seeds


def test_text_leaves(spark):
    df = spark.sql(
        "SELECT true AS is_paypal, 10 AS amount, named_struct('score', 1.5D, 'empty', null) AS metadata,"
        " array(named_struct('quantity', 2)) AS items, null AS nothing, CAST('ab' AS BINARY) AS raw,"
        " TIMESTAMP '2020-04-12 00:00:00' AS at, TIMESTAMP '2020-04-12 00:00:00.25' AS precise, DATE '2020-04-12' AS day,"
        " CAST(1.50 AS DECIMAL(10,2)) AS price, map('k', 1) AS extra"
    )
    got = leaves.with_text_leaves(df)
    assert got.first().asDict(recursive=True) == {
        "is_paypal": "true", "amount": "10", "metadata": {"score": "1.5", "empty": None}, "items": [{"quantity": "2"}],
        "nothing": None, "raw": "YWI=", "at": "2020-04-12T00:00:00+00:00", "precise": "2020-04-12T00:00:00.250000+00:00",
        "day": "2020-04-12", "price": "1.50", "extra": {"k": "1"},
    }
    assert got.schema["metadata"].dataType["empty"].dataType == T.StringType()
    assert got.schema["nothing"].dataType == T.StringType()


def test_float_text(spark):
    numbers = [0.0, 1.5, -2.0, 1e7, 123456789.125, 1e15, 1e16, -1.5e16, 1e22, 1e100, 0.001, 1e-4, 0.00012345, 1e-5, 1.5e-7, -3e-310,
               float("inf"), float("-inf"), float("nan"), 0.1, 9999999999999998.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)] + [(99, None)], "i int, x double")
    got = [r["x"] for r in leaves.with_text_leaves(df).orderBy(F.col("i").cast("int")).collect()]
    assert got == [str(x) for x in numbers] + [None]
    draw = random.Random(1)
    many = [draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randrange(-12, 17) for _ in range(20000)]
    many += [2.0**e for e in range(-60, 54)] + [draw.randrange(10**9) / 100 for _ in range(5000)]
    frame = spark.createDataFrame([(x,) for x in many], "x double").select("x", leaves.float_text(F.col("x")).alias("t"))
    assert [(r["x"], r["t"]) for r in frame.collect() if str(r["x"]) != r["t"]] == []
    # Any bits: the fewest digits, which read back; the last of many digits may be another that does.
    odd = [struct.unpack("<d", struct.pack("<Q", draw.getrandbits(64)))[0] for _ in range(30_000)]
    odd += [5e-324 * k for k in range(1, 500)] + [2.0**e for e in range(-1074, 1024, 3)] + [10.0**e for e in range(-323, 309)]
    odd += [float(draw.getrandbits(60)) for _ in range(5_000)]
    odd = [x for x in odd if x == x and abs(x) != float("inf")]
    frame = spark.createDataFrame([(x,) for x in odd], "x double").select("x", leaves.float_text(F.col("x")).alias("t"))
    rows = [(r["x"], r["t"]) for r in frame.collect()]
    assert all(float(t) == x and len(t) == len(repr(x)) for x, t in rows)
    assert sum(t != repr(x) for x, t in rows if abs(x) < 1e17) <= len(rows) // 500
    single = spark.sql("SELECT CAST(0.1 AS FLOAT) AS x")
    assert leaves.with_text_leaves(single).first()["x"] == "0.10000000149011612"


def test_binary_has_no_line_breaks(spark):
    df = spark.createDataFrame([(bytes(range(200)),)], "raw binary")
    assert "\n" not in leaves.with_text_leaves(df).first()["raw"]


def harmonized(spark, documents):
    df = spark.createDataFrame([(json.dumps(d),) for d in documents], "document string")
    return harmonize.harmonize_json(df, "document")


def test_lists_objects_and_plain_values(spark):
    got = harmonized(spark, [
        {"id": 1, "options": [{"alloy": "gold"}]}, {"id": 2, "options": {"alloy": "silver"}},
        {"id": 3, "options": "legacy-value"}, {"id": 4, "options": None},
    ])
    rows = [r["options"] for r in got.orderBy("id").collect()]
    assert rows == [[Row(_value=None, alloy="gold")], [Row(_value=None, alloy="silver")], [Row(_value="legacy-value", alloy=None)], None]


def test_scalars_become_text(spark):
    got = harmonized(spark, [{"items": [{"value": 10}]}, {"items": [{"value": "unknown"}]}, {"items": [{"value": True}]}])
    assert sorted(r["items"][0]["value"] for r in got.collect()) == ["10", "true", "unknown"]


def test_keys_are_united_and_sorted(spark):
    got = harmonized(spark, [{"b": {"z": 1}, "a": None}, {"b": {"y": {"q": 1}}, "c d.e": 1}])
    assert got.columns == ["a", "b", "c d.e"]
    assert [f.name for f in got.schema["b"].dataType.fields] == ["y", "z"]


def test_nested_lists(spark):
    got = harmonized(spark, [{"id": 1, "x": [[1, 2], 3]}, {"id": 2, "x": 4}, {"id": 3, "x": [{"k": [1]}, {"k": 5}]}])
    rows = {r["id"]: r["x"] for r in got.collect()}
    assert [[e["_value"] for e in inner] for inner in rows["1"]] == [["1", "2"], ["3"]]
    assert [[e["_value"] for e in inner] for inner in rows["2"]] == [["4"]]
    assert [[e["k"] for e in inner] for inner in rows["3"]] == [[["1"]], [["5"]]]


def test_rows_that_are_no_objects_are_dropped(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("[1]",), ("null",), (None,)], "document string")
    assert harmonize.harmonize_json(df, "document").collect() == [Row(a="1")]


def test_typed_frames(spark):
    a = spark.createDataFrame([(1, [1], True)], "id int, v array<int>, flag boolean")
    b = spark.createDataFrame([(2, 2.5, 3, "x")], "id bigint, v double, flag int, more string")
    got = harmonize.union_harmonized([a, b]).orderBy("id")
    assert [tuple(r) for r in got.select("id", "v", "flag", "more").collect()] == [(1, [1.0], 1, None), (2, [2.5], 3, "x")]


@pytest.mark.parametrize("a,b,want", [
    (T.BooleanType(), T.IntegerType(), T.LongType()), (T.IntegerType(), T.DoubleType(), T.DoubleType()),
    (T.DateType(), T.TimestampType(), T.TimestampType()), (T.DateType(), T.LongType(), T.StringType()),
    (T.NullType(), T.DateType(), T.DateType()),
])
def test_common_scalar(a, b, want):
    assert harmonize.common_type(a, b) == want == harmonize.common_type(b, a)


def test_exact_batches(spark):
    ids = spark.createDataFrame([(f"{i:024x}",) for i in (7, 3, 900, 12, 5)], "_id string")
    number = F.conv(F.substring("_id", 10, 15), 16, 10).cast("bigint")
    buckets = [F.shiftright(number, 8), F.shiftright(number, 2)]
    numbered = files.number_files(ids, "_id", buckets, 2)
    planned = files.manifest(numbered, "_id")
    assert [r["document_count"] for r in planned.orderBy("file_no").collect()] == [2, 2, 1]
    state = files.load_state(planned, "data/").first()
    assert (state["next_file_number"], state["documents_uploaded"], state["last_object"]) == (4, 5, "data/3.parquet")
    assert state["last_mongo_id"] == f"{900:024x}"
    changed = planned.withColumn("document_count", F.col("document_count") + (F.col("file_no") == 3).cast("int"))
    states = files.compare_manifests(planned, changed.where("file_no > 1")).orderBy("file_no")
    assert [r["state"] for r in states.collect()] == ["new", "recovered", "conflict"]
    with pytest.raises(ValueError):
        files.number_files(ids, "_id", buckets, 0)


def test_batches_are_committed_once(spark, tmp_path):
    def commit(rows):
        ids = spark.createDataFrame([(f"{i:024d}", v) for i, v in rows], "_id string, v string")
        numbered = files.number_files(ids, "_id", [F.floor(F.col("_id").cast("bigint") / 4)], 2)
        states = files.commit_batches(spark, numbered, "_id", str(tmp_path / "b")).orderBy("file_no")
        return [r["state"] for r in states.collect()]

    rows = [(i, "a") for i in range(5)]
    assert commit(rows[:4]) == ["new", "new"]
    assert commit(rows) == ["recovered", "recovered", "new"]
    assert spark.read.parquet(str(tmp_path / "b/data")).count() == 5
    with pytest.raises(ValueError):
        commit([(i + 10, "a") for i in range(2)])


def test_rank_over_several_levels(spark):
    ids = spark.range(0, 5000, 7).withColumn("id", (F.col("id") * 37) % 5003)
    buckets = [F.shiftright("id", 9), F.shiftright("id", 6), F.shiftright("id", 3)]
    got = [r["rank"] for r in files.global_rank(ids, "id", buckets).orderBy("id").collect()]
    assert got == list(range(1, len(got) + 1))


def test_remote_state_wins(spark):
    remote, local, none = spark.range(1, 2), spark.range(2, 3), spark.range(0)
    assert files.preferred_state(remote, local).first()["id"] == 1
    assert files.preferred_state(none, local).first()["id"] == 2


def test_rewrite(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    spark.sql("SELECT 1 AS a, array(2) AS b").coalesce(1).write.parquet(f"{source}/x")
    spark.sql("SELECT 'q' AS a, named_struct('z', 1, 'y', 2) AS b").coalesce(1).write.parquet(f"{source}/y")
    (source / "broken.parquet").write_bytes(b"no parquet")
    result = {r["status"]: r["rows"] for r in files.rewrite_files(spark, str(source), str(target)).groupBy("status").agg(F.sum("rows").alias("rows")).collect()}
    assert result == {"migrated": 2, "failed": 0}
    again = {r["status"] for r in files.rewrite_files(spark, str(source), str(target)).collect()}
    assert again == {"skipped", "failed"}
    names = {r["source_file"].split("/")[0] for r in spark.read.parquet(str(target)).select("source_file").collect()}
    assert names == {"x", "y"}
    for bad in (str(source), f"{source}/inner"):
        with pytest.raises(ValueError):
            files.rewrite_files(spark, str(source), bad)


def test_rewrite_tells_equal_names_apart(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for folder, rows in (("a b", 2), ("c", 3), ("c/d", 4)):
        (tmp_path / "in" / folder).mkdir(parents=True)
        pq.write_table(pa.table({"v": list(range(rows))}), tmp_path / "in" / folder / "1.parquet")
    for source in (f"file://{tmp_path}/in/", str(tmp_path / "in")):
        done = files.rewrite_files(spark, source, str(tmp_path / "out"))
        assert sorted(r["rows"] for r in done.collect()) in ([2, 3, 4], [0, 0, 0])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
    first = files.rewrite_files(spark, str(tmp_path / "in"), str(tmp_path / "one"), max_files=1)
    assert first.count() == 1


def test_compliant_lists(spark, tmp_path):
    import pyarrow.parquet as pq

    files.write_documents(spark.sql("SELECT array('a') AS l").coalesce(1), str(tmp_path / "p"))
    written = pq.ParquetFile(next((tmp_path / "p").glob("*.parquet")))
    assert written.schema.column(0).path == "l.list.element"
    assert written.metadata.row_group(0).column(0).compression == "SNAPPY"


NAMES = [
    ("landing", "mongodb_data_string/12.parquet", "raw_mongo"), ("landing", "location_data/a.JSONL", "raw_location"),
    ("landing", "product_data/a.jsonl", "raw_product"), ("landing", "exchange_rate_data/a.jsonl", "raw_exchange_rate"),
    ("other", "mongodb_data_string/12.parquet", None), ("landing", "Location_data/a.jsonl", None),
    ("landing", "product_data/a.parquet", None), ("landing", "mongodb_data_string/_checkpoint.json", None),
]


def test_routes(spark):
    df = spark.createDataFrame([(b, n, 1) for b, n, _ in NAMES], "bucket string, name string, generation long")
    got = {(r["bucket"], r["name"]): r["destination"] for r in ledger.route_files(df, "landing").collect()}
    assert got == {(b, n): d for b, n, d in NAMES if d}
    with pytest.raises(Exception, match="needs a"):
        ledger.route_files(spark.createDataFrame([(None, None, 1)], "bucket string, name string, generation long"), "landing").collect()


def file_of(folder):
    return str(next(p for p in folder.iterdir() if p.suffix == ".json" and p.stat().st_size))


def test_append_once(spark, tmp_path):
    def announced(*rows):
        return spark.createDataFrame(
            [("b", f"location_data/{n}", g, file_of(tmp_path / n), "raw_location") for n, g in rows],
            "bucket string, name string, generation long, uri string, destination string",
        )

    for n in ("x", "y"):
        spark.createDataFrame([(n,)], "v string").write.json(str(tmp_path / n))
    root = str(tmp_path / "landing")
    read = filescan.json_rows("v string", ["batch"])
    ledger.append_once(spark, announced(("x", 1), ("x", 1)), root, "raw_location", read)
    ledger.append_once(spark, announced(("x", 1), ("y", 1)), root, "raw_location", read)
    rows = lambda: sorted(r["v"] for r in spark.read.parquet(f"{root}/raw_location").collect())
    assert rows() == ["x", "y"]
    ledger.append_once(spark, announced(("x", 2)), root, "raw_location", read)
    assert rows() == ["x", "x", "y"]


def test_broken_append_is_finished(spark, tmp_path):
    spark.createDataFrame([("x",)], "v string").write.json(str(tmp_path / "x"))
    files_df = spark.createDataFrame([("b", "location_data/x", 1, file_of(tmp_path / "x"), "raw_location")],
                                     "bucket string, name string, generation long, uri string, destination string")
    root = str(tmp_path / "landing")

    def fail(arrived):
        raise RuntimeError("lost")

    (tmp_path / "landing" / "ledger" / "raw_location" / "batch=0" / "_temporary").mkdir(parents=True)
    with pytest.raises(RuntimeError):
        ledger.append_once(spark, files_df, root, "raw_location", fail)
    for _ in range(2):
        ledger.append_once(spark, files_df, root, "raw_location", filescan.json_rows("v string", ["batch"]))
    assert spark.read.parquet(f"{root}/raw_location").count() == 1


def test_mapping_check(spark):
    observed = spark.createDataFrame([("€",), ("kr",), ("$",)], "raw_currency string")
    rows = [(" € ", "eur", "Euro"), ("€", "EUR", "Euro"), ("kr", "SEK", "a"), ("kr", "SEK", "b"), ("$", "US", "x"), ("£", "GBP", "y")]
    proposed = spark.createDataFrame(rows, seeds.MAPPING_SCHEMA)
    got = {(r["raw_currency"], r["currency_name"]): r["problem"] for r in seeds.checked_mapping(proposed, observed).collect()}
    assert got == {("€", "Euro"): None, ("kr", "a"): "conflicting rows", ("kr", "b"): "conflicting rows", ("$", "x"): "bad code", ("£", "y"): "not observed"}
    assert [r["currency_code"] for r in seeds.valid_mapping(proposed, observed).collect()] == ["EUR"]
    with pytest.raises(ValueError):
        seeds.checked_mapping(proposed.drop("currency_name"), observed)


def test_seed_file(spark, tmp_path):
    mapping = seeds.currency_mapping(spark)
    mapping.coalesce(1).write.option("header", True).csv(str(tmp_path / "seed"))
    assert sorted(seeds.read_seed(spark, str(tmp_path / "seed")).collect()) == sorted(mapping.collect())
    assert mapping.count() == 35


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("2", "b", ("2",)), ("1", None, ("1",))], "product_id string, name string, _crawl struct<id:string>")
    files.export_products(df, str(tmp_path / "p"))
    files.export_products(df, str(tmp_path / "p"), metadata=False)
    lines = [json.loads(line) for part in sorted((tmp_path / "p").glob("part-*")) for line in part.read_text().splitlines()]
    assert lines == [{"product_id": "1", "name": None}, {"product_id": "2", "name": "b"}]


def test_failure_export(spark, tmp_path):
    df = spark.sql("SELECT '1' AS product_id, 'u' AS url, 'e' AS last_error, 2L AS occurrences, '2020' AS last_failed_at, CAST(null AS STRING) AS recovered_via")
    files.export_failures(df, str(tmp_path / "f"))
    line = json.loads(next((tmp_path / "f").glob("part-*")).read_text())
    assert line == {"product_id": "1", "failed_url": "u", "last_error": "e", "occurrences": 2, "last_failed_at": "2020", "recovered_via": None}


def test_report(spark):
    df = spark.sql("SELECT 1 AS a, array(1) AS b")
    got = [tuple(r) for r in files.load_report(df).orderBy("position").collect()]
    assert got == [(1, 0, "a", "int", "REQUIRED"), (1, 1, "b", "array<int>", "REPEATED")]


def test_one_reader_decides_shape_and_rows(spark):
    deep = '{"a": ' + "[" * 900 + "]" * 900 + "}"
    texts = [
        '\n{"id": 1}', '\t\r\n {"id": 2, "b": [1]}', '{"n": NaN}', '{"k": 1, "k": 2}', '{"x": 1} y', "[{}]", None, "", ' {"z": 1}, {"z": 2}', '{"u": "\\ud83d\\ude00"}',
    ]
    documents = spark.createDataFrame(list(enumerate(texts)), "i int, document string")
    rows = harmonize.harmonize_json(documents, "document", ["i"])
    assert rows.columns == ["i", "b", "id", "u"]
    assert sorted((r.i, r.id, r.u) for r in rows.collect()) == [(0, "1", None), (1, "2", None), (9, None, "😀")]
    assert sorted(r.i for r in harmonize.rejected_documents(documents, "document").collect()) == [2, 3, 4, 5, 6, 7, 8]
    shape = harmonize.document_shape(spark.createDataFrame([(deep,)], "document string"), "document")
    assert list(shape.keys) == ["a"]


def test_objects_keyed_by_ids_become_maps(spark):
    rng = random.Random(4)
    rows, want = [], {}
    for i in range(300):
        ids = {f"u{rng.randrange(5_000)}": rng.choice([None, i, {"n": i}, {"n": "x", "m": [1]}]) for _ in range(8)}
        nested = {f"d{rng.randrange(200)}": {f"e{rng.randrange(900)}": i for _ in range(3)} for _ in range(3)}
        document = {"id": i, "by_user": ids, "nested": nested, "small": {"a": 1, f"b{i % 3}": None}, "odd": rng.choice([7, {f"k{i}": 1.5}])}
        rows.append((json.dumps(document),))
        want[i] = document
    out = harmonize.harmonize_json(spark.createDataFrame(rows, "document string"), "document", max_keys=100)
    assert dict(out.dtypes) == {
        "id": "string", "by_user": "map<string,struct<_value:string,m:array<string>,n:string>>",
        "nested": "map<string,map<string,string>>", "odd": "map<string,string>",
        "small": "struct<a:string,b0:string,b1:string,b2:string>",
    }
    for row in out.collect():
        document = want[int(row.id)]
        assert row.nested == {k: {e: str(v) for e, v in inner.items()} for k, inner in document["nested"].items()}
        assert row.odd == ({"_value": "7"} if document["odd"] == 7 else {k: "1.5" for k in document["odd"]})
        for key, value in document["by_user"].items():
            got = row.by_user[key]
            if value is None:
                assert got is None
            elif isinstance(value, dict):
                assert (got["n"], got["m"]) == (str(value["n"]), ["1"] if "m" in value else None)
            else:
                assert got["_value"] == str(value)
    # The fields of the documents themselves stay columns, however many.
    wide = spark.createDataFrame([(json.dumps({f"f{i}": i, "same": 1}),) for i in range(30)], "document string")
    assert len(harmonize.harmonize_json(wide, "document", max_keys=10).columns) == 31
