"""What a job at size does once instead of often: scans of files, white space, lookups of addresses."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from clickstar.functions.price import plain_number
from clickstar.functions.text import WHITE_SPACE, store_domain, trim_quick, trim_ws
from clickstar.functions.time import parse_epoch
from clickstar.plans import adapter, dims, sales
from clickstar.plans.warehouse import Warehouse
from test_daily import EVENTS, order, sources  # noqa: F401
from test_plans import formatted

LINES = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string"


def test_quick_trim_is_the_whole_one(values):
    texts = [None, "", " ", "a", " a b ", "é", "\x7f", " \x7f ", "a\x00 ", "\x00", "~", "!", " ~\x7f"]
    texts += [left + "x y" + right for left in (*WHITE_SPACE, "", " \t") for right in ("　", "\n", " ", "", "\x1f ", "\xa0")]
    assert values(trim_quick, texts) == values(trim_ws, texts)


def test_store_domain_without_patterns(values):
    urls = {
        None: None, "": None, "http://": None, "http://:80": None, "http:///x.y": None, "https://a": None, "https://a.B": ".b", "HTTP://a.b": None,
        "http://a.b:80/x": ".b", "http://a.co.UK?y": ".uk?y", "https://a.": None, "https://a..": None, "https://.com": ".com", "http://a.b.\n": ".\n",
        " http://a.b": None, "ftp://a.b": None, "http://a/b.c": None,
    }
    assert values(store_domain, list(urls)) == list(urls.values())


def test_formats_are_told_apart_as_before(values):
    texts = {"1,234": "1.234", "1.234,5": "1234.5", "1,234.5": "1234.5", "1.2.3": "1.2.3", "1,2,3": "1,2,3", "12,5\n'": "12.5\n", " 5 ": "5", " ": None}
    assert values(plain_number, list(texts)) == list(texts.values())


def test_times_out_of_range_are_unknown(values):
    texts = ["253402300800", "-62135596801", "x", None, str(10**18)]
    assert values(lambda c: parse_epoch(c).cast("string"), texts) == [None] * 5
    assert values(lambda c: parse_epoch(c).cast("string"), [" 60\u3000"]) == ["1970-01-01 00:01:00"]


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(2000, 1, 1)
    orders = [(i, i % 7, day + dt.timedelta(i % 40) if i % 13 else None, "1-URGENT") for i in range(120)] + [(None, 1, day, "x"), (3, 2, day, "y")]
    lines = [(i % 110, i, i % 5, i % 8, 2.0, 31.5 * i) for i in range(300)] + [(None, 1, 1, 3, 1.0, 1.0), (5, 1, 1, None, 1.0, 1.0)]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_documents_lie_by_time(spark, tables, monkeypatch):
    whole = adapter.checkout_events(spark, tables)
    assert "lambda" not in formatted(whole)
    monkeypatch.setattr(adapter, "FILE_DOCUMENTS", 50)
    laid = adapter.checkout_events(spark, tables, by_time=True)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(laid) == rows(whole)
    gifts = [r for r in laid.collect() if r["cart_products"] and len(r["cart_products"]) == 2]
    assert gifts and all(r["cart_products"][1]["product_id"].startswith("gift-") for r in gifts)
    at = F.col("time_stamp").try_cast("bigint")
    pieces = laid.groupBy(F.spark_partition_id().alias("piece")).agg(
        F.min(at).alias("first"), F.max(at).alias("last"), F.count_if(at.isNull()).alias("untimed"), F.count("*").alias("n")).collect()
    timed = sorted((r["first"], r["last"]) for r in pieces if r["first"] is not None)
    assert len(timed) > 4 and all(a[1] < b[0] for a, b in zip(timed, timed[1:]))
    assert all(r["untimed"] in (0, r["n"]) for r in pieces)


def files_read(df):
    df = df.select("v")
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().get("numFiles").get().value()


def test_a_stretch_opens_its_files_alone(spark, tmp_path):
    path = f"{tmp_path}/a b%20c=ü+&"
    at = F.when(F.col("id") % 1000 == 7, "n/a").otherwise(F.col("id").cast("string"))
    rows = spark.range(0, 4000, 1, 8).select(at.alias("time_stamp"), F.lit("checkout_success").alias("collection"), F.col("id").alias("v"))
    rows.write.partitionBy("collection").parquet(path)
    events = spark.read.parquet(path)
    stretches = [(None, 1000 * 10**6), (1000 * 10**6, 2000 * 10**6), (2000 * 10**6, None)]
    for stretch, files in zip(stretches, sales.files_of(events, stretches)):
        for timed in (None, True, False):
            chosen = sales.events_in(events, stretch, timed, files)
            want = events.where(sales.in_slice(F.col("time_stamp"), stretch, timed))
            assert sorted(map(str, chosen.collect())) == sorted(map(str, want.collect()))
            assert files_read(chosen) < files_read(want) == 8
    assert sales.events_in(events, stretches[0], False, ({"f"}, set())) is None
    assert sales.files_of(spark.createDataFrame([("1", "checkout_success")], "time_stamp string, collection string"), stretches) is None


def test_a_build_from_files_in_stretches_is_the_whole_one(spark, tmp_path, sources, monkeypatch):  # noqa: F811
    places, products, rates, mapping = sources
    documents = [order(n, n % 9, f"d{n % 3}") for n in range(60)]
    spark.createDataFrame(documents, EVENTS).repartitionByRange(6, "time_stamp").write.parquet(f"{tmp_path}/landed")

    def fact(name):
        events = spark.read.parquet(f"{tmp_path}/landed")
        built = Warehouse(spark, f"{tmp_path}/{name}", dt.date(2024, 12, 31)).build(events, places, products, rates, mapping)
        return sorted(map(str, built.table("fact_sales_order_detail").collect()))

    whole = fact("whole")
    monkeypatch.setattr(sales, "SLICE_DOCUMENTS", 9)
    monkeypatch.setattr(sales, "MANY_PRODUCTS", 1)
    assert fact("sliced") == whole and whole


def test_few_addresses_do_not_move_the_lines(spark, tmp_path, sources, monkeypatch):  # noqa: F811
    dims.located_ips(sources[0]).write.parquet(f"{tmp_path}/ips")
    ips, events = spark.read.parquet(f"{tmp_path}/ips"), spark.createDataFrame([order(1, 1)], EVENTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = lambda: re.findall(r"hashpartitioning\(wanted_ip", formatted(sales.order_lines(events, sales.small_side(ips))))
        assert not moved()
        monkeypatch.setattr(sales, "FEW_ADDRESSES", -1)
        assert moved()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
