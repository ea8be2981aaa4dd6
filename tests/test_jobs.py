"""Enrichment, increments, lookups, rates, quality checks and plans."""

import json
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickstar import session
from clickstar.operators import candidates, dates, failures, increment, lookup, pages, quality, rates
from clickstar.operators.first_n import first_n
from clickstar.plans import dims, marts, sales
from clickstar.plans.warehouse import Warehouse
from clickstar.sources import seeds


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Candidates ---------------------------------------------------------------------------------

EVENT = "_id string, collection string, product_id string, viewing_product_id string, current_url string, referrer_url string"


def test_candidate_rules(spark):
    click = candidates.RECOMMEND_CLICK_EVENT
    rows = [
        ("1", "view_product_detail", "10", "11", "https://x/10", "https://r"),
        ("2", "view_product_detail", " ", "11", "javascript:x", None),
        ("3", click, "10", "12", "https://x/10", " https://r/12 "),
        ("4", click, "10", None, "https://x/10", "https://r"),
        ("5", "checkout_success", "10", "11", "https://x/10", None),
    ]
    got = candidates.product_sightings(spark.createDataFrame(rows, EVENT)).orderBy("_id").collect()
    assert [tuple(r)[:3] for r in got] == [
        ("10", "https://x/10", "view_product_detail"), ("11", None, "view_product_detail"), ("12", "https://r/12", click),
    ]


def test_boolean_ids_do_not_count(spark):
    df = spark.createDataFrame([("1", "view_product_detail", True, "11", "https://x", None)], EVENT.replace("product_id string, v", "product_id boolean, v"))
    assert candidates.product_sightings(df).first()["product_id"] == "11"


def test_first_n(spark):
    rows = [("p", "u1", "a", 1), ("p", "u2", "b", 2), ("p", "u1", "c", 3), ("p", "u3", "d", 4), ("q", None, "e", 5), ("q", "u9", "f", 6)]
    df = spark.createDataFrame(rows, "product_id string, url string, source string, seq int")
    found = first_n(df, "product_id", "url", "source", "seq", 2)
    got = sorted((r["product_id"], r["url"], r["source"], r["priority"]) for r in found.collect())
    assert got == [("p", "u1", "a", 0), ("p", "u2", "b", 1), ("q", "u9", "f", 0)]
    # The rank limit must act before the shuffle: a product may have any number of URLs.
    limits = found._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in limits and ", Partial" in limits and ", Final" in limits


def test_attempt_order(spark):
    products = spark.createDataFrame([("a b",), ("c",)], "product_id string")
    found = spark.createDataFrame([("c", "https://x/c", 0), ("c", "https://y", 1)], "product_id string, url string, priority int")
    urls = candidates.attempt_urls(products, found, "https://x/{product_id}")
    got = sorted((r["product_id"], r["priority"], r["url"]) for r in urls.collect())
    assert got == [("a b", 2**31 - 1, "https://x/a%20b"), ("c", 0, "https://x/c"), ("c", 1, "https://y")]


# Pages --------------------------------------------------------------------------------------


@pytest.mark.parametrize("html,want", [
    (r"react_data_url = 'https://host/p';", "https://host/p"),
    ('x; REACT_DATA_URL="/api/x?id=10&amp;q=1"', "https://shop.de/api/x?id=10&q=1"),
    (r"react_data_url='it\'s'", "https://shop.de/a/it's"),
    ("react_data_url=''", "https://shop.de/a/b"),
    ("react_data_url='" + "x" * 200_000 + "'", "https://shop.de/a/" + "x" * 200_000),
    ("my_react_data_url='/a'", None), ("react_data_url='mailto:a'", None), ("react_data_url='open", None),
])
def test_script_variable(spark, html, want):
    df = spark.createDataFrame([("https://shop.de/a/b", html)], "url string, html string")
    row = pages.script_variable_url(df).first()
    assert row["data_url"] == want and (row["error"] is None) == (want is not None)


@pytest.mark.parametrize("payload,want", [
    ('{"data": {"product": {"product_id": 1, "sku": "a"}}}', "1"),
    ('{"product_id": 1, "x": {"product_id": 2, "name": "n"}}', "2"),
    ('{"x": [{"product_id": 3}, {"product_id": 4}]}', "3"),
    ('{"x": 1}', None), ("no json", None), (None, None),
])
def test_product_object(spark, payload, want):
    df = spark.createDataFrame([(payload,)], "payload string")
    row = pages.find_products(df).select("error", F.get_json_object("product", "$.product_id").alias("id")).first()
    assert row["id"] == want and (row["error"] is None) == (want is not None)


def test_reasons_without_a_product(spark):
    df = spark.createDataFrame([(1, "no json"), (2, "[]"), (3, None)], "i int, payload string")
    got = [r["error"] for r in pages.find_products(df).orderBy("i").collect()]
    assert got == [pages.NO_JSON, pages.NO_PRODUCT, pages.NO_JSON]


def test_product_search_has_no_limit(spark):
    wide = '{"x": [' + ",".join(["1"] * 30_000) + ', {"product_id": 1, "sku": "a"}]}'
    below = '{"a": {"product_id": 1}, "b": [{"product_id": 2, "name": "n"}], "c": {"product_id": 3, "sku": "s"}}'
    rows = [(0, wide), (1, below), (2, '{"product_id": 1, "name": "\\ud83d \\ud83d\\ude00"}'), (3, "[" * 200_000), (4, '{"a":')]
    found = {r["i"]: r for r in pages.find_products(spark.createDataFrame(rows, "i int, payload string")).collect()}
    assert [json.loads(found[i]["product"])["product_id"] for i in (0, 1, 2)] == [1, 3, 1]
    assert json.loads(found[2]["product"])["name"] == "\ufffd \U0001f600"
    assert [found[i]["error"] for i in (3, 4)] == [pages.TOO_DEEP, pages.NO_JSON]


def test_script_values(spark):
    assert pages.unescaped(r"a\/b\\u0041 A\ud83d\ude00 \ud83d \x \'") == "a/b\\u0041 A\U0001f600 \ufffd \\x '"
    page = [("http://h/x", r"<script>react_data_url = '/p\ud83d\ude00'</script>"), ("http://h/x", r"<script>react_data_url='/p\ud83d'</script>")]
    got = pages.script_variable_url(spark.createDataFrame(page, "url string, html string")).collect()
    assert [r["data_url"] for r in got] == ["http://h/p\U0001f600", "http://h/p\ufffd"]


def test_attempt_outcomes(spark):
    good = '{"product_id": "7.0", "sku": "s"}'
    rows = [("7", 0, "u0", None, "timeout"), ("7", 1, "u1", good, None), ("7", 2, "u2", None, "late"),
            ("8", 0, "u0", good, None), ("8", 1, "u1", None, "x" * 3000)]
    judged = pages.judge_attempts(spark.createDataFrame(rows, "product_id string, priority int, url string, payload string, error string")).cache()
    assert [(r["product_id"], r["source_url"]) for r in pages.fetched_products(judged).collect()] == [("7", "u1")]
    failed = {(r["product_id"], r["url"]): r["recovered_via"] for r in pages.fetch_failures(judged).collect()}
    assert failed == {("7", "u0"): "u1", ("8", "u0"): None, ("8", "u1"): None}
    lost = pages.lost_products(judged).first()
    assert lost["product_id"] == "8" and lost["last_error"] == "u0: product_id differs (wanted 8, found 7.0) | u1: " + "x" * 3000


def test_lost_products_with_many_urls(spark):
    df = spark.range(3000).select(
        F.lit("1").alias("product_id"), F.col("id").cast("int").alias("priority"), F.concat(F.lit("u"), "id").alias("url"),
        F.lit(None).cast("string").alias("payload"), F.lit("e").alias("error"))
    whole = " | ".join(f"u{i}: e" for i in range(3000))
    judged = pages.judge_attempts(df)
    assert pages.lost_products(judged).first()["last_error"] == whole
    assert pages.lost_products(judged, chars=2000).first()["last_error"] == whole[-2000:]


def test_lost_product_without_urls(spark):
    rows = [("8", 0, None, None, "boom"), ("8", 1, "u", None, "x"), ("9", 0, None, None, "gone")]
    judged = pages.judge_attempts(spark.createDataFrame(rows, "product_id string, priority int, url string, payload string, error string"))
    assert {r["product_id"]: r["last_error"] for r in pages.lost_products(judged).collect()} == {"8": ": boom | u: x", "9": ": gone"}


# Dates, rates -------------------------------------------------------------------------------


def test_date_statistics(spark):
    rows = [("2020-06-04 11:21:24",), ("2020-06-05T00:00:00",), ("2020-06-04",), ("x",)]
    df = spark.createDataFrame(rows, "local_time string")
    assert [r["date"] for r in dates.local_dates(df).collect()] == [date(2020, 6, 4), date(2020, 6, 5)]
    row = dates.date_scan_statistics(df).first()
    assert tuple(row) == (4, 2, 1, 1)
    assert tuple(dates.date_scan_statistics(df.limit(0)).first()) == (0, 0, 0, 0)


def test_rates(spark):
    quotes = spark.createDataFrame(
        [("2020-06-04", "EUR", 0.5, 1), ("2020-06-04", "AUD", 1.44, 1), ("2020-06-04", "EUR", 0.89, 2), ("2020-06-05", "", 1.0, 1), ("2020-06-05", "EUR", 1.0, 1)],
        "date string, quote string, rate double, seq int",
    )
    with pytest.raises(Exception, match="rejected exchange rate on 2020-06-05"):
        rates.pivot_rates(quotes, "seq").collect()
    lenient = {r["date"]: r["rates"] for r in rates.pivot_rates(quotes, "seq", strict=False).collect()}
    assert lenient == {"2020-06-04": {"AUD": 1.44, "EUR": 0.89}, "2020-06-05": {"EUR": 1.0}}
    landed = rates.pivot_rates(quotes.where("date = '2020-06-04'"), "seq")
    assert [(r["date"], r["base"], r["rates"]) for r in landed.collect()] == [("2020-06-04", "USD", {"AUD": 1.44, "EUR": 0.89})]
    assert rates.rejected_quotes(quotes).count() == 1
    assert rates.rejected_quotes(quotes.withColumn("rate", F.lit(True))).count() == 5
    currencies = spark.createDataFrame([(1, "EUR"), (2, "USD")], "currency_key long, currency_code string")
    days = spark.createDataFrame([(date(2020, 6, 4),), (date(2020, 6, 7),)], "date_key date")
    got = {(str(r["date_key"]), r["currency_key"]): r["rate_to_usd"] for r in rates.rates_to_base(landed, currencies, days).collect()}
    assert got == {("2020-06-04", 1): 1 / 0.89, ("2020-06-04", 2): 1.0, ("2020-06-07", 2): 1.0}
    text = landed.withColumn("rates", F.to_json("rates"))
    assert sorted(map(tuple, rates.flatten_rates(text).collect())) == sorted(map(tuple, rates.flatten_rates(landed).collect()))


def test_zero_rate_is_no_rate(spark):
    landed = spark.sql("SELECT '2020-06-04' AS date, map('eur', 0.0D) AS rates")
    currencies = spark.createDataFrame([(1, "EUR")], "currency_key long, currency_code string")
    days = spark.createDataFrame([(date(2020, 6, 4),)], "date_key date")
    assert rates.rates_to_base(landed, currencies, days).first()["rate_to_usd"] is None


# Failures -----------------------------------------------------------------------------------


def test_failure_ledger(spark):
    rows = [("1", "u", "a", 1, "v"), ("1", "u", "x" * 2500 + "end", 2, None), ("1", "w", "b", 1, "v")]
    df = spark.createDataFrame(rows, "product_id string, url string, error string, ts int, recovered_via string")
    got = {r["url"]: r for r in failures.failure_ledger(df).collect()}
    assert got["u"]["occurrences"] == 2 and got["u"]["recovered_via"] is None
    assert len(got["u"]["last_error"]) == 2503 and got["u"]["last_error"].endswith("end")
    assert {len(r["last_error"]) for r in failures.failure_ledger(df, 2000).where("url = 'u'").collect()} == {2000}
    assert got["w"]["recovered_via"] == "v"


def test_status_counts(spark):
    df = spark.createDataFrame([("done",), ("done",), ("failed",)], "status string")
    assert failures.status_counts(df).first().asDict() == {"pending": 0, "in_progress": 0, "done": 2, "failed": 1}


# Increments ---------------------------------------------------------------------------------


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, t int, v string")


def rows_of(df):
    return sorted(map(tuple, df.select("k", "t", "v").collect()), key=str)


def test_upsert(spark):
    target = keyed(spark, (1, 1, "old"), (2, 1, "old"), (None, 1, "old"))
    got = increment.upsert(target, keyed(spark, (1, 2, "new"), (3, 2, "new"), (3, 3, "twin"), (None, 2, "new")), ["k"])
    assert rows_of(got) == sorted([(1, 2, "new"), (2, 1, "old"), (3, 2, "new"), (3, 3, "twin"), (None, 1, "old"), (None, 2, "new")], key=str)
    with pytest.raises(Exception, match="two source rows"):
        increment.upsert(target, keyed(spark, (1, 2, "a"), (1, 3, "b")), ["k"]).collect()


@pytest.mark.parametrize("partition", [None, "p"])
def test_increment_table(spark, tmp_path, partition):
    def load(lateness, *rows, **extra):
        source = keyed(spark, *rows).withColumn("p", F.col("k") % 2)
        return increment.increment_table(spark, str(tmp_path / "t"), source, ["k"], "t", lateness=lateness, partition=partition, **extra)

    assert rows_of(load("drop", (1, 5, "a"), (2, 6, "a"), (3, None, "a"))) == [(1, 5, "a"), (2, 6, "a"), (3, None, "a")]
    late = load("drop", (1, 6, "late"), (4, 7, "b"), (5, None, "no time"))
    assert rows_of(late) == [(1, 5, "a"), (2, 6, "a"), (3, None, "a"), (4, 7, "b")]
    for _ in range(2):
        merged = load("merge", (1, 6, "late"), (5, 1, "c"))
        assert rows_of(merged) == [(1, 6, "late"), (2, 6, "a"), (3, None, "a"), (4, 7, "b"), (5, 1, "c")]
    with pytest.raises(ValueError):
        load("drop", (9, 9, "x"), (9, 9, "y"), strict=True)
    with pytest.raises(ValueError):
        load("other", (9, 9, "x"))


def test_parts_are_written_one_after_the_other(spark, tmp_path):
    path, mark = str(tmp_path / "t"), tmp_path / "t" / "_SUCCESS"
    first, second = keyed(spark, (1, None, "a"), (2, 5, "a")), keyed(spark, (3, 6, "b"))
    broken = second.withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    load = lambda *parts, **extra: rows_of(increment.increment_table(spark, path, parts, ["k"], "t", **extra))
    with pytest.raises(Exception, match="broken"):
        load(first, broken)
    # A first write that broke between two parts does not count.
    assert not mark.exists()
    assert load(first, second) == [(1, None, "a"), (2, 5, "a"), (3, 6, "b")] and mark.exists()
    more = [keyed(spark, (4, 7, "c")), keyed(spark, (5, 8, "d"))]
    with pytest.raises(Exception, match="broken"):
        load(first, more[0], more[1].withColumn("v", F.raise_error(F.lit("broken")).cast("string")))
    assert load(first, second, *more) == [(1, None, "a"), (2, 5, "a"), (3, 6, "b"), (4, 7, "c"), (5, 8, "d")]
    assert load(keyed(spark, (2, 1, "e")), keyed(spark, (6, 1, "f")), lateness="merge")[1:] == [
        (2, 1, "e"), (3, 6, "b"), (4, 7, "c"), (5, 8, "d"), (6, 1, "f")]


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {b.name() for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllBlocks()) if b.name().startswith("shuffle_")}


def test_shuffle_files_end_with_a_write(spark, tmp_path):
    setting = spark.conf.get(session.CLEANUP)
    rows = spark.range(100).repartition(3, "id")
    before = shuffle_files(spark)
    rows.write.parquet(str(tmp_path / "kept"))
    kept = shuffle_files(spark) - before
    with session.shuffles_freed(spark):
        rows.write.parquet(str(tmp_path / "freed"))
    assert kept and not shuffle_files(spark) - before - kept
    assert spark.conf.get(session.CLEANUP) == setting


def test_broken_first_write_is_repeated(spark, tmp_path):
    (tmp_path / "t" / "_temporary").mkdir(parents=True)
    assert increment.increment_table(spark, str(tmp_path / "t"), keyed(spark, (1, 1, "a")), ["k"], "t").count() == 1


def test_broken_replacement_is_completed(spark, tmp_path):
    path = str(tmp_path / "t")
    increment.increment_table(spark, path, keyed(spark, (1, 1, "a")), ["k"], "t")
    keyed(spark, (1, 1, "a"), (2, 2, "b")).write.parquet(f"{path}__next")
    (tmp_path / "t" / "_SUCCESS").unlink()
    got = increment.increment_table(spark, path, keyed(spark, (3, 3, "c")), ["k"], "t", lateness="merge")
    assert rows_of(got) == [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")]


def test_marks(spark):
    df = keyed(spark, (1, 1, "a"), (2, 2, "b"))
    assert increment.high_water_mark(df, "t") == 2
    assert increment.after_mark(df, "t", 1).count() == 1 and increment.after_mark(df, "t", None).count() == 2
    assert increment.newer_rows(df, df.limit(0), "t").count() == 0
    assert increment.check_object_id("5e" * 12) == "5e" * 12
    with pytest.raises(ValueError):
        increment.check_object_id("xyz")


# Lookups ------------------------------------------------------------------------------------


def test_lookup_and_unknown_member(spark):
    dim = lookup.with_unknown_member(spark.createDataFrame([(5, "a")], "key long, code string"), {"key": -1, "code": "Unknown"})
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "raw string")
    got = lookup.lookup_key(facts, dim, {"raw": "code"}, "key").orderBy("raw").collect()
    assert [tuple(r) for r in got] == [(None, None), ("a", 5), ("b", None)]
    with pytest.raises(ValueError):
        lookup.with_unknown_member(dim, {"key": -1})


def test_latest_rows(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, None), ("b", 1, "x")], "ip string, seq int, city string")
    got = sorted(map(tuple, lookup.latest_rows(df, ["ip"], "seq").select("ip", "seq", "city").collect()))
    assert got == [("a", 2, None), ("b", 1, "x")]


def test_audit_and_comments(spark):
    df = lookup.with_comments(lookup.with_audit(spark.range(1), today=date(2020, 1, 2)), {"id": "the id"})
    row = df.first()
    assert (row["inserted_date"], row["updated_by"]) == (date(2020, 1, 2), "dbt")
    assert df.schema["id"].metadata["comment"] == "the id"


# Quality ------------------------------------------------------------------------------------


def test_quality(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 2), (None, 2), (None, None), (None, None), (3, None)], "a int, b int")
    assert quality.not_null(df, "a").count() == 4
    assert [tuple(r) for r in quality.unique(df, "a").collect()] == [(1, 2)]
    assert sorted((r["a"] or 0, r["b"]) for r in quality.compound_unique(df, ["a", "b"]).collect()) == [(0, 2), (1, 1)]
    assert quality.compound_unique(df, ["a", "b"], "b = 2").count() == 1
    parent = spark.createDataFrame([(1,)], "a int")
    assert [tuple(r) for r in quality.relationship(df, "a", parent, "a").collect()] == [(3, 1)]


@pytest.mark.parametrize("parent", [[1], [1, None], [], [None]])
def test_not_in_like_sql(spark, parent):
    child = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    other = spark.createDataFrame([(p,) for p in parent], "b int")
    want = child.createOrReplaceTempView("child_rows") or other.createOrReplaceTempView("parent_rows") or spark.sql(
        "SELECT * FROM child_rows WHERE a NOT IN (SELECT b FROM parent_rows)")
    got = quality.not_in(child, "a", other, "b")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_active_version(spark):
    dim = spark.createDataFrame([(1, "a", False), (2, "a", True), (3, "b", False), (-1, "Unknown", False)], "key long, device string, is_current boolean")
    assert tuple(quality.without_active_version(dim, "device", "key").first()) == (2, 1)
    assert quality.without_active_version(dim.where("device <> 'b'"), "device", "key").count() == 0


def test_masked_view(spark):
    view = quality.masked_view(spark.createDataFrame([("A@x.de",)], "mail string"), "mail", "pii")
    assert view.schema["mail"].metadata["policy"] == "pii" and "@" not in view.first()["mail"]


# Star schema --------------------------------------------------------------------------------

DOCUMENT = ("collection string, order_id string, device_id string, user_agent string, user_id_db string, email_address string,"
            " store_id string, current_url string, time_stamp string, ip string,"
            " cart_products array<struct<product_id:string,currency:string,amount:string,price:string>>")


def order(order_id, ts, cart, device="d1", store="1", url="https://x.de/c", ip="1.1.1.1", collection="checkout_success"):
    return (collection, order_id, device, "agent", None, None, store, url, ts, ip, cart)


def star(spark, root, documents, lateness="drop", refresh=False):
    events = spark.createDataFrame(documents, DOCUMENT)
    location = spark.createDataFrame([("1.1.1.1", "Berlin", "BE", "DE", "Germany", 1.0, 2.0), ("2.2.2.2", None, None, None, None, None, None)],
                                     "ip string, city_name string, region_name string, country_code string, country_name string, latitude double, longitude double")
    product = spark.createDataFrame([("p1", " Ring ", "s", None, "10", "5", None), ("p2", "Chain", None, "w", "1", "1", "1")],
                                    "product_id string, name string, sku string, gender string, price string, min_price string, max_price string")
    landed = spark.sql("SELECT '2020-06-04' AS date, 'USD' AS base, map('EUR', 0.5D) AS rates")
    return Warehouse(spark, root, date(2021, 1, 1)).build(events, location, product, landed, seeds.currency_mapping(spark), lateness, refresh)


T0 = 1591266086  # 2020-06-04 10:21:26


def test_star_schema(spark, tmp_path):
    documents = [
        order("o1", str(T0), [("p1", " € ", "2", "10,00"), ("p1", "€", "1", "20.00"), ("x1", "€", "1", "1"), ("x2", "€", "3", "3")]),
        order("o2", str(T0 + 86400), [("p2", "$", "1", "1.094,00")], device=" d1 ", store=None),
        order("o3", "bad", [("p2", "kr", "1", "5")], ip="2.2.2.2", url="https://localhost"),
        order("o4", str(T0 + 5), None, device="d2", ip="9.9.9.9"),
        order("v1", str(T0 - 10), [("p1", "£", "1", "5")], collection="view_product_detail"),
    ]
    built = star(spark, str(tmp_path / "w"), documents)
    fact = {(r["order_id"], r["product_id"]): r for r in built.table("fact_sales_order_detail").join(
        built.table("dim_product").select("product_key", "product_id"), "product_key").collect()}
    assert len(fact) == 5
    line = fact[("o1", "p1")]
    assert (line["sales_amount"], line["sales_local_price"], line["sales_usd_price"]) == (3, Decimal(15), Decimal(30))
    unknown = fact[("o1", "Unknown")]
    assert (unknown["sales_amount"], unknown["sales_local_price"], unknown["product_key"]) == (4, Decimal(2), "-1")
    assert fact[("o2", "p2")]["sales_usd_price"] == Decimal(1094) and fact[("o2", "p2")]["store_key"] == "-1"
    broken = fact[("o3", "p2")]
    assert (broken["date_key"], broken["detail_key"], broken["customer_key"], broken["sales_usd_price"]) == (date(1970, 1, 1), None, "-1", None)
    assert broken["location_key"] != "-1" and fact[("o4", "Unknown")]["location_key"] == broken["location_key"]
    assert fact[("o4", "Unknown")]["sales_amount"] is None
    codes = {r["currency_code"] for r in built.table("dim_currency").collect()}
    assert codes == {"EUR", "USD", "SEK", "GBP", "Unknown"}
    summary = built.table("revenue_aov_customer_analysis").first()
    assert summary["Revenue"] == Decimal(30 * 3 + 1094 + 4 * 4) and summary["Orders"] == 4
    countries = {r["location_country_name"]: r["Revenue"] for r in built.table("revenue_by_country").collect()}
    assert countries["Germany"] == Decimal(30 + 4 + 1094)
    assert built.table("dim_customer").schema["customer_key"].metadata["comment"]
    built.view("dim_store")
    assert spark.table("dim_store").count() == 4


def test_canonical_address_option(spark):
    events = spark.createDataFrame([order("o1", str(T0), None, ip=" 1.1.1.1")], DOCUMENT)
    ips = spark.createDataFrame([("1.1.1.1", "Berlin", "BE", "DE", "Germany")], f"ip string, {', '.join(c + ' string' for c in dims.PLACE_COLUMNS)}")
    for canonical, city in ((False, "XNA"), (True, "Berlin")):
        assert sales.order_lines(events, ips, canonical=canonical).first()["location_city_name"] == city


def test_star_schema_increments(spark, tmp_path):
    root = str(tmp_path / "w")
    first = [order("o1", str(T0), [("p1", "€", "1", "10")])]
    star(spark, root, first)
    late_and_new = first + [order("late", str(T0 - 5), [("p1", "€", "1", "1")]), order("o2", str(T0 + 5), [("p1", "€", "1", "2")])]
    orders = lambda built: sorted(r["order_id"] for r in built.table("fact_sales_order_detail").collect())
    assert orders(star(spark, root, late_and_new)) == ["o1", "o2"]
    assert orders(star(spark, root, late_and_new)) == ["o1", "o2"]
    assert orders(star(spark, root, late_and_new, "merge")) == ["late", "o1", "o2"]
    assert orders(star(spark, root, late_and_new[1:], refresh=True)) == ["late", "o2"]


def test_star_schema_in_slices(spark, tmp_path, monkeypatch):
    """The fact is the same whether it is built whole or by stretches of time, with lines brought together or not."""
    documents = [
        order(f"o{i // 2}", "bad" if i % 9 == 8 else str(T0 + i // 2 % 7 * 9000), [("p1", "€", "2", "10"), (f"x{i % 3}", "€", "1", "1")],
              device=f"d{i % 4}", ip="1.1.1.1" if i % 3 else None)
        for i in range(40)
    ]
    rows = lambda built: sorted(map(str, built.table("fact_sales_order_detail").collect()))
    whole = rows(star(spark, str(tmp_path / "whole"), documents))
    monkeypatch.setattr(sales, "SLICE_DOCUMENTS", 9)
    monkeypatch.setattr(sales, "MANY_PRODUCTS", 1)
    events = spark.createDataFrame(documents, DOCUMENT)
    slices = sales.time_slices(events)
    assert len(slices) > 2 and slices[0][0] is None and slices[-1][1] is None
    assert [a[1] for a in slices[:-1]] == [b[0] for b in slices[1:]]
    sliced = star(spark, str(tmp_path / "sliced"), documents)
    assert rows(sliced) == whole and rows(star(spark, str(tmp_path / "sliced"), documents)) == whole
    assert rows(star(spark, str(tmp_path / "sliced"), documents, refresh=True)) == whole


def test_stretches_without_any_time(spark, monkeypatch):
    monkeypatch.setattr(sales, "SLICE_DOCUMENTS", 1)
    for times, want in ((["bad", None], [(None, None)]), ([str(T0)] * 3, [(None, T0 * 10**6), (T0 * 10**6, None)]), ([], [(None, None)])):
        events = spark.createDataFrame([order(str(i), t, None) for i, t in enumerate(times)], DOCUMENT)
        assert sales.time_slices(events) == want


def test_fact_plan(spark):
    """The sales fact must contain no join that compares all pairs."""
    from clickstar.plans import adapter, catalogue

    events = adapter.checkout_events(spark, "/root/testdata/sf0.001")
    mapping = seeds.currency_mapping(spark)
    ips = dims.located_ips(catalogue.raw_locations(spark, "/root/testdata/sf0.001"))
    days = dims.dim_date(events)
    currency = dims.dim_currency(events, mapping)
    fact = sales.sales_fact(
        sales.order_lines(events, ips), visits=sales.checkout_visits(events), customer=dims.dim_customer(events), product=dims.dim_product(adapter.raw_products(spark, "/root/testdata/sf0.001")),
        location=dims.dim_location(ips), currency=currency, store=dims.dim_store(events), calendar=days, mapping=mapping,
        rates=rates.rates_to_base(catalogue.landed_rates(spark, "/root/testdata/sf0.001"), currency, days),
    )
    text = plan(fact)
    assert "NestedLoop" not in text and "Cartesian" not in text and "BatchEvalPython" not in text
    # Mart queries read only the columns they need.
    assert "Cartesian" not in plan(marts.order_value_summary(fact))


def test_month_over_month(spark):
    fact = spark.createDataFrame(
        [(date(2020, 1, 5), "a", 10), (date(2020, 2, 5), "b", 0), (date(2020, 3, 5), "c", 5), (date(1970, 1, 1), "d", 9)],
        "date_key date, order_id string, v int").select("date_key", "order_id", F.col("v").cast("decimal(38,9)").alias("sales_usd_price"))
    events = spark.createDataFrame(
        [order(str(i), str(s), None) for i, s in enumerate((1578182400, 1580860800, 1583366400))], DOCUMENT)
    got = marts.revenue_month_over_month(fact, dims.dim_date(events, date(2021, 1, 1))).collect()
    assert [(r["year_month"], r["mom_growth_amount"], r["mom_growth_rate_pct"], r["mom_order_growth_amount"]) for r in got] == [
        ("2020-01", 10, None, 1), ("2020-02", -10, -100, 0), ("2020-03", 5, None, 0)]


def test_future_days_are_left_out(spark):
    events = spark.createDataFrame([order("1", str(T0), None), order("2", str(T0 + 86400), None)], DOCUMENT)
    assert [r["date_key"] for r in dims.calendar(events, date(2020, 6, 4)).collect()] == [date(2020, 6, 4)]
