"""Tables that grow by batches: the version store and the daily warehouse."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from clickstar.operators.scd2 import build_versions
from clickstar.operators.version_store import VersionStore
from clickstar.plans import dims, sales
from clickstar.plans.daily import DailyWarehouse
from clickstar.plans.warehouse import Warehouse
from clickstar.sources.seeds import currency_mapping
from test_plans import formatted

SCHEMA = "e string, t timestamp, p string, q string"
START = dt.datetime(2020, 1, 1)


def random_events(seed, count):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["a", "b", "c", "d", None, "hot", "hot", "hot"]),
            None if rng.random() < 0.03 else START + dt.timedelta(days=rng.randrange(700), hours=rng.randrange(3)),
            rng.choice([None, "x", "y"]), rng.choice([None, "1", "2"]),
        )
        for _ in range(count)
    ]


def store_at(spark, path):
    return VersionStore(spark, f"{path}/store", "e", ["p", "q"], ["q", "p"], buckets=2)


def full(spark, rows, columns):
    whole = build_versions(spark.createDataFrame(rows, SCHEMA), "e", "t", ["p", "q"], ["q", "p"])
    return sorted(map(str, whole.select(columns).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_the_full_build(spark, tmp_path, seed):
    rows, store, done = random_events(seed, 160), store_at(spark, tmp_path), []
    if seed == 2:
        rows.sort(key=lambda r: r[1] or START)
    for i in range(0, 160, 40):
        done += rows[i : i + 40]
        for _ in range(1 + (i == 40)):
            # The same batch again changes nothing.
            store.load(spark.createDataFrame(rows[i : i + 40], SCHEMA), "t", f"b{i}")
        got = store.versions()
        assert sorted(map(str, got.collect())) == full(spark, done, got.columns)
    since = START + dt.timedelta(days=300)
    later = store.versions(since)
    assert sorted(map(str, later.collect())) == sorted(map(str, store.versions().where(F.col("end_time") > F.lit(since)).collect()))
    assert re.search(r"PartitionFilters: \[.*chunk", formatted(later))


def test_a_broken_load_is_finished_by_the_next_one(spark, tmp_path, monkeypatch):
    rows, store = random_events(3, 90), store_at(spark, tmp_path)
    store.load(spark.createDataFrame(rows[:30], SCHEMA), "t", "b1")
    # Broken before the staged folders are complete: nothing has happened.
    with monkeypatch.context() as broken:
        broken.setattr(VersionStore, "_replace", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.load(spark.createDataFrame(rows[30:60], SCHEMA), "t", "b2")
    assert sorted(map(str, store.versions().collect())) == full(spark, rows[:30], store.versions().columns)
    store.load(spark.createDataFrame(rows[30:60], SCHEMA), "t", "b2")
    # Broken when they are, but not yet in place: the next load puts them there first.
    with monkeypatch.context() as broken:
        finish, calls = VersionStore._finish, []
        broken.setattr(VersionStore, "_finish", lambda self: finish(self) if not calls.append(1) and len(calls) < 2 else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.load(spark.createDataFrame(rows[60:], SCHEMA), "t", "b3")
    store.load(spark.createDataFrame([], SCHEMA), "t", "b4")
    assert sorted(map(str, store.versions().collect())) == full(spark, rows, store.versions().columns)


def test_events_in_order_open_no_history(spark, tmp_path, monkeypatch):
    store, read = store_at(spark, tmp_path), []
    day = lambda n: START + dt.timedelta(days=n)
    store.load(spark.createDataFrame([("a", day(n), "x", str(n)) for n in range(400)], SCHEMA), "t", "b1")
    table = VersionStore.table
    monkeypatch.setattr(VersionStore, "table", lambda self, name: read.append(name) or table(self, name))
    old = {p: os.stat(p).st_mtime_ns for p in parquet_files(tmp_path)}
    store.load(spark.createDataFrame([("a", day(400), "y", "1"), ("new", day(3), "x", "1")], SCHEMA), "t", "b2")
    # The present stretch of closed versions and the open ones, no observed event.
    assert "observed" not in read and store.versions().count() == 402
    untouched = [p for p, at in old.items() if "/closed/" in p and os.path.exists(p) and os.stat(p).st_mtime_ns == at]
    gone = [p for p in old if "/closed/" in p and p not in untouched]
    assert len(untouched) >= 4 and len(gone) <= 1


def parquet_files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


# The daily warehouse -------------------------------------------------------------------------------

EVENTS = (
    "_id string, collection string, order_id string, device_id string, user_agent string, user_id_db string,"
    " email_address string, store_id string, current_url string, time_stamp string, local_time string, ip string,"
    " cart_products array<struct<product_id: string, currency: string, amount: string, price: string>>"
)
PLACES = "ip string, city_name string, region_name string, country_code string, country_name string"
PRODUCTS = "product_id string, name string, sku string, gender string, price double, min_price double, max_price double"


def order(n, day, device="d1", email=None, price="10.50"):
    at = int((dt.datetime(2024, 3, 1, 9, tzinfo=dt.timezone.utc) + dt.timedelta(days=day, minutes=n)).timestamp())
    return (
        f"{n:024d}", "checkout_success", f"o{n}", device, "agent", None, email, "1", "https://shop.de/x",
        "n/a" if day is None else str(at), None, "10.0.0.1", [(f"p{n % 3}", "€", "2", price)],
    )


@pytest.fixture
def sources(spark):
    places = spark.createDataFrame([("10.0.0.1", "City", "Region", "DE", "Germany")], PLACES)
    products = spark.createDataFrame([(f"p{i}", f"name {i}", None, None, 1.0, 1.0, 2.0) for i in range(3)], PRODUCTS)
    days = [(f"2024-03-{d:02d}", {"EUR": 0.9}) for d in range(1, 11)]
    rates = spark.createDataFrame(days, "date string, rates map<string, double>")
    return places, products, rates, currency_mapping(spark)


def facts(df):
    columns = [c for c in df.columns if c not in ("event_day", "inserted_date", "updated_date", "inserted_by", "updated_by")]
    return sorted(map(str, df.select(columns).collect()))


def test_the_fact_grows_by_touched_days(spark, tmp_path, sources):
    places, products, rates, mapping = sources
    daily = DailyWarehouse(spark, f"{tmp_path}/daily", dt.date(2024, 12, 31))
    batches = {
        "b1": [order(n, n % 4, f"d{n % 3}") for n in range(12)],
        "b2": [order(n, 4 + n % 2, f"d{n % 3}", "a@b.c") for n in range(12, 18)],
        # Late: another line of a loaded day, of a device that is new.
        "b3": [order(40, 1, "d9"), order(41, 6, "d1")],
    }
    done, changed = [], []
    for name, rows in batches.items():
        done += rows
        events = spark.createDataFrame(rows, EVENTS)
        daily.land(events, name)
        assert daily.open_batches() == [name]
        before = {p: os.stat(p).st_mtime_ns for p in parquet_files(f"{tmp_path}/daily/fact_sales_order_detail")}
        changed.append(daily.load(places, products, rates, mapping))
        after = parquet_files(f"{tmp_path}/daily/fact_sales_order_detail")
        kept = {p.split("event_day=")[1][:10] for p in after if p in before}
        fresh = {p.split("event_day=")[1][:10] for p in after if p not in before}
        assert fresh == {d.isoformat() for d in changed[-1]} and not fresh & kept
        whole = Warehouse(spark, f"{tmp_path}/full-{name}", dt.date(2024, 12, 31)).build(
            spark.createDataFrame(done, EVENTS), places, products, rates, mapping
        )
        got = facts(daily.table("fact_sales_order_detail"))
        assert got == facts(whole.table("fact_sales_order_detail").select(daily.table("fact_sales_order_detail").drop("event_day").columns))
    assert [len(days) for days in changed] == [4, 2, 2]
    assert daily.load(places, products, rates, mapping) == []


def test_days_are_loaded_in_groups(spark, tmp_path, sources, monkeypatch):
    places, products, rates, mapping = sources
    rows = [order(n, n % 5, f"d{n % 3}", None if n % 2 else f"{n}@b.c") for n in range(20)]
    unreadable = list(order(20, 0))
    unreadable[9] = "n/a"
    got = {}
    for lateness in ("merge", "drop"):
        for documents in (1000, 4):
            monkeypatch.setattr(sales, "SLICE_DOCUMENTS", documents)
            daily = DailyWarehouse(spark, f"{tmp_path}/{lateness}-{documents}", dt.date(2024, 12, 31))
            daily.land(spark.createDataFrame([*rows, tuple(unreadable)], EVENTS), "b1")
            days = daily.load(places, products, rates, mapping, lateness=lateness)
            groups = daily._day_groups(days, None)
            assert [d for group, _ in groups for d in group] == days and (len(groups) > 2) == (documents == 4)
            assert [until for _, until in groups] == [*[group[0] for group, _ in groups[1:]], None]
            got[lateness, documents] = facts(daily.table("fact_sales_order_detail"))
    assert len({str(x) for x in got.values()}) == 1 and len(got["merge", 4]) == 21


def test_many_products_are_looked_up_by_time(spark, tmp_path, sources, monkeypatch):
    """The rows are those of the plain lookup, with lines without a time, product or match; lines stay where they are."""
    places, products, rates, mapping = sources
    rows = [order(n, n % 5, f"d{n % 3}") for n in range(12)]
    unreadable = list(order(12, 0))
    unreadable[9] = "n/a"
    got = []
    for many in (10**6, 1):
        monkeypatch.setattr(sales, "MANY_PRODUCTS", many)
        monkeypatch.setattr(sales, "SLICE_DOCUMENTS", 5)
        daily = DailyWarehouse(spark, f"{tmp_path}/{many}", dt.date(2024, 12, 31))
        daily.land(spark.createDataFrame([*rows, tuple(unreadable)], EVENTS), "b1")
        days = daily.load(places, products, rates, mapping)
        groups = [group for group, _ in daily._day_groups(days, None, apart=many == 1)]
        assert [d for group in groups for d in group] == days and (groups[0] == [None] or many > 1)
        got.append(facts(daily.table("fact_sales_order_detail")))
    assert got[0] == got[1] and len(got[0]) == 13

    lines = spark.createDataFrame(
        [(1, "p1", "a"), (1, "p1", "b"), (1, "p2", "c"), (2, "p9", "d"), (2, None, "e"), (3, "p3", "f")], "t int, product_id string, line string"
    ).withColumn("time_stamp", F.timestamp_seconds("t")).drop("t")
    dim = spark.createDataFrame([("p1", "k1"), ("p2", "k2"), ("p3", "k3"), ("p3", "k4"), (None, "k5")], "product_id string, product_key string")
    monkeypatch.setattr(sales, "MANY_PRODUCTS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sales.lookup_sold(lines.repartition("time_stamp"), dim, lines.select("time_stamp", "product_id"))
        assert sorted((r.line, r.product_key) for r in found.collect() if r.product_key) == [
            ("a", "k1"), ("b", "k1"), ("c", "k2"), ("f", "k3"), ("f", "k4")]
        assert found.count() == 7
        moved = re.findall(r"Exchange\n(?:Input \[\d+\]: )(.*)\nArguments: (\S+)", formatted(found))
        assert moved and all("(time_stamp" in how for what, how in moved if "line#" in what)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_touched_folders_are_opened(spark, tmp_path, sources):
    places, products, rates, mapping = sources
    daily = DailyWarehouse(spark, f"{tmp_path}/daily", dt.date(2024, 12, 31))
    daily.land(spark.createDataFrame([order(n, n, email=f"{n}@b.c") for n in range(8)], EVENTS), "b1")
    daily.load(places, products, rates, mapping)
    events = daily.landed([dt.date(2024, 3, 4)])
    fact = daily._fact(
        events, [dt.date(2024, 3, 4)], *(daily.table(t) for t in ("dim_product", "dim_location", "stg_location", "dim_currency", "dim_store", "dim_date")),
        mapping, spark.createDataFrame([], "date_key date, currency_key string, rate_to_usd decimal(38,9)"),
    )
    scans = [block.split("\n\n")[0] for block in formatted(fact).split(") Scan parquet")[1:]]
    filters = [(re.search(r"Output[^\n]*", x)[0], re.search(r"PartitionFilters: ([^\n]*)", x)) for x in scans]
    landing = [f for output, f in filters if "event_day" in output]
    versions = [f for output, f in filters if "chunk" in output]
    assert landing and all(f and "event_day" in f[1] and "2024-03-04" in f[1] for f in landing)
    assert versions and all(f and "chunk" in f[1] for f in versions)
    stored = daily.table("fact_sales_order_detail").where("event_day = '2024-03-04'")
    assert facts(fact.drop("sales_usd_price")) == facts(stored.drop("sales_usd_price"))


def test_dropping_late_lines_and_unreadable_times(spark, tmp_path, sources):
    places, products, rates, mapping = sources
    daily = DailyWarehouse(spark, f"{tmp_path}/daily", dt.date(2024, 12, 31), grain="month")
    unreadable = list(order(5, 0))
    unreadable[9] = "n/a"
    daily.land(spark.createDataFrame([order(1, 2), order(2, 3), tuple(unreadable)], EVENTS), "b1")
    assert daily.load(places, products, rates, mapping, lateness="drop") == [None, dt.date(2024, 3, 1)]
    assert daily.table("fact_sales_order_detail").count() == 3
    daily.land(spark.createDataFrame([order(3, 1), order(4, 4)], EVENTS), "b2")
    daily.load(places, products, rates, mapping, lateness="drop")
    assert {r.order_id for r in daily.table("fact_sales_order_detail").collect()} == {"o1", "o2", "o5", "o4"}
    assert daily.dim_customer().where(F.col("customer_key") != "-1").count() == 1
    assert dims.dim_customer(daily.landed()).count() == daily.dim_customer().count()
    with pytest.raises(ValueError):
        DailyWarehouse(spark, str(tmp_path), grain="hour")
