"""What the star schema and its readers keep on disk: dense files, few shuffles, parts of bounded size."""

import datetime as dt
import glob
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from clickstar.functions.keys import packed_key
from clickstar.operators import rules
from clickstar.plans import checks, dims, marts, sales
from clickstar.plans.warehouse import Warehouse
from test_daily import EVENTS, order, sources  # noqa: F401
from test_plans import formatted

FACT = (
    "order_id string, customer_key string, product_key string, date_key date, sales_amount bigint, sales_usd_price decimal(38,9)"
)
DAY = dt.date(2024, 3, 1)


def test_keys_stay_different_when_packed(values):
    digest = "0123456789abcdef" * 2
    texts = [None, "", "-1", digest, digest.upper(), digest + "\n", digest[:31], "x" * 15, "x" * 16, "\0" + "x" * 15, "\0" * 17, "ü" * 8, "€" * 5]
    texts.append(bytes.fromhex(digest.replace("8", "0")[:14] * 2 + "4142").decode("latin1")[:16])
    packed = values(packed_key, texts)
    assert packed[0] is None and len({bytes(p) for p in packed[1:]}) == len(texts) - 1
    assert bytes(packed[3]) == bytes.fromhex(digest) and all(len(p) != 16 for p in packed[4:])


def test_times_are_read_once_to_choose_a_stretch(spark):
    texts = [None, "", "n/a", " 100 ", "199", "200", "250", "99", "-1", str(10**18), "253402300800", "-62135596801", "1.5"]
    df = spark.createDataFrame([(t,) for t in texts], "time_stamp string")
    unknown = [t for t in texts if t in (None, "", "n/a", "1.5") or abs(int(t)) > 10**10]

    def chosen(stretch, timed=None):
        return {r[0] for r in df.where(sales.in_slice(F.col("time_stamp"), stretch, timed)).collect()}

    cuts = [(None, 100 * 10**6), (100 * 10**6, 200 * 10**6), (200 * 10**6, None)]
    assert [chosen(c) for c in cuts] == [{"99", "-1", *unknown}, {" 100 ", "199"}, {"200", "250"}]
    assert chosen((None, None)) == set(texts) and chosen(cuts[0], False) == set(unknown)
    assert [chosen(c, True) for c in cuts] == [{"99", "-1"}, {" 100 ", "199"}, {"200", "250"}]
    plan = df.where(sales.in_slice(F.col("time_stamp"), cuts[1], True))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast") == 1


def test_rates_meet_the_lines_without_moving_them(spark, sources):  # noqa: F811
    places, products, rates, mapping = sources
    events = spark.createDataFrame([order(1, 1)], EVENTS)
    ips = dims.located_ips(places)
    daily = spark.createDataFrame([("k", DAY, 1.0)], "currency_key string, date_key date, rate_to_usd double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = sales.sales_fact(
            sales.order_lines(events, ips, together=sales.FACT_TOGETHER), visits=sales.checkout_visits(events),
            customer=dims.dim_customer(events), product=dims.dim_product(products), location=dims.dim_location(ips),
            currency=dims.dim_currency(events, mapping), store=dims.dim_store(events), calendar=dims.dim_date(events), mapping=mapping, rates=daily,
        )
        joins = re.findall(r"\) (\w+Join)\nLeft keys[^\n]*date_key[^\n]*\nRight keys[^\n]*\n", formatted(fact))
        text = formatted(fact)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"Arguments: hashpartitioning\(([^\n]*)", text)
    assert not [m for m in moved if re.match(r"currency_key#\d+, date_key#\d+, ", m)], joins


def fact_of(spark):
    rows = [
        ("o1", "a" * 32, "b" * 32, DAY, 2, 1.5), ("o1", "a" * 32, "c" * 32, DAY, 1, 2.25), ("o1", "a" * 32, "b" * 32, DAY + dt.timedelta(7), 1, None),
        ("o2", "-1", "-1", DAY, 3, 4.0), (None, "-1", "b" * 32, DAY, 1, 1.0), ("o3", "d" * 32, "b" * 32, DAY + dt.timedelta(1), 1, None),
        ("o4", "d" * 32, "b" * 32, dims.UNKNOWN_DATE, 1, 7.0), ("o5", "d" * 32, "b" * 32, DAY + dt.timedelta(31), 1, 9.0),
    ]
    return spark.createDataFrame([(*r[:5], None if r[5] is None else __import__("decimal").Decimal(str(r[5]))) for r in rows], FACT)


def test_reports_shuffle_orders_once(spark):
    fact = fact_of(spark)
    calendar = spark.createDataFrame([(DAY + dt.timedelta(n),) for n in range(40)] + [(dims.UNKNOWN_DATE,)], "date_key date").select(
        "date_key", F.dayofweek("date_key").alias("day_of_week"), F.date_format("date_key", "EEEE").alias("day_name"),
        F.year("date_key").alias("year_number"), F.month("date_key").alias("month_number"), F.date_format("date_key", "MMMM").alias("month_name"),
    )
    weekday = marts.revenue_by_weekday(fact, calendar)
    assert [(r.day_name, None if r.total_sales is None else float(r.total_sales), r.total_orders) for r in weekday.collect()] == [
        ("Monday", 9.0, 1), ("Thursday", 7.0, 1), ("Friday", 8.75, 2), ("Saturday", None, 1)]
    months = marts.revenue_month_over_month(fact, calendar)
    assert [(r.year_month, float(r.current_month_revenue), r.total_orders) for r in months.collect()] == [("2024-03", 8.75, 3), ("2024-04", 9.0, 1)]
    summary = marts.order_value_summary(fact).first()
    assert (float(summary.Revenue), summary.Orders, summary.count_customer) == (3 + 2.25 + 12 + 1 + 7 + 9, 5, 3)
    for report in (marts.revenue_by_weekday(fact, calendar), marts.revenue_month_over_month(fact, calendar), marts.order_value_summary(fact)):
        moved = re.findall(r"Arguments: hashpartitioning\(([^\n]*)", formatted(report))
        assert len([m for m in moved if "order_id" in m]) == 1, moved
    product = spark.createDataFrame([("b" * 32, "B"), ("c" * 32, None), ("-1", "Unknown"), ("e" * 32, "E")], "product_key string, product_name string")
    assert [tuple(r) for r in marts.units_by_product(fact, product).collect()] == [("b" * 32, "B", 6), ("c" * 32, None, 0)]


def test_rules_in_parts_are_the_same(spark):
    child = spark.createDataFrame([(i % 7 or None, "a" * 32 if i % 3 else f"k{i}") for i in range(30)], "i int, s string")
    parent = spark.createDataFrame([(i,) for i in range(3)], "i int")
    listed = [
        rules.not_null("child", "i"), rules.unique("child", "s"), rules.unique("child", "i", "s"), rules.reference("child", "i", "parent"),
        rules.not_in("child", "i", "parent", "i", "known"), rules.unique("parent", "i"),
    ]
    whole = sorted(map(tuple, rules.check({"child": child, "parent": parent}, listed).collect()))
    parts = rules.check({"child": child, "parent": parent}, listed, parts=4)
    assert sorted(map(tuple, parts.collect())) == whole and any(r[3] for r in whole)
    assert "Scan parquet" not in formatted(parts)


def test_written_tables_are_dense_and_checked_in_parts(spark, tmp_path, sources, monkeypatch):  # noqa: F811
    places, products, rates, mapping = sources
    built = Warehouse(spark, f"{tmp_path}/star", dt.date(2024, 12, 31)).build(
        spark.createDataFrame([order(n, n % 5, f"d{n % 3}") for n in range(40)], EVENTS), places, products, rates, mapping
    )
    for table in ("fact_sales_order_detail", "dim_customer"):
        files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{tmp_path}/star/{table}/*.parquet")]
        found = {e for m in files for g in range(m.num_row_groups) for c in range(m.num_columns) for e in m.row_group(g).column(c).encodings}
        assert "DELTA_BYTE_ARRAY" in found
    whole = sorted(map(tuple, checks.check_warehouse(built).collect()))
    monkeypatch.setattr(checks, "ROWS_AT_A_TIME", 50)
    assert sorted(map(tuple, checks.check_warehouse(built).collect())) == whole
