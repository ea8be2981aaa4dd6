"""The registered queries.  Each takes (spark, sf_dir) and reads the benchmark tables there."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ip as ip_functions
from ..functions import price as price_functions
from ..functions import text as text_functions
from ..functions import time as time_functions
from ..functions.keys import UNKNOWN_KEY, surrogate_key
from ..operators import candidates, dates, failures, locate, order, pages, quality, rates, scd2
from ..operators.carry import carry_value, time_chunk
from ..operators.increment import after_mark, increment_table, newer_rows, upsert
from ..operators.lookup import lookup_key, with_audit
from ..session import DENSE_PAGES, configure, cut_lineage, scratch_path, shuffles_freed
from ..sources import files, filescan, harmonize, ledger, leaves, seeds
from ..streaming import ingest, state_tables
from . import adapter, checks, dims, marts, sales
from .adapter import table
from .daily import DailyWarehouse
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# "Today" of all registered runs, so that results do not depend on the clock; after the last order.
TODAY = date(2001, 12, 31)
# A day within the orders, for the query that shows what a calendar leaves out.
EARLY_DAY = date(2001, 6, 30)


def query(run: Query) -> Query:
    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark, sf_dir), sf_dir)

    configured.__name__, configured.__doc__ = run.__name__, run.__doc__
    REGISTRY[run.__name__] = configured
    return configured


def text_time(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def number(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


# Warehouse ----------------------------------------------------------------------------------

# Roots of what was written, per (application, table folder); each session reads the files anew.
_WAREHOUSES: dict[tuple[str, str], str] = {}
_LANDINGS: dict[tuple[str, str], str] = {}


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locate.ip_locations(adapter.order_headers(spark, sf_dir), adapter.ip_ranges(spark, sf_dir))


def landed_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.pivot_rates(adapter.rate_quotes(spark, sf_dir), "seq")


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkout documents as a landed table, written once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDINGS:
        path = scratch_path(spark, "raw_mongo")
        documents = adapter.checkout_events(spark, sf_dir, by_time=True)
        with shuffles_freed(spark):
            files.write_documents(
                documents, path, per_file=1_000_000, partition=["collection"], codec="zstd", options=DENSE_PAGES
            )
        _LANDINGS[key] = path
    return files.read_documents(spark, _LANDINGS[key])


def build_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    events = landing(spark, sf_dir)
    return Warehouse(spark, scratch_path(spark, "warehouse"), TODAY).build(
        events,
        locate.ip_locations(events, adapter.ip_ranges(spark, sf_dir)),
        adapter.raw_products(spark, sf_dir),
        landed_rates(spark, sf_dir),
        seeds.currency_mapping(spark),
    )


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star schema of a table folder, built once per Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = build_warehouse(spark, sf_dir).root
    return Warehouse(spark, _WAREHOUSES[key], TODAY)


@query
def revenue_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = warehouse(spark, sf_dir)
    report = marts.revenue_by_country(built.table("fact_sales_order_detail"), built.table("dim_location"))
    return report.withColumn("Revenue", number("Revenue"))


@query
def revenue_by_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = warehouse(spark, sf_dir)
    report = marts.revenue_by_weekday(built.table("fact_sales_order_detail"), built.table("dim_date"))
    return report.withColumn("total_sales", number("total_sales"))


@query
def units_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = warehouse(spark, sf_dir)
    return marts.units_by_product(built.table("fact_sales_order_detail"), built.table("dim_product"))


@query
def revenue_mom(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = warehouse(spark, sf_dir)
    report = marts.revenue_month_over_month(built.table("fact_sales_order_detail"), built.table("dim_date"))
    money = ("current_month_revenue", "previous_month_revenue", "mom_growth_amount", "mom_growth_rate_pct")
    return report.withColumns(
        {**{name: number(name) for name in money}, "month_start_date": F.col("month_start_date").cast("string")}
    )


@query
def aov_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = marts.order_value_summary(warehouse(spark, sf_dir).table("fact_sales_order_detail"))
    return report.withColumns({"Revenue": number("Revenue"), "AOV": number(F.round("AOV", 4))})


@query
def sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuilds the whole star schema and shows the fact."""
    return _fact_output(build_warehouse(spark, sf_dir).table("fact_sales_order_detail"))


def _fact_output(fact: DataFrame) -> DataFrame:
    return fact.select(
        "detail_key", "customer_key", "product_key", "location_key", "currency_key", "store_key",
        F.col("date_key").cast("string").alias("date_key"), "order_id", text_time("time_stamp").alias("time_stamp"),
        "ip", "sales_amount", number("sales_local_price").alias("sales_local_price"),
        number("sales_usd_price").alias("sales_usd_price"),
    )


def daily_batches(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All checkout documents in three batches: until 1999, then 2000 on, and last the documents of every
    tenth customer since June 2000, whose days have been loaded by then."""
    device = F.regexp_extract("device_id", "dev([0-9]+)", 1).cast("bigint")
    at = time_functions.parse_epoch(F.col("time_stamp"))
    held_back = F.coalesce((device % 10 == 3) & (at >= F.lit("2000-06-01").cast("timestamp")), F.lit(False))
    later = F.coalesce(at >= F.lit("2000-01-01").cast("timestamp"), F.lit(False))
    events = landing(spark, sf_dir)
    return {
        "b1": events.where(~later & ~held_back), "b2": events.where(later & ~held_back), "b3": events.where(held_back)
    }


@query
def fact_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales fact after three loads that each read and replace the months they touch."""
    daily = DailyWarehouse(spark, scratch_path(spark, "daily"), TODAY, grain="month")
    products, quotes, mapping = adapter.raw_products(spark, sf_dir), landed_rates(spark, sf_dir), seeds.currency_mapping(spark)
    for name, events in daily_batches(spark, sf_dir).items():
        daily.land(events, name)
        places = locate.ip_locations(events, adapter.ip_ranges(spark, sf_dir))
        daily.load(places, products, quotes, mapping)
    return _fact_output(daily.table("fact_sales_order_detail"))


@query
def order_lines_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sales.order_lines(
        landing(spark, sf_dir), dims.located_ips(raw_locations(spark, sf_dir))
    )
    return lines.withColumns({"time_stamp": text_time("time_stamp"), "price": number("price")})


# Dimensions ---------------------------------------------------------------------------------


def _version_output(versions: DataFrame) -> DataFrame:
    return versions.withColumns({"start_time": text_time("start_time"), "end_time": text_time("end_time")})


@query
def scd2_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _version_output(dims.dim_customer(adapter.browsing_events(spark, sf_dir)))


@query
def scd2_splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension after four batches in no order of time, so that stored versions are split
    and joined again."""
    store = DailyWarehouse(spark, scratch_path(spark, "splice"), TODAY)
    events = adapter.browsing_events(spark, sf_dir)
    for part in range(4):
        rows = events.where(F.pmod(F.crc32(F.col("_id").cast("binary")), F.lit(4)) == part)
        store.customers.load(dims.customer_states(rows), "record_time", f"b{part}")
    return _version_output(store.dim_customer())


@query
def scd2_asof_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version in force some hours before or after each event."""
    events = adapter.browsing_events(spark, sf_dir)
    shifted = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("device"),
        F.timestamp_seconds(
            F.unix_seconds(F.col("ts").cast("timestamp")) + (F.col("event_id") % 7 - 3) * 3600
        ).alias("at"),
    )
    found = scd2.asof_lookup(
        shifted, dims.customer_versions(events), on=("device", "customer_device_id"), ts="at", key="customer_key"
    )
    return found.select("event_id", F.coalesce("customer_key", F.lit(UNKNOWN_KEY)).alias("customer_key"))


@query
def latest_value_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each second in which a user did something: their last error value before it."""
    seconds = (
        table(spark, sf_dir, "events")
        .select("event_id", "user_id", F.date_trunc("second", F.col("ts").cast("timestamp")).alias("at"), "event_type", "value")
        .groupBy("user_id", "at")
        .agg(F.max_by("value", F.when(F.col("event_type") == "error", F.col("event_id"))).alias("error_value"))
        .withColumn("chunk", time_chunk(F.col("at"), 7))
    )
    return carry_value(seconds, ["user_id"], ["chunk"], ["at"], "error_value", "last_error").select(
        "user_id", text_time("at").alias("at"), "last_error"
    )


@query
def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dims.dim_date(adapter.order_headers(spark, sf_dir), EARLY_DAY)
    return days.withColumn("date_key", F.col("date_key").cast("string"))


@query
def dim_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_store(adapter.order_headers(spark, sf_dir))


@query
def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_location(dims.located_ips(raw_locations(spark, sf_dir)))


@query
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = ("product_base_price", "product_min_price", "product_max_price")
    return dims.dim_product(adapter.raw_products(spark, sf_dir)).withColumns({n: number(n) for n in prices})


@query
def dim_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_currency(landing(spark, sf_dir), seeds.currency_mapping(spark))


# Exchange rates -----------------------------------------------------------------------------


@query
def fx_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_rates(spark, sf_dir).select(
        "date", "base", F.size("rates").alias("n_rates"),
        F.element_at("rates", "EUR").alias("eur"), F.element_at("rates", "AUD").alias("aud"),
        F.array_join(F.map_keys("rates"), ",").alias("codes"),
    )


@query
def fx_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.flatten_rates(landed_rates(spark, sf_dir)).withColumn("date_key", F.col("date_key").cast("string"))


@query
def fx_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = landing(spark, sf_dir)
    result = rates.rates_to_base(
        landed_rates(spark, sf_dir),
        dims.observed_currencies(events, seeds.currency_mapping(spark)),
        dims.calendar(events, TODAY),
    )
    return result.withColumn("date_key", F.col("date_key").cast("string"))


@query
def fx_rejected_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes without a currency or a rate, made by blanking some of the given ones."""
    quotes = adapter.rate_quotes(spark, sf_dir).select(
        "date", "seq",
        F.when(F.col("quote") == "CHF", "").otherwise(F.col("quote")).alias("quote"),
        F.when(F.col("quote") != "JPY", F.col("rate")).alias("rate"),
    )
    return rates.rejected_quotes(quotes).groupBy("date").agg(F.count("*").alias("n_rejected"))


# Functions ----------------------------------------------------------------------------------


@query
def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = adapter.priced_lines(spark, sf_dir).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.expr(adapter.price_text()).alias("raw_price")
    )
    return lines.withColumn("price", number(price_functions.parse_price(F.col("raw_price"))))


@query
def price_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices with a blank inside cannot be read: how many per line number."""
    text = F.expr(adapter.price_text())
    spaced = F.when(F.col("l_quantity") > 25, F.replace(text, F.lit(","), F.lit(" , "))).otherwise(text)
    lines = adapter.priced_lines(spark, sf_dir).select("l_linenumber", spaced.alias("raw_price"))
    price = price_functions.parse_price(F.col("raw_price"), strict=False)
    return lines.groupBy("l_linenumber").agg(
        F.count_if(price_functions.bad_price(F.col("raw_price"))).alias("n_bad"), F.count(price).alias("n_good")
    )


@query
def epoch_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    text = seconds.cast("string")
    kind = F.col("event_id") % 6
    raw = (
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(F.lit(" \t"), text, F.lit(" ")))
        .when(kind == 2, F.concat(text, F.lit(".0")))
        .when(kind == 3, F.lit(" "))
        .when(kind == 4, F.concat(text, F.lit("000")))
        .otherwise((-seconds).cast("string"))
    )
    events = table(spark, sf_dir, "events").select("event_id", raw.alias("raw_time"))
    return events.withColumn("time_stamp", text_time(time_functions.parse_epoch(F.col("raw_time"))))


@query
def local_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.browsing_events(spark, sf_dir).select("_id", "local_time")
    return events.withColumn("date", time_functions.local_date(F.col("local_time")).cast("string"))


@query
def calendar_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar attributes of every distinct ship date."""
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    fields = time_functions.calendar_fields(F.col("day"))
    return days.select(F.col("day").cast("string").alias("day"), *[c.alias(name) for name, c in fields.items()])


@query
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id", text_functions.store_domain(F.col("url")).alias("store_domain")
    )


@query
def url_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.browsing_events(spark, sf_dir)
    return events.select("_id", text_functions.clean_url(F.col("current_url")).alias("url"))


@query
def id_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.browsing_events(spark, sf_dir)
    return events.select(
        "_id",
        text_functions.clean_id(F.col("product_id")).alias("product_id"),
        F.coalesce(
            text_functions.same_id(F.col("product_id"), F.concat("viewing_product_id", F.lit(".0"))), F.lit(False)
        ).alias("same"),
    )


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        surrogate_key(F.col("p_name"), F.col("p_brand")).alias("name_key"),
        surrogate_key(F.when(F.col("p_size") > 10, F.col("p_partkey"))).alias("part_key"),
    )


@query
def ip_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.browsing_events(spark, sf_dir).select("_id", "ip")
    return events.withColumn("canonical", ip_functions.canonical_ip(F.col("ip")))


@query
def place_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = adapter.ip_ranges(spark, sf_dir)
    cleaned = locate.clean_place({name: F.col(name) for name in locate.PLACE})
    return ranges.select("ip_from", *[c.alias(name) for name, c in cleaned.items()])


@query
def uri_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text_functions.split_uri(F.col("url")).alias("u")).select(
        "page_id", "u.scheme", "u.bucket", "u.prefix"
    )


# Increments ---------------------------------------------------------------------------------


def _split_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders in two loads: until 1999, and later with some older, changed rows."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("timestamp").alias("time_stamp"),
        F.col("o_totalprice").alias("price"),
    )
    cut = F.lit("1999-01-01").cast("timestamp")
    first = orders.where(F.col("time_stamp") < cut)
    late = (F.col("price") > 400000) & (F.col("time_stamp") < cut)
    second = orders.where((F.col("time_stamp") >= cut) | late).withColumn("price", F.col("price") + 1)
    return first, second


def _order_output(df: DataFrame) -> DataFrame:
    return df.select("order_id", text_time("time_stamp").alias("time_stamp"), "price")


@query
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _split_orders(spark, sf_dir)
    return _order_output(upsert(first, second, ["order_id", "time_stamp"]))


@query
def late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _split_orders(spark, sf_dir)
    return _order_output(first.unionByName(newer_rows(second, first, "time_stamp")))


@query
def incremental_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads into a table: the first one, a merge, and the same batch again."""
    first, second = (
        df.withColumn("month", F.date_format("time_stamp", "yyyy-MM")) for df in _split_orders(spark, sf_dir)
    )
    path, keys = scratch_path(spark, "orders"), ["order_id", "time_stamp"]
    increment_table(spark, path, first, keys, "time_stamp", partition="month")
    increment_table(spark, path, second, keys, "time_stamp", partition="month", lateness="merge")
    return _order_output(increment_table(spark, path, second, keys, "time_stamp", partition="month"))


@query
def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events beyond a stored document id, and the next mark."""
    mark = f"{4_321:024d}"
    fresh = after_mark(adapter.browsing_events(spark, sf_dir), "_id", mark)
    return fresh.groupBy("collection").agg(F.count("*").alias("n"), F.max("_id").alias("next_mark"))


# Enrichment ---------------------------------------------------------------------------------


@query
def url_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.url_candidates(adapter.browsing_events(spark, sf_dir))


@query
def product_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.product_sightings(adapter.browsing_events(spark, sf_dir))


@query
def new_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.new_products(
        adapter.browsing_events(spark, sf_dir), _known_products(spark, sf_dir)
    )


def _known_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select((F.col("n_nationkey") * 3).cast("string").alias("product_id"))


@query
def discovery_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.discovery_counts(adapter.browsing_events(spark, sf_dir), _known_products(spark, sf_dir))


@query
def attempt_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = candidates.url_candidates(adapter.browsing_events(spark, sf_dir))
    return candidates.attempt_urls(
        found.select("product_id").distinct(), found, "https://shop.example.com/p/{product_id}?v=1"
    )


@query
def value_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seeds.currency_frequency(dates.checkouts(landing(spark, sf_dir)))


@query
def fx_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dates.local_dates(dates.checkouts(adapter.browsing_events(spark, sf_dir)))
    return found.select(F.col("date").cast("string").alias("date"))


@query
def date_scan_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.date_scan_statistics(dates.checkouts(adapter.browsing_events(spark, sf_dir)))


@query
def ip_scan_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = adapter.browsing_events(spark, sf_dir)
    raw = locate.distinct_ips(events)
    located = locate.ip_locations(events, adapter.ip_ranges(spark, sf_dir), errors=True)
    return locate.location_statistics(raw, cut_lineage(located))


def nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges of the nations, a wide one round them all, and inside each one that overlaps the next."""
    base = adapter.ip_ranges(spark, sf_dir)
    at = lambda name, low, high: base.withColumns({
        "ip_to": F.col("ip_from") + high, "ip_from": F.col("ip_from") + low,
        "city_name": F.concat(F.lit(name), F.col("ip_from").cast("string")), "country_code": F.lit("ZZ"),
    })
    wide = base.limit(0).unionByName(spark.range(1).select(
        F.lit(167772160 - 5).alias("ip_from"), F.lit(167772160 + 40 * 65536).alias("ip_to"), F.lit("wide").alias("city_name"),
        F.lit("all").alias("region_name"), F.lit("WW").alias("country_code"), F.lit("World").alias("country_name"),
        F.lit("1.5").alias("latitude"), F.lit("n/a").alias("longitude"),
    ))
    return base.unionByName(at("inner ", 10, 29)).unionByName(at("over ", 20, 59)).unionByName(wide)


@query
def ip_nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of browsing events in ranges that contain and overlap each other."""
    return locate.ip_locations(adapter.browsing_events(spark, sf_dir), nested_ranges(spark, sf_dir), errors=True)


@query
def ip_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locate.ip_locations(adapter.browsing_events(spark, sf_dir), adapter.ip_ranges(spark, sf_dir))


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failed_attempts(table(spark, sf_dir, "events"))


def _failed_attempts(events: DataFrame) -> DataFrame:
    """Every event as a failed attempt at one of the user's URLs."""
    user = F.col("user_id").cast("string")
    return events.select(
        user.alias("product_id"),
        F.concat(F.lit("https://shop.example.com/p/"), user, F.lit("?v="), F.col("event_id") % 3).alias("url"),
        F.concat("event_type", F.lit(" "), F.repeat(F.lit("."), 2000), F.col("event_id")).alias("error"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("via "), F.col("event_id"))).alias("recovered_via"),
    )


def _ledger_output(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "last_failed_at": text_time("last_failed_at"),
            "error_length": F.length("last_error"),
            "last_error": F.right("last_error", F.lit(10)),
        }
    )


@query
def failure_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ledger_output(failures.failure_ledger(_attempts(spark, sf_dir)))


def _product_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("product_id"),
        F.when(F.col("o_orderstatus") == "O", "pending").when(F.col("o_orderstatus") == "F", "done")
        .otherwise("failed").alias("status"),
    )


@query
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    states = _product_states(spark, sf_dir)
    return failures.job_statistics(
        states,
        states.where(F.col("status") == "done"),
        candidates.url_candidates(adapter.browsing_events(spark, sf_dir)),
        failures.failure_ledger(_attempts(spark, sf_dir)),
    )


@query
def pending_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures.next_pending(_product_states(spark, sf_dir), 100)


def _script_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one more script at their end that names the data URL."""
    kind = F.col("page_id") % 4
    key = F.col("page_id").cast("string")
    script = (
        F.when(kind == 0, F.concat(F.lit(r"<script>var React_Data_URL = '\/api/p?id="), key, F.lit(r"&amp;a=\'x';</script>")))
        .when(kind == 1, F.concat(F.lit(r'<script>react_data_url="https:\/\/data.example.com\/'), key, F.lit('"</script>')))
        .when(kind == 2, F.lit("<script>react_data_url='mailto:x'</script>"))
        .otherwise(F.lit("<script>my_react_data_url='/no'</script>"))
    )
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", script).alias("html"))


@query
def script_var_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.script_variable_url(_script_pages(spark, sf_dir)).drop("html")


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched pages: four URLs per part in turn, wrapped differently, some of them broken."""
    tries = F.explode(F.sequence(F.lit(0), F.lit(3)))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", tries.alias("priority"))
    key, name = F.col("p_partkey").cast("string"), F.col("p_name")
    bad = F.col("priority") < F.col("p_size") % 5
    wrong = F.concat(F.lit('{"a": [1, {"product_id": "'), key, F.lit('x", "name": "n"}]}'))
    lists = F.concat(F.lit('[{"b": {"product_id": 0}}, {"data": {"product": {"product_id": '), key,
                     F.lit('.0, "sku": "s", "name": "'), name, F.lit('"}}}]'))
    plain = F.concat(F.lit('{"product_id": "'), key, F.lit('", "name": "'), name, F.lit('", "extra": 1}'))
    payload = F.when(bad & (F.col("priority") == 1), wrong).when(bad, F.lit('{"x": [null, 1]}')).otherwise(
        F.when(F.col("priority") % 2 == 0, plain).otherwise(lists)
    )
    return part.select(
        key.alias("product_id"), "priority",
        F.concat(F.lit("u"), "priority").alias("url"),
        payload.alias("payload"),
        F.when(bad & (F.col("priority") == 2), F.lit("timeout")).alias("error"),
    )


@query
def json_object_find(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.find_products(_payloads(spark, sf_dir).drop("error"))
    inner = pages.product_fields(F.col("product"), ("product_id", "sku", "name"))
    return found.select(
        F.col("product_id").alias("requested"), "priority",
        *[c.alias(name) for c, name in zip(inner, ("found_id", "sku", "name"))],
        F.col("error").isNotNull().alias("missing"),
    )


@query
def fetched_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = pages.judge_attempts(_payloads(spark, sf_dir))
    return pages.fetched_products(judged).select(
        F.col("product_id").alias("requested"), "priority", "source_url",
        *[c.alias(n) for c, n in zip(pages.product_fields(F.col("product"), ("name", "sku")), ("name", "sku"))],
    )


@query
def fetch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.fetch_failures(pages.judge_attempts(_payloads(spark, sf_dir)))


@query
def lost_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.lost_products(pages.judge_attempts(_payloads(spark, sf_dir)))


@query
def dim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores with the four audit columns."""
    stores = with_audit(dims.dim_store(adapter.order_headers(spark, sf_dir)), today=TODAY)
    return stores.select("store_id", "store_domain", *[
        F.col(name).cast("string").alias(name) for name in ("inserted_date", "inserted_by", "updated_date", "updated_by")
    ])


@query
def seed_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The currency seed, read from CSV, with the number of cart items that use each row."""
    path = scratch_path(spark, "seed")
    seeds.currency_mapping(spark).write.option("header", "true").csv(path)
    used = seeds.currency_frequency(landing(spark, sf_dir))
    return seeds.read_seed(spark, path).join(used, "raw_currency").select("raw_currency", "currency_code", "occurrences")


@query
def dq_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of the seed on the currency texts of all cart items, of which some have no row."""
    used = seeds.currency_frequency(landing(spark, sf_dir)).select("raw_currency")
    seed = used.join(seeds.currency_mapping(spark), "raw_currency", "left")
    return checks.check_seed(seed.select("raw_currency", "currency_code", "currency_name"))


@query
def lost_without_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lost products of which every other try has no URL; no error gets lost."""
    tries = _payloads(spark, sf_dir).withColumn("url", F.when(F.col("priority") % 2 == 1, F.col("url")))
    return pages.lost_products(pages.judge_attempts(tries))


@query
def json_object_hard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products behind 25,000 values, half a surrogate pair, broken and very deep JSON."""
    key = F.col("p_partkey").cast("string")
    product = F.concat(F.lit('{"product_id": "'), key, F.lit('", "sku": "s", "name": "a\\ud83d"}'))
    kind = F.col("p_partkey") % 40
    payload = (
        F.when(kind == 0, F.concat(F.lit('{"x": ['), F.repeat(F.lit("1,"), 25_000), product, F.lit("]}")))
        .when(kind == 1, F.lit('{"a":'))
        .when(kind == 2, F.concat(F.repeat(F.lit("["), 100_000), product))
        .otherwise(product)
    )
    found = pages.find_products(table(spark, sf_dir, "part").select("p_partkey", payload.alias("payload")))
    inner = pages.product_fields(F.col("product"), ("product_id", "name"))
    return found.select("p_partkey", *[c.alias(n) for c, n in zip(inner, ("found_id", "name"))], "error")


# Landing ------------------------------------------------------------------------------------


@query
def string_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders nested, then every leaf as text."""
    orders = table(spark, sf_dir, "orders")
    nested = orders.select(
        "o_orderkey",
        F.struct(
            F.col("o_orderdate").cast("timestamp").alias("at"),
            F.to_date("o_orderdate").alias("day"),
            (F.col("o_custkey") % 2 == 0).alias("even"),
        ).alias("meta"),
        F.array(F.struct(F.col("o_custkey").alias("id"), F.encode("o_orderstatus", "utf-8").alias("raw"))).alias("items"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("total"),
        F.col("o_totalprice").alias("price"),
    )
    return leaves.with_text_leaves(nested).select(
        "o_orderkey", F.col("meta.at").alias("placed_at"), "meta.day", "meta.even",
        F.get("items", F.lit(0))["id"].alias("item_id"), F.get("items", F.lit(0))["raw"].alias("item_raw"), "total",
        "price",
    )


@query
def string_leaf_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles that need an exponent somewhere, as text."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderkey") * 1024.5e4).alias("large"), (F.col("o_orderkey") / 2.0**33).alias("small")
    )
    return leaves.with_text_leaves(orders)


@query
def string_leaf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of numbers become arrays of text."""
    texts = leaves.with_text_leaves(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    return texts.select(
        "vec_id", "label", F.size("embedding").alias("n"), F.array_join("embedding", ",").alias("texts")
    )


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as JSON whose ``tags`` and ``meta`` fields change shape and whose ``ids`` are
    keyed by ids; white space may come first, and some repeat a key, which makes them unreadable."""
    kind = F.col("turn") % 4
    tags = (
        F.when(kind == 0, F.lit('[{"name": "a", "w": 1.50}]')).when(kind == 1, F.lit('{"name": "b"}'))
        .when(kind == 2, F.lit('"legacy"')).otherwise(F.lit("null"))
    )
    meta = F.when(kind == 0, F.lit("5")).otherwise(F.lit('{"deep": {"x": true}}'))
    space = F.when(F.col("turn") % 3 == 0, F.lit("\n\t")).otherwise(F.lit(""))
    again = F.when(F.col("conv_id") % 10 == 9, F.lit(', "id": 0')).otherwise(F.lit(""))
    ids = F.concat(F.lit(', "ids": {"c'), "conv_id", F.lit("-"), "turn", F.lit('": {"n": '), "turn", F.lit("}}"), again)
    return table(spark, sf_dir, "conversations").select(
        F.concat(space, F.lit('{"id": '), "conv_id", F.lit(', "turn": '), "turn", F.lit(', "role": "'), "role",
                 F.lit('", "tags": '), tags, F.lit(', "meta": '), meta, ids, F.lit("}")).alias("document")
    )


@query
def harmonize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = harmonize.harmonize_json(_documents(spark, sf_dir), "document", max_keys=20)
    tag = F.get("tags", F.lit(0))
    return documents.select(
        "id", "turn", "role", F.size("tags").alias("n_tags"), tag["_value"].alias("tag_value"),
        tag["name"].alias("tag_name"), tag["w"].alias("tag_w"), F.col("meta._value").alias("meta_value"),
        F.col("meta.deep.x").alias("meta_x"), F.get(F.map_keys("ids"), F.lit(0)).alias("own_id"),
        F.get(F.map_values("ids"), F.lit(0))["n"].alias("own_n"),
    )


@query
def harmonize_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON of which some is broken or no object: harmonised rows and rejected ones.

    Any white space of JSON may come first; what is rejected adds no column.
    """
    kind = F.col("event_id") % 10
    documents = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == 0, F.lit('{"a":')).when(kind == 1, F.lit("[1]")).when(kind == 2, F.lit('{"b": NaN}'))
        .when(kind == 3, F.lit('{"c": 1, "c": 2}'))
        .otherwise(F.concat(
            F.when(kind == 4, F.lit("\n")).when(kind == 5, F.lit("\t\r\n ")).otherwise(F.lit("")),
            F.lit('{"id": '), "event_id", F.lit("}"),
        )).alias("document"),
    )
    good = harmonize.harmonize_json(documents, "document", ["event_id"])
    good = good.select(*good.columns, F.lit(False).alias("rejected"))
    bad = harmonize.rejected_documents(documents, "document")
    return good.unionByName(bad.select("event_id", F.lit(None).cast("string").alias("id"), F.lit(True).alias("rejected")))


@query
def harmonize_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers, of different column types, as one frame."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("note")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_nationkey").alias("balance"),
        F.array(F.col("s_name")).alias("note"),
    )
    return harmonize.union_harmonized([customers, suppliers]).select("id", "balance", F.get("note", F.lit(0)).alias("note"))


@query
def bulk_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as files by type, rewritten with text leaves; the second run skips them."""
    source, target = scratch_path(spark, "documents"), scratch_path(spark, "texts")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    files.write_documents(events, source)
    first = files.rewrite_files(spark, source, target)
    second = files.rewrite_files(spark, source, target)
    rows = spark.read.parquet(target)
    return (
        first.groupBy("status").agg(F.sum("rows").alias("rows"))
        .unionByName(second.groupBy("status").agg(F.sum("rows").alias("rows")))
        .unionByName(rows.groupBy(F.concat(F.lit("text "), F.col("event_type")).alias("status")).agg(
            F.count(F.col("value").cast("double")).alias("rows")))
    )


def _file_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an announcement of a file; files come in several generations, some twice."""
    folder = adapter.SPARK.pick(
        ["mongodb_data_string/", "location_data/", "product_data/", "exchange_rate_data/", "Product_data/"], "event_id % 5"
    )
    ending = adapter.SPARK.pick([".jsonl", ".JSONL", ".parquet"], "event_id % 3")
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "other").otherwise("landing").alias("bucket"),
        F.expr(f"{folder} || (event_id % 1000) || {ending}").alias("name"),
        (F.col("user_id") % 3).alias("generation"),
    )


@query
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.route_files(_file_events(spark, sf_dir), "landing")


@query
def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routed files whose generation is not in a ledger of all first generations."""
    routed = ledger.route_files(_file_events(spark, sf_dir), "landing")
    loaded = ledger.with_load_id(routed.where(F.col("generation") == 0))
    return ledger.unloaded(routed, loaded).select("load_id", "name", "generation", "destination")


@query
def ledger_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files loaded into a landing table by two runs; each row arrives once."""
    source, root = scratch_path(spark, "arrived"), scratch_path(spark, "landing")
    files.write_documents(table(spark, sf_dir, "events").select("event_id", "event_type", "value"), source)
    arrived = files.list_files(spark, source, "*.parquet").select(
        F.lit("landing").alias("bucket"),
        F.concat(F.lit("mongodb_data_string/"), "name").alias("name"),
        F.unix_millis("modificationTime").alias("generation"),
        F.col("path").alias("uri"),
    )
    routed = ledger.route_files(arrived, "landing")
    for _ in range(2):
        ledger.append_once(spark, routed, root, "raw_mongo", lambda arrived: filescan.parquet_rows(arrived, ["batch"]))
    landed = ledger.landed(spark, root, "raw_mongo")
    return landed.groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last_event"))


@query
def ledger_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of which the second brings a new column; rows of the first read NULL there."""
    root = scratch_path(spark, "landing")
    for columns in (["event_id", "event_type"], ["event_id", "event_type", "value"]):
        source = scratch_path(spark, "arrived")
        files.write_documents(table(spark, sf_dir, "events").select(*columns), source)
        arrived = files.list_files(spark, source, "*.parquet").select(
            F.lit("landing").alias("bucket"), F.concat(F.lit("mongodb_data_string/"), "name").alias("name"),
            F.lit(len(columns)).alias("generation"), F.col("path").alias("uri"),
        )
        ledger.append_once(
            spark, ledger.route_files(arrived, "landing"), root, "raw_mongo",
            lambda arrived: filescan.parquet_rows(arrived, ["batch"]),
        )
    return ledger.landed(spark, root, "raw_mongo").groupBy("event_type").agg(
        F.count("*").alias("n"), F.count("value").alias("n_values")
    )


@query
def batch_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in exact batches of 1,500 with first id, last id and size."""
    return files.manifest(_numbered_events(spark, sf_dir), "_id")


def _numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = adapter.browsing_events(spark, sf_dir).select("_id")
    number = F.col("_id").cast("bigint")
    return files.number_files(ids, "_id", [F.shiftright(number, 20), F.shiftright(number, 10)], 1500)


@query
def batch_object_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 1,500 events whose ids are 24 hex digits, of which eight are a time."""
    digits = lambda c, n: F.lower(F.lpad(F.hex(c), n, "0"))
    ids = table(spark, sf_dir, "events").select(
        F.concat(digits(F.unix_timestamp("ts"), 8), digits(F.col("event_id"), 16)).alias("_id")
    )
    return files.manifest(files.number_files(ids, "_id", files.object_id_buckets("_id"), 1500), "_id")


@query
def batch_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches written by two runs, as they are read back."""
    path = scratch_path(spark, "batches")
    for _ in range(2):
        files.commit_batches(spark, _numbered_events(spark, sf_dir), "_id", path)
    return files.manifest(files.read_batches(spark, path), "_id")


@query
def manifest_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planned batches against a stored manifest that knows some, one of them differently."""
    plan = files.manifest(_numbered_events(spark, sf_dir), "_id")
    stored = plan.where(F.col("file_no") <= 3).withColumn(
        "document_count", F.col("document_count") + F.when(F.col("file_no") == 2, 1).otherwise(0)
    )
    return files.compare_manifests(plan, stored).select("file_no", "state")


@query
def load_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.load_state(files.manifest(_numbered_events(spark, sf_dir), "_id"), "/mongodb_data/")


@query
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.load_report(table(spark, sf_dir, "embeddings"))


@query
def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products exported as JSON lines with their crawl record, and read again."""
    path = scratch_path(spark, "products")
    products = adapter.raw_products(spark, sf_dir).select(
        "product_id", F.trim("name").alias("name"), "sku",
        F.struct(F.col("product_id").alias("requested_product_id"),
                 F.concat(F.lit("https://shop.example.com/p/"), "product_id").alias("source_url")).alias("_crawl"),
    )
    files.export_products(products, path)
    schema = "product_id string, name string, sku string, _crawl struct<requested_product_id:string,source_url:string>"
    return spark.read.schema(schema).json(path).select("product_id", "name", "sku", "_crawl.source_url")


# Streams ------------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table cut into files by day, as a stream of a few files per micro-batch."""
    folder = scratch_path(spark, "arriving")
    events = table(spark, sf_dir, "events")
    days = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    days.repartition("day").write.partitionBy("day").parquet(folder)
    return ingest.file_stream(spark, folder, days.schema, files_per_batch=8).drop("day")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files appended by two runs of the same stream; each row arrives once."""
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "offsets")
    stream = _event_stream(spark, sf_dir)
    for _ in range(2):
        ingest.append_stream(stream, target, checkpoint)
    return spark.read.parquet(target).select("event_id", "user_id", "event_type", "value")


@query
def stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as documents and customers as locations, put into a bucket and loaded by two runs."""
    bucket, tables, marks = (scratch_path(spark, name) for name in ("bucket", "landing", "offsets"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    places = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    events.write.parquet(f"{bucket}/mongodb_data_string")
    places.write.json(f"{bucket}/location_data")
    schemas = {"raw_mongo": events.schema, "raw_location": places.schema}
    # Spark itself writes JSON lines as .json.
    routes = (ledger.ROUTES[0], ledger.Route("location_data/", ".json", "raw_location"))
    for _ in range(2):
        ingest.ingest_routes(spark, bucket, schemas, tables, marks, routes)
    documents, locations = spark.read.parquet(f"{tables}/raw_mongo"), spark.read.parquet(f"{tables}/raw_location")
    return documents.groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("n")).unionByName(
        locations.groupBy(F.col("c_mktsegment").alias("kind")).agg(F.count("*").alias("n"))
    )


@query
def stream_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = _event_stream(spark, sf_dir)
    events = stream.select(*[F.expr(text).alias(name) for name, text in adapter.event_fields(adapter.SPARK).items()])
    state = scratch_path(spark, "candidates")
    state_tables.stream_candidates(events, state, scratch_path(spark, "offsets"))
    return state_tables.current_candidates(spark, state)


@query
def stream_failure_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = scratch_path(spark, "failures")
    state_tables.stream_failures(_failed_attempts(_event_stream(spark, sf_dir)), state, scratch_path(spark, "offsets"))
    return _ledger_output(state_tables.current_failures(spark, state))


@query
def stream_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries, each with its own checkpoint, that feed one failure ledger."""
    state = scratch_path(spark, "failures")
    for half in (0, 1):
        attempts = _failed_attempts(_event_stream(spark, sf_dir).where(F.col("event_id") % 2 == half))
        state_tables.stream_failures(attempts, state, scratch_path(spark, "offsets"))
    return _ledger_output(state_tables.current_failures(spark, state))


@query
def increment_null_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose marks are all NULL: a second run adds nothing."""
    path = scratch_path(spark, "unmarked")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.lit(None).cast("timestamp").alias("ts")
    )
    for _ in range(2):
        loaded = increment_table(spark, path, rows, ["event_id"], "ts")
    return loaded.groupBy("event_type").agg(F.count("*").alias("n"))


@query
def stream_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches merged into a table by event; late files are merged too."""
    state = scratch_path(spark, "increments")
    rows = _event_stream(spark, sf_dir).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "value", F.date_format("ts", "yyyy-MM-dd").alias("date")
    )
    state_tables.stream_increments(
        rows, state, scratch_path(spark, "offsets"), ["event_id", "ts"], "ts", lateness="merge", partition="date"
    )
    return spark.read.parquet(state).select("event_id", "value")


# Data quality -------------------------------------------------------------------------------


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = warehouse(spark, sf_dir).table("fact_sales_order_detail")
    return quality.not_null(fact, "detail_key").select("order_id", "product_key")


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(table(spark, sf_dir, "lineitem"), "l_partkey")


@query
def dq_compound_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compound_unique(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"], "l_quantity > 0"
    )


@query
def dq_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ids of lines, shifted, that have no order."""
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + 100).alias("order_id"))
    return quality.relationship(lines, "order_id", table(spark, sf_dir, "orders"), "o_orderkey")


@query
def dq_active_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions where each customer's latest is not current if it is an error."""
    versions = dims.customer_versions(adapter.browsing_events(spark, sf_dir))
    broken = versions.withColumn(
        "is_current", F.col("is_current") & (F.col("customer_user_agent") != "error")
    )
    return quality.without_active_version(broken, "customer_device_id", "customer_key")


@query
def dq_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates that are no order date."""
    ships = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day")).groupBy("day").agg(
        F.count("*").alias("n_lines"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date_key"))
    missing = quality.not_in(ships, "day", orders, "date_key")
    return missing.withColumn("day", F.col("day").cast("string"))


@query
def dq_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed and one proposed row per nation against the currencies of all orders."""
    seed = seeds.currency_mapping(spark)
    proposed = table(spark, sf_dir, "nation").select(
        F.when(F.col("n_nationkey") == 1, "€").when(F.col("n_nationkey") == 2, "BTC")
        .when(F.col("n_nationkey") == 3, "points").otherwise(F.col("n_name")).alias("raw_currency"),
        F.when(F.col("n_nationkey") == 2, "xbt").otherwise("P1").alias("currency_code"),
        F.lit(" coin ").alias("currency_name"),
    )
    observed = table(spark, sf_dir, "orders").selectExpr(
        f"trim({adapter.currency_text(adapter.SPARK, 0)}) AS raw_currency"
    )
    return seeds.checked_mapping(seed.unionByName(proposed), observed)


@query
def dq_table_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = warehouse(spark, sf_dir).table("fact_sales_order_detail")
    return quality.check_table(
        fact,
        {"detail_key": ["not_null", "unique"], "time_stamp": ["not_null"], "sales_amount": ["not_null"],
         "sales_usd_price": ["not_null"], "customer_key": ["not_null"]},
    )


@query
def dq_warehouse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of the star schema that some row breaks."""
    return checks.check_warehouse(warehouse(spark, sf_dir)).where(F.col("violations") > 0)


@query
def masked_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat("c_name", F.lit("@Example.com ")).alias("email_address")
    )
    return quality.masked_view(customers, "email_address", "pii")


@query
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the segment of their customer, customers being known from key 100 on."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") - 100).alias("customer"))
    customers = table(spark, sf_dir, "customer")
    return lookup_key(orders, customers, {"customer": "c_custkey"}, "c_mktsegment", "segment").select(
        "o_orderkey", F.coalesce("segment", F.lit("Unknown")).alias("segment")
    )


@query
def currency_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals, taken as amounts in several currencies, at the rate of the day."""
    currencies = seeds.currency_mapping(spark).select(
        "currency_code", surrogate_key(F.col("currency_code")).alias("currency_key")
    ).distinct()
    days = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date_key")).distinct()
    daily = rates.rates_to_base(landed_rates(spark, sf_dir), currencies, days)
    codes = adapter.SPARK.pick(["EUR", "USD", "SEK", "XXX"], "o_custkey % 4")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("date_key"),
        surrogate_key(F.expr(codes)).alias("currency_key"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    return rates.convert(orders, daily, "price", "usd").select("o_orderkey", number("usd").alias("usd"))


@query
def report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered outputs with the place at which the written files have each row."""
    built = warehouse(spark, sf_dir)
    fact = built.table("fact_sales_order_detail")
    reports = {
        "revenue_by_country": (marts.revenue_by_country(fact, built.table("dim_location")), number("Revenue")),
        "revenue_by_weekday": (marts.revenue_by_weekday(fact, built.table("dim_date")), number("day_of_week")),
        "units_by_product": (marts.units_by_product(fact, built.table("dim_product")), number("unit_sold")),
        "revenue_mom": (
            marts.revenue_month_over_month(fact, built.table("dim_date")), number(F.col("year_number") * 100 + F.col("month_number"))
        ),
        "fx_dates": (
            dates.local_dates(dates.checkouts(adapter.browsing_events(spark, sf_dir))), number(F.unix_date("date"))
        ),
    }
    parts = []
    for name, (report, key) in reports.items():
        path = scratch_path(spark, name)
        report.write.parquet(path)
        parts.append(order.parquet_places(spark, path).select(F.lit(name).alias("report"), order.PLACE, key.alias("key")))
    path = scratch_path(spark, "products")
    files.export_products(adapter.raw_products(spark, sf_dir).select("product_id", "sku"), path)
    listed = files.list_files(spark, path, "*.json").select(F.col("path").alias("uri"), "name")
    product = F.get_json_object("value", "$.product_id").cast("double")
    parts.append(order.line_places(listed).select(F.lit("export").alias("report"), order.PLACE, product.alias("key")))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


@query
def fact_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column descriptions as the written fact has them, with the rows that have a value."""
    fact = warehouse(spark, sf_dir).table("fact_sales_order_detail")
    described = [(f.name, f.metadata["comment"]) for f in fact.schema.fields if "comment" in f.metadata]
    listed = F.explode(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.lit(text).alias("description"), F.col(name).alias("n_values"))
        for name, text in described
    ]))
    return fact.agg(*[F.count(name).alias(name) for name, _ in described]).select(listed.alias("c")).select("c.*")


@query
def zone_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day of the warehouse's zone, and per day of one that is half an hour off."""
    moments = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"))
    zones = (time_functions.WAREHOUSE_ZONE, "Asia/Kolkata", "UTC")
    days = F.explode(F.array(*[
        F.struct(F.lit(zone).alias("zone"), time_functions.day_in(F.col("at"), zone).cast("string").alias("day")) for zone in zones
    ]))
    return moments.select(days.alias("d")).select("d.*").groupBy("zone", "day").agg(F.count("*").alias("n"))


@query
def product_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All kept fields of products found in payloads; a fifth of the fields is missing, a fifth null."""
    parts = []
    for i, name in enumerate(pages.PRODUCT_FIELDS):
        kind = (F.col("p_partkey") + i) % 5
        value = F.concat(F.lit(f'"{name}": "v{i}-'), F.col("p_partkey").cast("string"), F.lit('"'))
        if i:
            value = F.when(kind == 1, F.lit(f'"{name}": null')).when(kind > 1, value)
        parts.append(value)
    inner = F.array_join(F.array_compact(F.array(*parts)), ", ")
    payloads = table(spark, sf_dir, "part").select(
        F.concat(F.lit('{"page": {"items": [{"product": {'), inner, F.lit('}}]}, "other": 1}')).alias("payload")
    )
    return pages.find_products(payloads).select(*pages.product_fields(F.col("product")))


@query
def candidate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate URLs per source event and priority."""
    found = candidates.url_candidates(adapter.browsing_events(spark, sf_dir))
    return found.groupBy("source", "priority").agg(F.count("*").alias("n_urls"))


@query
def dim_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A persisted dimension as an SQL view."""
    built = warehouse(spark, sf_dir)
    built.view("dim_customer")
    return spark.sql(
        "SELECT count(DISTINCT customer_device_id) AS customers, count(*) AS versions,"
        " count_if(is_current) AS current_versions FROM dim_customer WHERE customer_key <> '-1'"
    )
