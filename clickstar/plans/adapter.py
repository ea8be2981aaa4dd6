"""Gives the benchmark tables the shape of landing data.

The formulas are plain SQL text that Spark and the checking engine share; the few functions that
are spelled differently come from a dialect.  Values are functions of whole rows of the tables;
no row is left out.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.seeds import CURRENCY_MAPPING

RAW_CURRENCIES = [raw for raw, _, _ in CURRENCY_MAPPING] + ["BTC", "points"]
HOSTS = [
    "https://www.Shop.de/checkout", "http://shop.com:8080/cart?x=1", "https://shop.co.uk",
    "https://localhost/checkout", "HTTPS://shop.fr/checkout",
]


@dataclass(frozen=True)
class Dialect:
    epoch: str
    array: str
    item: str
    json_k: str
    stamp: str
    day_of_year: str
    weekday: str

    def pick(self, values: list[str], index: str) -> str:
        listed = ", ".join(f"'{value}'" for value in values)
        return self.item.format(array=self.array.format(listed), index=index)


SPARK = Dialect(
    epoch="unix_seconds(CAST({} AS TIMESTAMP))",
    array="array({})",
    item="element_at({array}, CAST({index} AS INT) + 1)",
    json_k="get_json_object(props, '$.k')",
    stamp="date_format({}, 'yyyy-MM-dd HH:mm:ss')",
    day_of_year="dayofyear({})",
    weekday="dayofweek({})",
)
DUCK = Dialect(
    epoch="CAST(floor(epoch({})) AS BIGINT)",
    array="[{}]",
    item="list_extract({array}, CAST({index} AS INT) + 1)",
    json_k="json_extract_string(props, '$.k')",
    stamp="strftime({}, '%Y-%m-%d %H:%M:%S')",
    day_of_year="dayofyear({})",
    weekday="(dayofweek({}) + 1)",
)


def _text(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _whole(x: str) -> str:
    return f"CAST(floor({x}) AS BIGINT)"


def order_fields(d: Dialect) -> dict[str, str]:
    """Document fields of an order, but for its cart."""
    seconds = d.epoch.format("o_orderdate")
    return {
        "_id": f"lpad({_text('o_orderkey')}, 24, '0')",
        "collection": "'checkout_success'",
        "order_id": _text("o_orderkey"),
        "device_id": "CASE WHEN o_orderkey % 2 = 1 THEN ' dev' || o_custkey || ' ' ELSE 'dev' || o_custkey END",
        "user_agent": "o_orderpriority",
        "user_id_db": "CASE WHEN o_orderkey % 7 = 0 THEN 'd' || o_custkey END",
        "email_address": "CASE WHEN o_orderkey % 5 = 0 THEN 'c' || o_custkey || '@example.com' END",
        "store_id": f"CASE WHEN o_custkey % 11 < 10 THEN {_text('o_custkey % 7')} END",
        "current_url": d.pick(HOSTS, "o_custkey % 5"),
        "time_stamp": f"CASE WHEN o_orderkey % 501 = 0 THEN 'n/a' ELSE {_text(f'{seconds} + o_orderkey % 86400')} END",
        "local_time": d.stamp.format("o_orderdate"),
        "ip": f"'10.' || (o_custkey % 32) || '.' || ({_whole('o_custkey / 256.0')} % 256) || '.' || (o_custkey % 256)",
    }


LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    f"{_whole('l_extendedprice / l_quantity * 100')} AS cents",
)


WHOLE = f"{_whole('cents / 100.0')} AS whole"
PRICE_PARTS = (
    f"{_text('whole')} AS whole_text", f"{_text(_whole('whole / 1000.0'))} AS thousands",
    f"lpad({_text('whole % 1000')}, 3, '0') AS rest", f"lpad({_text('cents % 100')}, 2, '0') AS decimals",
)


def lines_sql(columns: tuple[str, ...] = LINE_COLUMNS) -> str:
    """Order lines with their unit price in hundredths, split into the parts a text needs."""
    cents = ", ".join(columns)
    return (
        f"SELECT *, {', '.join(PRICE_PARTS)}"
        f" FROM (SELECT *, {WHOLE} FROM (SELECT {cents} FROM lineitem) AS priced) AS split"
    )


def price_text(number: str = "l_linenumber") -> str:
    """The unit price of a line of :func:`lines_sql` in one of seven number formats."""

    def grouped(sign: str, mark: str) -> str:
        return (
            f"CASE WHEN whole >= 1000 THEN thousands || '{sign}' || rest ELSE whole_text END"
            f" || '{mark}' || decimals"
        )

    return (
        f"CASE {number} % 7 WHEN 0 THEN whole_text || '.' || decimals"
        f" WHEN 1 THEN {grouped(',', '.')}"
        f" WHEN 2 THEN {grouped('.', ',')}"
        f" WHEN 3 THEN whole_text || ',' || decimals"
        f" WHEN 4 THEN {grouped(chr(39) * 2, '.')}"
        f" WHEN 5 THEN {grouped('٬', '٫')}"
        f" ELSE ' ' || whole_text || ',' || decimals || ' ' END"
    )


def currency_text(d: Dialect, shift: int) -> str:
    raw = d.pick(RAW_CURRENCIES, f"(o_custkey + {shift}) % {len(RAW_CURRENCIES)}")
    return f"CASE WHEN o_orderkey % 2 = 1 THEN ' ' || {raw} || ' ' ELSE {raw} END"


def cart_items(d: Dialect) -> list[tuple[str, dict[str, str]]]:
    """Items of the cart of one order line as (condition, fields): the part, and with every
    third line a gift that no product table knows, in another currency."""
    part = {
        "product_id": _text("l_partkey"),
        "currency": currency_text(d, 0),
        "amount": _text("CAST(l_quantity AS BIGINT)"),
        "price": price_text(),
    }
    gift = {
        "product_id": "'gift-' || l_suppkey",
        "currency": currency_text(d, 1),
        "amount": "'1'",
        "price": "(l_suppkey % 90 + 10) || ',50'",
    }
    return [("l_orderkey IS NOT NULL", part), ("l_linenumber % 3 = 0", gift)]


def event_fields(d: Dialect) -> dict[str, str]:
    """Document fields of a browsing event."""
    seconds = d.epoch.format("ts")
    stamp = d.stamp.format("ts")
    k = d.json_k
    return {
        "_id": f"lpad({_text('event_id')}, 24, '0')",
        "collection": "CASE event_type WHEN 'view' THEN 'view_product_detail'"
        " WHEN 'click' THEN 'product_view_all_recommend_clicked' WHEN 'signup' THEN 'add_to_cart_action'"
        " WHEN 'purchase' THEN 'checkout_success' ELSE 'page_error' END",
        "device_id": _text("user_id"),
        "user_agent": "event_type",
        "user_id_db": "CASE WHEN event_id % 7 = 0 THEN 'd' || user_id END",
        "email_address": "CASE WHEN event_id % 5 = 0 THEN 'u' || user_id END",
        "time_stamp": _text(seconds),
        "local_time": f"CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '2020-99-04 10:00:00' WHEN 2 THEN NULL"
        f" WHEN 3 THEN ' ' || replace({stamp}, ' ', 'T') ELSE {stamp} END",
        "product_id": f"CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE ' ' || {k} END",
        "viewing_product_id": f"CASE WHEN event_id % 13 < 12 THEN {_text('user_id % 50')} END",
        "current_url": f"CASE event_id % 4 WHEN 0 THEN 'javascript:x' WHEN 1 THEN ' HTTP://shop.example.com/p/' || {k}"
        f" ELSE 'https://shop.example.com/p/' || {k} || '?v=' || (user_id % 7) END",
        "referrer_url": "CASE WHEN event_id % 3 < 2 THEN 'https://shop.example.com/list/' || (event_id % 11) END",
        "ip": f"CASE event_id % 6 WHEN 0 THEN 'bad' WHEN 1 THEN NULL WHEN 2 THEN '010.1.1.' || {k}"
        f" WHEN 3 THEN ' 10.' || (user_id % 32) || '.0.' || {k} || ' ' WHEN 4 THEN '2001:0DB8::1:' || {k}"
        f" ELSE '10.' || (user_id % 32) || '.0.' || {k} END",
    }


def range_fields() -> dict[str, str]:
    """IP range of a nation: 10.n.0.0 to 10.n.255.255, some without a usable country or city."""
    return {
        "ip_from": "CAST(167772160 + n_nationkey * 65536 AS BIGINT)",
        "ip_to": "CAST(167772160 + n_nationkey * 65536 + 65535 AS BIGINT)",
        "city_name": "CASE WHEN n_regionkey = 3 THEN '-' ELSE ' City ' || n_nationkey END",
        "region_name": "r_name",
        "country_code": "CASE n_nationkey WHEN 7 THEN 'N/A' WHEN 8 THEN 'A1' ELSE substr('ABCDEFGHIJKLMNOPQRSTUVWXY', n_nationkey + 1, 1) || substr('VWXYZ', n_regionkey + 1, 1) END",
        "country_name": "n_name",
        "latitude": "CASE WHEN n_regionkey = 2 THEN 'n/a' ELSE CAST(n_nationkey AS STRING) || '.5' END",
        "longitude": "CASE WHEN n_regionkey = 1 THEN 'inf' ELSE '-' || n_nationkey || '.25' END",
    }


# Spark frames -------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _columns(fields: dict[str, str]) -> list:
    return [F.expr(text).alias(name) for name, text in fields.items()]


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(lines_sql().replace("FROM lineitem", "FROM {lines}"), lines=table(spark, sf_dir, "lineitem"))


def _price_parts(priced: DataFrame) -> DataFrame:
    """The parts of the unit price that :func:`lines_sql` has, for lines that went through a join."""
    return priced.selectExpr("*", WHOLE).selectExpr("*", *PRICE_PARTS)


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One checkout document per order, without its cart."""
    return table(spark, sf_dir, "orders").select(*_columns(order_fields(SPARK)))


def _cart(items: list[tuple[str, dict[str, str]]], chosen: tuple[Column, ...] = ()) -> Column:
    """The array of the items whose condition holds, as nested choices of whole arrays: generated code has
    these, but not a filter of an array."""
    if not items:
        return F.array(*chosen)
    (condition, fields), *others = items
    item = F.struct(*_columns(fields))
    return F.when(F.expr(condition), _cart(others, (*chosen, item))).otherwise(_cart(others, chosen))


# A landed file holds one stretch of time with about so many documents, and there are no more of these.
FILE_DOCUMENTS = 250_000
MOST_FILES = 512


def _by_time(joined: DataFrame, orders: DataFrame, documents: int) -> DataFrame:
    """The rows of documents to be, in one partition for each stretch of time and one for those without a time."""
    wanted = min(MOST_FILES, -(-documents // FILE_DOCUMENTS))
    if wanted < 2:
        return joined
    seconds = F.expr(order_fields(SPARK)["time_stamp"]).try_cast("bigint")
    shares = [i / wanted for i in range(1, wanted)]
    cuts = sorted(set(orders.agg(F.percentile_approx(seconds, shares).alias("cuts")).first()["cuts"] or ()))
    # The place among the cuts; numbers alone are compared, so one look at the time is enough.
    at = F.coalesce(seconds, F.lit(-(1 << 62)))
    number = reduce(lambda a, b: a + b, [(at >= cut).cast("int") for cut in [-(1 << 61), *cuts]])
    return joined.repartitionById(len(cuts) + 2, number)


def checkout_events(spark: SparkSession, sf_dir: str, by_time: bool = False) -> DataFrame:
    """One checkout document per order line (or per order without lines, with a NULL cart).

    A document per line keeps carts small however many lines an order has; grouping by order
    happens in the jobs, after pre-aggregation.  ``by_time`` brings many documents into partitions
    of neighbouring times, as they land day by day.
    """
    lines = table(spark, sf_dir, "lineitem").selectExpr(*LINE_COLUMNS)
    cart = F.when(F.col("l_orderkey").isNotNull(), _cart(cart_items(SPARK)))
    # Numbers go through the join; the texts that are made of them come after it.
    orders = table(spark, sf_dir, "orders")
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if by_time:
        joined = _by_time(joined, orders, lines.count())
    return _price_parts(joined).select(*_columns(order_fields(SPARK)), cart.alias("cart_products"))


def browsing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(*_columns(event_fields(SPARK)))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(*_columns(range_fields()))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS product_id",
        "' ' || p_name AS name",
        "CASE WHEN p_size > 5 THEN p_brand END AS sku",
        "CASE WHEN p_size % 2 = 0 THEN 'women' END AS gender",
        "CAST(p_retailprice AS DECIMAL(12,2)) AS price",
        "CAST(p_retailprice AS DECIMAL(12,2)) - 1 AS min_price",
        "CASE WHEN p_size < 40 THEN CAST(p_retailprice AS DECIMAL(12,2)) + p_size END AS max_price",
    )


def rate_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes per business day of an order: one early, one corrected, for every currency but USD."""
    codes = sorted({code for _, code, _ in CURRENCY_MAPPING} - {"USD"})
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(code).alias("quote")) for i, code in enumerate(codes)])
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return (
        days.where(F.dayofweek("day").between(2, 6))
        .select("day", F.explode(listed).alias("c"))
        .select("day", "c.i", "c.quote")
        .select("day", "i", "quote", F.explode(F.array(F.lit(0), F.lit(1))).alias("seq"))
        .select(
            F.date_format("day", "yyyy-MM-dd").alias("date"),
            "quote",
            (1 + ((F.col("i") * 13 + F.dayofyear("day")) % 50 + F.col("seq")) / F.lit(100.0)).alias("rate"),
            "seq",
        )
    )
