"""Order lines and the sales fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ip import canonical_ip
from ..functions.keys import UNKNOWN_KEY, surrogate_key
from ..functions.price import NUMERIC, mean_numeric, parse_price
from ..functions.text import blank_to_null, store_domain, trim_quick
from ..functions.time import FIRST_SECOND, LAST_SECOND, epoch_seconds, parse_epoch
from ..operators.dates import checkouts
from ..operators.lookup import lookup_key
from ..operators.rates import convert
from ..operators.scd2 import asof_lookup
from .dims import MISSING, PLACE_COLUMNS, UNKNOWN_DATE

ORDER_COLUMNS = (
    "order_id", "device_id", "user_agent", "user_id_db", "email_address", "store_id", "store_domain",
    "time_stamp", "ip",
)


# The lookup of the customer and the grain of the fact have the time in common: lines that are shuffled
# by it once stay where they are until they are written.
FACT_TOGETHER = ("time_stamp",)

# A fact is built by stretches of time, so that one stretch is in shuffles at a time.  There are no more
# than these, and none for few documents.
SLICES = 48
SLICE_DOCUMENTS = 2_000_000

# From so many on products are not broadcast at Spark's default of 10 MB, and lines are looked up by
# :func:`sold_products`.
MANY_PRODUCTS = 100_000

# Up to so many addresses are sent to the lines: some ten MB.  Spark's own limit may be lower, and then the
# lines would be shuffled by address and by each of the later keys again.
FEW_ADDRESSES = 200_000

# Microseconds since 1970 from which on a stretch holds, and before which it ends; None: no bound.
Stretch = tuple[int | None, int | None]


def time_slices(events: DataFrame) -> list[Stretch]:
    """Stretches of time with about as many checkouts each, in order; the first also has those without a time."""
    documents = checkouts(events)
    wanted = min(SLICES, -(-documents.count() // SLICE_DOCUMENTS))
    if wanted < 2:
        return [(None, None)]
    at = F.unix_micros(parse_epoch(F.col("time_stamp")))
    shares = [i / wanted for i in range(1, wanted)]
    cuts = sorted(set(documents.agg(F.percentile_approx(at, shares).alias("cuts")).first()["cuts"] or ()))
    return list(zip([None, *cuts], [*cuts, None]))


def untimed_apart(stretches: Sequence[Stretch]) -> list[tuple[Stretch, bool]]:
    """The stretches with whether times are known: one for documents without a time, then those with one."""
    return [(stretches[0], False), *((stretch, True) for stretch in stretches)]


def in_slice(time_stamp: Column, stretch: Stretch, timed: bool | None = None) -> Column:
    """Whether a time as it landed lies in the stretch; ``timed`` asks for known times or for unknown ones alone.

    The text is taken apart once per row: a comparison with both ends would do it twice, so its distance
    from the middle is compared.
    """
    start, until = (None if at is None else -(-at // 1_000_000) for at in stretch)
    seconds = epoch_seconds(time_stamp).cast("double")

    def within(first: int, last: int) -> Column:
        return F.coalesce(F.abs(seconds - (first + last) / 2) <= (last - first) / 2, F.lit(False))

    if timed is False:
        return ~within(FIRST_SECOND, LAST_SECOND)
    if timed is None and start is None:
        return F.lit(True) if until is None else ~within(max(until, FIRST_SECOND), LAST_SECOND)
    first = FIRST_SECOND if start is None else max(start, FIRST_SECOND)
    return within(first, LAST_SECOND if until is None else min(until - 1, LAST_SECOND))


# Where a scan has the name of the file that a row is from; a filter by it keeps other files closed.
FILE = "_metadata.file_path"


def files_of(events: DataFrame, stretches: Sequence[Stretch]) -> list[tuple[set[str], set[str]]] | None:
    """For each stretch the files with checkouts that have such a time, and those with checkouts without a time.

    One scan tells them: a row per file and stretch comes to the driver, which lists the files of a scan
    anyway.  None if the events are not a scan of files.
    """
    hidden = events._jdf.queryExecution().analyzed().metadataOutput()
    if "_metadata" in events.columns or "_metadata" not in [hidden.apply(i).name() for i in range(hidden.size())]:
        return None
    found = checkouts(events).select(F.col(FILE).alias("file"), F.unix_micros(parse_epoch(F.col("time_stamp"))).alias("at"))
    number = reduce(lambda a, b: a + b, [(F.col("at") >= start).cast("int") for start, _ in stretches[1:]], F.lit(0))
    held = found.select("file", F.when(F.col("at").isNull(), -1).otherwise(number).alias("number")).distinct().collect()
    untimed = {r["file"] for r in held if r["number"] < 0}
    return [({r["file"] for r in held if r["number"] == i}, untimed) for i in range(len(stretches))]


def events_in(
    events: DataFrame, stretch: Stretch, timed: bool | None, files: tuple[set[str], set[str]] | None = None
) -> DataFrame | None:
    """Events of :func:`in_slice`, of the ``files`` that hold some; None if none does."""
    if files is not None:
        known, untimed = files
        # The first stretch also has those without a time.
        wanted = untimed if timed is False else known if timed or stretch[0] is not None else known | untimed
        if not wanted:
            return None
        events = events.where(F.col(FILE).isin(sorted(wanted)))
    return events.where(in_slice(F.col("time_stamp"), stretch, timed))


def versions_in(versions: DataFrame, stretch: Stretch) -> DataFrame:
    """Versions that hold at some time of the stretch."""
    start, until = stretch
    if start is not None:
        versions = versions.where(F.col("end_time") > F.timestamp_micros(F.lit(start)))
    if until is not None:
        versions = versions.where(F.col("start_time") < F.timestamp_micros(F.lit(until)))
    return versions


def checkout_documents(events: DataFrame) -> DataFrame:
    """Checkout events with typed columns, the cart still nested."""
    texts = [name for name in ORDER_COLUMNS if name not in ("store_domain", "time_stamp")]
    return checkouts(events).select(
        *[F.col(name).cast("string").alias(name) for name in texts],
        store_domain(F.col("current_url").cast("string")).alias("store_domain"),
        parse_epoch(F.col("time_stamp")).alias("time_stamp"),
        "cart_products",
    )


def cart_lines(events: DataFrame, strict: bool = True, together: Sequence[str] = ()) -> DataFrame:
    """One row per cart item, or one without an item for an empty cart.

    ``strict`` fails on amounts and prices that are no numbers; otherwise they become NULL.
    Documents that share the columns ``together`` come into one partition, the cart still nested.
    """
    item = F.explode_outer("cart_products").alias("item")
    amount = F.col("item.amount")
    documents = checkout_documents(events)
    if together:
        documents = documents.repartition(*together)
    return documents.select(*ORDER_COLUMNS, item).select(
        *ORDER_COLUMNS,
        F.col("item.product_id").cast("string").alias("product_id"),
        trim_quick(F.col("item.currency").cast("string")).alias("raw_currency"),
        (amount.cast("bigint") if strict else amount.try_cast("bigint")).alias("amount"),
        parse_price(F.col("item.price").cast("string"), strict).alias("price"),
    )


def order_lines(
    events: DataFrame, raw_ips: DataFrame, strict: bool = True, canonical: bool = False,
    together: Sequence[str] = ("order_id", "time_stamp"),
) -> DataFrame:
    """Cart items added up per order, product and currency, with the place of the ip.

    ``raw_ips`` is :func:`~.dims.located_ips`.  The cart is aggregated before the join, so the
    join sees each line once.  Places are known by canonical addresses; ``canonical`` also finds
    those of lines whose address is written differently.

    ``together`` are columns of the order by which its documents are shuffled, before their carts are
    unpacked: the documents of an order then travel side by side and compress well, and no later
    grouping that has these columns among its keys moves the lines again.
    """
    lines = cart_lines(events, strict, together).groupBy(*ORDER_COLUMNS, "product_id", "raw_currency").agg(
        F.sum("amount").alias("amount"), mean_numeric(F.col("price")).alias("price")
    )
    ips = raw_ips.select(F.col("ip").alias("located_ip"), *PLACE_COLUMNS)
    wanted = F.coalesce(canonical_ip(F.col("ip")), F.col("ip")) if canonical else F.col("ip")
    located = lines.withColumn("wanted_ip", wanted).join(
        ips, F.col("wanted_ip") == F.col("located_ip"), "left"
    ).drop("wanted_ip", "located_ip")
    return located.withColumns({name: F.coalesce(name, F.lit(MISSING)) for name in PLACE_COLUMNS})


def small_side(ips: DataFrame) -> DataFrame:
    """Written addresses, to be sent to the lines if they are few; their count comes from the footers."""
    return F.broadcast(ips) if ips.count() <= FEW_ADDRESSES else ips


def checkout_visits(events: DataFrame) -> DataFrame:
    """Device and time of the checkouts: all that the customer lookup needs to know of them."""
    return checkouts(events).select(
        blank_to_null(F.col("device_id").cast("string")).alias("device"),
        parse_epoch(F.col("time_stamp")).alias("time_stamp"),
    )


def sold_products(events: DataFrame) -> DataFrame:
    """Time and product of the cart items of the checkouts: all that the product lookup needs to know of them."""
    return checkouts(events).select(
        parse_epoch(F.col("time_stamp")).alias("time_stamp"),
        F.explode("cart_products.product_id").alias("product_id"),
    ).withColumn("product_id", F.col("product_id").cast("string"))


def lookup_sold(lines: DataFrame, product: DataFrame, sold: DataFrame) -> DataFrame:
    """:func:`lookup_key` of the product for lines that have a time and lie together by it.

    The distinct pairs (time, product) of ``sold`` go to the products and come back with the key; the
    lines, which are many times as wide, stay where they are.
    """
    pairs = sold.where(F.col("time_stamp").isNotNull() & F.col("product_id").isNotNull()).distinct()
    # Brought together like the lines, or Spark might bring the lines together like these.
    keys = pairs.join(product.select("product_id", "product_key"), "product_id").repartition(*FACT_TOGETHER)
    return lines.join(keys, ["time_stamp", "product_id"], "left")


def sales_fact(
    lines: DataFrame,
    *,
    visits: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    location: DataFrame,
    currency: DataFrame,
    store: DataFrame,
    calendar: DataFrame,
    mapping: DataFrame,
    rates: DataFrame,
    sold: DataFrame | None = None,
) -> DataFrame:
    """Order lines with dimension keys and the price in the base currency.

    ``visits`` is :func:`checkout_visits` of the events that the lines come from.  Lines are
    grouped while missing keys are still NULL, so all unknown products of an order
    form one line; prices are averaged without weights.  ``sold`` is :func:`sold_products` of the same
    events, for products so many that their lookup would move the lines; all lines then must have a time.
    """
    codes = mapping.select("raw_currency", "currency_code").join(
        currency.select("currency_code", "currency_key"), "currency_code", "left"
    )
    keyed = lines.withColumns(
        {"device": blank_to_null(F.col("device_id")), "day": F.to_date("time_stamp")}
    )
    keyed = lookup_key(keyed, location, PLACE_COLUMNS, "location_key")
    # Names of currencies, of which there are few; Spark takes the size of this join for a product.
    keyed = lookup_key(keyed, F.broadcast(codes), ["raw_currency"], "currency_key")
    keyed = lookup_key(keyed, store, ["store_id", "store_domain"], "store_key")
    keyed = lookup_key(keyed, calendar, {"day": "date_key"}, "date_key")
    versions = customer.where(F.col("customer_key") != UNKNOWN_KEY)
    keyed = asof_lookup(
        keyed, versions, on=("device", "customer_device_id"), ts="time_stamp", key="customer_key", points=visits
    )

    keys = ["customer_key", "product_key", "location_key", "currency_key", "store_key"]
    grain = [*keys, "order_id", "date_key", "time_stamp", "ip"]
    # Products may be too many to broadcast: by then a line has its keys alone.
    narrow = keyed.select(*[name for name in grain if name != "product_key"], "product_id", "amount", "price")
    if sold is None:
        keyed = lookup_key(narrow, product, ["product_id"], "product_key")
    else:
        keyed = lookup_sold(narrow, product, sold)
    grouped = keyed.groupBy(*grain).agg(
        F.sum("amount").alias("sales_amount"), mean_numeric(F.col("price")).alias("sales_local_price")
    )
    # Days times currencies, of which there are few whatever the lines are.
    priced = convert(grouped, F.broadcast(rates), "sales_local_price", "sales_usd_price")
    filled = priced.select(
        *[F.coalesce(name, F.lit(UNKNOWN_KEY)).alias(name) for name in keys],
        F.coalesce("date_key", F.lit(UNKNOWN_DATE)).alias("date_key"),
        "order_id",
        "time_stamp",
        "ip",
        "sales_amount",
        F.col("sales_local_price").cast(NUMERIC).alias("sales_local_price"),
        F.col("sales_usd_price").cast(NUMERIC).alias("sales_usd_price"),
    )
    detail = surrogate_key(
        F.col("order_id"), F.col("product_key"), F.date_format("time_stamp", "yyyy-MM-dd HH:mm:ss")
    )
    return filled.select(detail.alias("detail_key"), "*")
