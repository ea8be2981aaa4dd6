"""Staging and dimension tables of the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY, surrogate_key
from ..functions.price import NUMERIC
from ..functions.text import blank_to_null, store_domain, trim_quick, trim_ws
from ..functions.time import calendar_fields, parse_epoch, today_in
from ..operators.dates import checkouts
from ..operators.lookup import default_nulls, with_unknown_member
from ..operators.scd2 import build_versions, unknown_version, version_dimension

MISSING = "XNA"
UNKNOWN = "Unknown"
UNKNOWN_DATE = date(1970, 1, 1)

CUSTOMER_ATTRIBUTES = ("customer_user_agent", "customer_user_id_db", "customer_email_address")
# The row that knows an e-mail address describes a customer best, then one with a user id.
CUSTOMER_PREFERENCE = tuple(reversed(CUSTOMER_ATTRIBUTES))
PLACE_COLUMNS = (
    "location_city_name", "location_region_name", "location_country_code", "location_country_name",
)


def customer_states(events: DataFrame) -> DataFrame:
    """What each event tells of its device, and when."""
    return events.select(
        *[
            blank_to_null(F.col(name).cast("string")).alias(f"customer_{name}")
            for name in ("device_id", "user_agent", "user_id_db", "email_address")
        ],
        parse_epoch(F.col("time_stamp")).alias("record_time"),
    )


def customer_versions(events: DataFrame) -> DataFrame:
    """SCD2 of devices over all events."""
    return build_versions(
        customer_states(events), "customer_device_id", "record_time", CUSTOMER_ATTRIBUTES, CUSTOMER_PREFERENCE,
        key="customer_key",
    )


def dim_customer(events: DataFrame) -> DataFrame:
    texts = ("customer_device_id", *CUSTOMER_ATTRIBUTES)
    versions = version_dimension(customer_versions(events), texts, missing=MISSING)
    return with_unknown_member(versions, unknown_version("customer_key", texts))


def calendar(events: DataFrame, today: date | None = None) -> DataFrame:
    """Days on which a checkout happened, none of them in the future."""
    days = (
        checkouts(events)
        .select(F.to_date(parse_epoch(F.col("time_stamp"))).alias("date_key"))
        .distinct()
        .where(F.col("date_key") <= today_in(today=today))
    )
    return days.select("date_key", *[c.alias(name) for name, c in calendar_fields(F.col("date_key")).items()])


def dim_date(events: DataFrame, today: date | None = None) -> DataFrame:
    days = calendar(events, today)
    names = ("day_name", "month_name")
    unknown = {
        name: UNKNOWN if name in names else False if name == "is_weekend" else 0 for name in days.columns
    }
    return with_unknown_member(days, {**unknown, "date_key": UNKNOWN_DATE})


def observed_currencies(events: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mapped currencies of the first cart item of every event.

    Distinct texts go into the join, so it is a join of small tables.
    """
    first = F.get("cart_products", F.lit(0))["currency"]
    seen = events.select(trim_quick(first).alias("raw_currency")).distinct()
    return (
        seen.join(mapping, "raw_currency")
        .select("currency_code", "currency_name")
        .distinct()
        .select(surrogate_key(F.col("currency_code")).alias("currency_key"), "*")
    )


def dim_currency(events: DataFrame, mapping: DataFrame) -> DataFrame:
    currencies = default_nulls(
        observed_currencies(events, mapping), {"currency_code": MISSING, "currency_name": MISSING}
    )
    return with_unknown_member(
        currencies, {"currency_key": UNKNOWN_KEY, "currency_code": UNKNOWN, "currency_name": UNKNOWN}
    )


def located_ips(raw_location: DataFrame) -> DataFrame:
    """Distinct (ip, place) rows with a place key; missing texts become ``XNA``."""
    texts = raw_location.select(
        F.coalesce(F.col("ip").cast("string"), F.lit(MISSING)).alias("ip"),
        *[
            F.coalesce(F.col(name.removeprefix("location_")).cast("string"), F.lit(MISSING)).alias(name)
            for name in PLACE_COLUMNS
        ],
    ).distinct()
    city, region, code, _ = PLACE_COLUMNS
    return texts.select(surrogate_key(F.col(city), F.col(region), F.col(code)).alias("location_key"), "*")


def dim_location(ips: DataFrame) -> DataFrame:
    """Distinct places of :func:`located_ips`."""
    places = ips.select("location_key", *PLACE_COLUMNS).distinct()
    return with_unknown_member(
        places, {"location_key": UNKNOWN_KEY, **{name: UNKNOWN for name in PLACE_COLUMNS}}
    )


def dim_product(raw_product: DataFrame) -> DataFrame:
    products = raw_product.select(
        F.col("product_id").cast("string").alias("product_id"),
        trim_ws(F.col("name").cast("string")).alias("product_name"),
        trim_ws(F.col("sku").cast("string")).alias("product_sku"),
        F.col("gender").cast("string").alias("product_gender"),
        F.col("price").cast(NUMERIC).alias("product_base_price"),
        F.col("min_price").cast(NUMERIC).alias("product_min_price"),
        F.col("max_price").cast(NUMERIC).alias("product_max_price"),
    ).distinct()
    texts = ("product_id", "product_name", "product_sku", "product_gender")
    prices = ("product_base_price", "product_min_price", "product_max_price")
    keyed = products.select(surrogate_key(F.col("product_id")).alias("product_key"), "*")
    dim = default_nulls(keyed, {**dict.fromkeys(texts, MISSING), **dict.fromkeys(prices, 0)})
    return with_unknown_member(
        dim, {"product_key": UNKNOWN_KEY, **dict.fromkeys(texts, UNKNOWN), **dict.fromkeys(prices, 0)}
    )


def dim_store(events: DataFrame) -> DataFrame:
    stores = (
        checkouts(events)
        .select(
            F.col("store_id").cast("string").alias("store_id"),
            store_domain(F.col("current_url")).alias("store_domain"),
        )
        .distinct()
    )
    filled = default_nulls(stores, {"store_id": MISSING, "store_domain": MISSING})
    keyed = filled.select(surrogate_key(F.col("store_id"), F.col("store_domain")).alias("store_key"), "*")
    return with_unknown_member(
        keyed, {"store_key": UNKNOWN_KEY, "store_id": UNKNOWN, "store_domain": UNKNOWN}
    )
