"""IP addresses → places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ip import canonical_v4, canonical_v6, ip_order_key, ipv4_number
from ..functions.text import trim_ws
from ..session import cut_lineage
from .ip_ranges import flatten, narrowest

PLACE = ("city_name", "region_name", "country_code", "country_name", "latitude", "longitude")
# Texts that mean "no value" in the range table.
NO_VALUE = ("", "-", "N/A")


def _text(c: Column) -> Column:
    text = trim_ws(c.cast("string"))
    return F.when(~text.isin(*NO_VALUE), text)


def _coordinate(c: Column) -> Column:
    number = c.cast("string").try_cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    return F.when(finite, number)


def clean_place(record: dict[str, Column]) -> dict[str, Column]:
    """Place fields of a raw range record; all are NULL unless the country is two letters."""
    code = _text(record["country_code"])
    known = F.coalesce(code.rlike(r"^\p{L}{2}$"), F.lit(False))
    cleaned = {
        name: _coordinate(record[name]) if name in ("latitude", "longitude") else _text(record[name])
        for name in PLACE
    }
    return {name: F.when(known, value) for name, value in cleaned.items()}


def distinct_ips(events: DataFrame, column: str = "ip") -> DataFrame:
    return events.select(F.col(column).alias("ip")).distinct()


def _by_version(raw_ips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts without a colon, which stay inside the JVM, and those with one."""
    colon = F.coalesce(F.col("ip").contains(":"), F.lit(False))
    return raw_ips.where(~colon), raw_ips.where(colon)


def ip_scan_statistics(raw_ips: DataFrame) -> DataFrame:
    """Counts over distinct raw values: valid, invalid, and values that became equal."""
    v4, v6 = _by_version(raw_ips)
    normal = v4.select(canonical_v4(F.col("ip")).alias("normal")).unionByName(v6.select(canonical_v6(F.col("ip")).alias("normal")))
    # One row per normal form first, so that the final aggregate has no distinct to expand.
    forms = normal.groupBy("normal").agg(F.count("*").alias("values"))
    valid = F.col("normal").isNotNull()
    return forms.agg(
        F.coalesce(F.sum("values"), F.lit(0)).alias("mongo_unique"),
        F.count_if(valid).alias("valid_unique"),
        F.coalesce(F.sum(F.when(~valid, F.col("values"))), F.lit(0)).alias("invalid"),
        F.coalesce(F.sum(F.when(valid, F.col("values") - 1)), F.lit(0)).alias("normalized_duplicates"),
    )


# Set where an address lies in a range whose record gives no usable place.
LOOKUP_ERROR = "lookup_error"


def _find(ips: DataFrame, ranges: DataFrame, key: Column, low: Column, high: Column, digits: int) -> DataFrame:
    """Each ip with the place of the narrowest range that covers it."""
    raw = {name: F.col(name) for name in PLACE}
    known = F.coalesce(_text(raw["country_code"]).rlike(r"^\p{L}{2}$"), F.lit(False))
    cleaned = ranges.select(
        low.alias("low"), high.alias("high"), *[value.alias(name) for name, value in clean_place(raw).items()],
        (~known).alias(LOOKUP_ERROR),
    )
    found = [*PLACE, LOOKUP_ERROR]
    points = ips.select("ip", key.alias("key"))
    return narrowest(points, "key", digits, flatten(cleaned, found), found).drop("key").withColumn(
        LOOKUP_ERROR, F.coalesce(LOOKUP_ERROR, F.lit(False))
    )


def _hex8(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number.cast("bigint")), 8, "0"))


def locate_v4(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """Place of each distinct IPv4 address, and whether its record was of no use."""
    return _find(ips, ranges, _hex8(ipv4_number(F.col("ip"))), _hex8(F.col("ip_from")), _hex8(F.col("ip_to")), 8)


def locate_v6(ips: DataFrame, ranges: DataFrame | None, like: DataFrame) -> DataFrame:
    """The same for each distinct canonical IPv6 address, with the columns of ``like``."""
    if ranges is None:
        return ips.select(
            "ip", *[F.lit(None).cast(like.schema[n].dataType).alias(n) for n in PLACE], F.lit(False).alias(LOOKUP_ERROR)
        )
    return _find(
        ips, ranges, ip_order_key(F.col("ip")), ip_order_key(canonical_v6(F.col("ip_from"))),
        ip_order_key(canonical_v6(F.col("ip_to"))), 32,
    )


def _reported(located: DataFrame, errors: bool) -> DataFrame:
    return located if errors else located.drop(LOOKUP_ERROR)


def locate_ips(
    ips: DataFrame, ranges_v4: DataFrame, ranges_v6: DataFrame | None = None, errors: bool = False
) -> DataFrame:
    """Place of each distinct canonical ip; addresses outside all ranges keep NULL fields.

    Ranges are ``ip_from .. ip_to`` (inclusive) with raw place fields: numbers for IPv4, address text
    for IPv6.  Where ranges contain or overlap each other the narrowest one holds, of equally wide ones
    the later.  ``errors`` adds ``lookup_error``: the record of that range gives no usable place.
    """
    v4, v6 = _by_version(ips)
    located = locate_v4(v4, ranges_v4)
    return _reported(located.unionByName(locate_v6(v6, ranges_v6, located)), errors)


def ip_locations(
    events: DataFrame, ranges_v4: DataFrame, ranges_v6: DataFrame | None = None, column: str = "ip", errors: bool = False
) -> DataFrame:
    """Location rows for the distinct valid addresses of an event table.

    The events are read once, for their distinct texts; only those with a colon meet Python.
    """
    v4, v6 = _by_version(cut_lineage(distinct_ips(events, column)))

    def valid(texts: DataFrame, canonical: Column) -> DataFrame:
        return texts.select(canonical.alias("ip")).where(F.col("ip").isNotNull()).distinct()

    located = locate_v4(valid(v4, canonical_v4(F.col("ip"))), ranges_v4)
    return _reported(
        located.unionByName(locate_v6(valid(v6, canonical_v6(F.col("ip"))), ranges_v6, located)), errors
    )


def location_statistics(raw_ips: DataFrame, locations: DataFrame) -> DataFrame:
    """Scan counts, rows written, and how many of these have a record of no use.

    ``locations`` is :func:`ip_locations` with ``errors``.  Such addresses are written with an empty place.
    """
    return ip_scan_statistics(raw_ips).select(
        "*",
        locations.agg(F.count("*")).scalar().alias("written"),
        locations.agg(F.count_if(LOOKUP_ERROR)).scalar().alias("lookup_errors"),
    )
