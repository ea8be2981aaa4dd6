"""IP addresses: canonical text and sortable numbers."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import trim_ws

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


@F.pandas_udf(T.StringType())
def _canonical_v6(texts: pd.Series) -> pd.Series:
    def canonical(text: str | None) -> str | None:
        try:
            return str(ipaddress.IPv6Address(text)) if text else None
        except ValueError:
            return None

    return texts.map(canonical, na_action="ignore")


@F.pandas_udf(T.StringType())
def _v6_hex(texts: pd.Series) -> pd.Series:
    def digits(text: str | None) -> str | None:
        return f"{int(ipaddress.IPv6Address(text.partition('%')[0])):032x}" if text else None

    return texts.map(digits, na_action="ignore")


def canonical_ip(c: Column) -> Column:
    """Canonical text of an IPv4 or IPv6 address, NULL if it is neither.

    Spark calls a Python function in a condition for every row; jobs over many rows split them by
    :func:`canonical_v4` and :func:`canonical_v6`.
    """
    text = trim_ws(c)
    return F.when(text.rlike(IPV4), text).otherwise(canonical_v6(c))


def canonical_v4(c: Column) -> Column:
    """Valid IPv4 text, NULL for any other; inside the JVM."""
    text = trim_ws(c)
    return F.when(text.rlike(IPV4), text)


def canonical_v6(c: Column) -> Column:
    text = trim_ws(c)
    return _canonical_v6(F.when(text.contains(":"), text))


def ipv4_number(c: Column) -> Column:
    """Dotted IPv4 → its 32-bit number, NULL for any other text."""
    octets = F.split(F.when(c.rlike(IPV4), c), r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + F.get(octets, F.lit(i)).cast("bigint")
    return number


def ip_order_key(c: Column) -> Column:
    """32 hex digits that sort like the address (IPv4 as its IPv4-mapped IPv6 form).

    Takes canonical text.
    """
    v4 = F.concat(F.lit("0" * 20 + "ffff"), F.lower(F.lpad(F.hex(ipv4_number(c)), 8, "0")))
    return F.coalesce(v4, _v6_hex(F.when(c.contains(":"), c)))
