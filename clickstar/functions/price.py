"""Prices written in local number formats → DECIMAL(38, 9)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import trim_quick

NUMERIC = "decimal(38,9)"


@dataclass(frozen=True)
class NumberFormat:
    """Digits grouped by ``group`` with ``mark`` before the decimals."""

    pattern: str
    group: str
    mark: str


# The number formats told apart, first match first.  A single comma is always
# a decimal mark, so "1,234" is 1.234.
FORMATS = (
    NumberFormat(r"^\d{1,3}(\.\d{3})+,\d+$", group=".", mark=","),
    NumberFormat(r"^\d{1,3}(,\d{3})+\.\d+$", group=",", mark="."),
    NumberFormat(r"^\d+,\d+$", group="", mark=","),
)
# Swiss and Arabic thousands signs are dropped, the Arabic decimal sign is a point.
THOUSANDS_SIGNS = "'٬"
DECIMAL_SIGN = "٫"


def plain_number(c: Column) -> Column:
    """Price text → the same number with only a decimal point; NULL for blanks."""
    # translate() maps the first character to the point and drops the others in one pass.
    text = F.translate(trim_quick(c), DECIMAL_SIGN + THOUSANDS_SIGNS, ".")
    result = F.when(text == "", None)
    for form in FORMATS:
        # A text without the signs of a format needs no look at its pattern.
        signs = reduce(lambda a, b: a & b, [text.contains(sign) for sign in form.mark + form.group])
        result = result.when(signs & text.rlike(form.pattern), F.translate(text, form.mark + form.group, "."))
    return result.otherwise(text)


def parse_price(c: Column, strict: bool = True) -> Column:
    """Price as NUMERIC; ``strict`` fails on other text, else it becomes NULL."""
    number = plain_number(c)
    return number.cast(NUMERIC) if strict else number.try_cast(NUMERIC)


def bad_price(c: Column) -> Column:
    """True for price text that ``strict`` parsing would fail on."""
    number = plain_number(c)
    return number.isNotNull() & number.try_cast(NUMERIC).isNull()


def mean_numeric(price: Column) -> Column:
    """Average of a NUMERIC column, itself NUMERIC.

    Spark takes four more digits for an average; narrowing the input first keeps scale 9.
    """
    return F.avg(price.cast("decimal(28,9)")).cast(NUMERIC)
