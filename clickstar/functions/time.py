"""Epoch seconds, local dates, calendar fields and zone-aware "today"."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import trim_quick, trim_ws

# First and last second of the years 1 to 9999, and the warehouse's zone.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799
WAREHOUSE_ZONE = "Asia/Saigon"
# A day and, if there is one, a time with or without an offset.
DAY_AND_TIME = (
    r"^([0-9][0-9W-]{6,9})(?:[T ][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2}(?:[.,][0-9]+)?)?)?"
    r" ?(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?$"
)


def epoch_seconds(c: Column) -> Column:
    """Whole number in any type or text form, NULL if it is none."""
    return trim_quick(c.cast("string")).try_cast("bigint")


def parse_epoch(c: Column) -> Column:
    """Epoch seconds in any type or text form → timestamp, NULL if not such a number."""
    seconds = epoch_seconds(c)
    # Unlike those of between(), both sides are always evaluated, so generated code reads the text once.
    inside = F.least(seconds, F.lit(LAST_SECOND)) == F.greatest(seconds, F.lit(FIRST_SECOND))
    return F.when(inside, F.timestamp_seconds(seconds))


def local_date(c: Column, data_type: T.DataType = T.StringType()) -> Column:
    """Calendar day of a local time; text counts if it is an ISO day, alone or with an ISO time.

    ISO days may also be compact (``20200604``) or week dates (``2020-W23-4``).
    """
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    if not isinstance(data_type, T.StringType):
        return F.lit(None).cast("date")
    head = F.regexp_extract(trim_ws(c), DAY_AND_TIME, 1)
    week_form = r"^(\d{4})(?:-W(\d\d)(?:-([1-7]))?|W(\d\d)([1-7])?)$"
    year = F.regexp_extract(head, week_form, 1).try_cast("int")
    week = F.concat(F.regexp_extract(head, week_form, 2), F.regexp_extract(head, week_form, 4)).try_cast("int")
    day = F.coalesce(
        F.concat(F.regexp_extract(head, week_form, 3), F.regexp_extract(head, week_form, 5)).try_cast("int"),
        F.lit(1),
    )
    january_4 = F.make_date(F.when(year > 0, year), F.lit(1), F.lit(4))
    monday = F.date_sub(january_4, F.weekday(january_4))
    week_date = F.date_add(monday, (week - 1) * 7 + day - 1)
    valid_week = (week >= 1) & (F.weekofyear(F.date_add(monday, (week - 1) * 7)) == week)
    return (
        F.when(F.startswith(head, F.lit("0000")), None)
        .when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), head.try_cast("date"))
        .when(head.rlike(r"^\d{8}$"),
              F.regexp_replace(head, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").try_cast("date"))
        .when(head.rlike(week_form) & valid_week & (F.year(week_date) <= 9999), week_date)
    )


def today_in(zone: str = WAREHOUSE_ZONE, today: date | None = None) -> Column:
    """The current day in a zone; jobs pass ``today`` to make a run repeatable."""
    if today is not None:
        return F.lit(today)
    return day_in(F.current_timestamp(), zone)


def day_in(moment: Column, zone: str) -> Column:
    """The calendar day of a moment in a zone."""
    return F.to_date(F.from_utc_timestamp(moment, zone))


def calendar_fields(day: Column) -> dict[str, Column]:
    """Attributes of a calendar day; weeks are ISO weeks and Sunday is day 1."""
    weekday = F.dayofweek(day)
    return {
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter_number": F.quarter(day),
        "year_number": F.year(day),
        "is_weekend": weekday.isin(1, 7),
    }


def iso_micros(ts: Column) -> Column:
    """UTC timestamp text with microseconds, as used inside keys."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
