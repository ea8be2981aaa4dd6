"""Golden values of the column functions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstar.functions import ip, price, text, time
from clickstar.functions.keys import load_id, surrogate_key


def test_price_formats(values):
    given_texts = ["2.962,00", "1.234.567,89", "1,094.00", "10,00", "1'234.50", "1٬234٫5", "1,234", "1.234", "", None, " 7 "]
    wanted = ["2962", "1234567.89", "1094", "10", "1234.5", "1234.5", "1.234", "1.234", None, None, "7"]
    got = values(lambda c: price.parse_price(c), given_texts)
    assert got == [None if w is None else Decimal(w) for w in wanted]


def test_price_strict_and_lenient(values):
    assert values(lambda c: price.parse_price(c, strict=False), ["1 234,00"]) == [None]
    assert values(price.bad_price, ["1 234,00", "1,00", ""]) == [True, False, False]
    with pytest.raises(Exception):
        values(lambda c: price.parse_price(c), ["1 234,00"])


def test_mean_keeps_nine_digits(spark):
    df = spark.createDataFrame([(Decimal("1"),), (Decimal("1"),), (Decimal("2"),)], "p decimal(38,9)")
    assert df.agg(price.mean_numeric(F.col("p")).alias("m")).first()["m"] == Decimal("1.333333333")


def test_epoch(values):
    texts = ["1591266086", " 12 ", "1591266086.0", "abc", "", "253402300800", "-62135596800", None]
    got = values(lambda c: time.parse_epoch(c).cast("string"), texts)
    assert got == ["2020-06-04 10:21:26", "1970-01-01 00:00:12", None, None, None, None, "0001-01-01 00:00:00", None]


def test_local_date(values):
    day = date(2020, 6, 4)
    texts = ["2020-06-04 11:21:24", "2020-06-04T11:21:24", " 2020-06-04", "20200604", "2020-W23-4", None, "",
             "2020-99-04 11:21:24", "0000-01-01", "2020-W60-1", "2020-6-4", "2020-06-04garbage", "2020-06-04 noon", "2020-06-0411:21"]
    assert values(time.local_date, texts) == [day] * 5 + [None] * 9
    assert values(time.local_date, ["2020-06-04T11:21:24.5Z", "2020-06-04 11:21+07:00", "20200604T1121"]) == [day] * 3
    assert values(lambda c: time.local_date(c, T.TimestampType()), [datetime(2020, 6, 4, 11)], "timestamp") == [day]
    assert values(lambda c: time.local_date(c, T.LongType()), [20200604], "bigint") == [None]


@settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.from_regex(r"\A\d{4}-?W?\d{2}-?\d{1,2}\Z"), min_size=1, max_size=20))
def test_local_date_agrees_with_iso(values, texts):
    def iso(value):
        try:
            return date.fromisoformat(value.strip())
        except ValueError:
            return None

    assert values(time.local_date, texts) == [iso(t) for t in texts]


def test_domain(values):
    urls = ["https://WWW.x.co.uk:80/a", "http://localhost/", "HTTPS://x.de", "ftp://x.de", "https://x.de", None]
    assert values(text.store_domain, urls) == [".uk", None, None, None, ".de", None]


def test_trim_knows_unicode_blanks(values):
    assert values(text.trim_ws, [" \t a b　\n", "x"]) == ["a b", "x"]
    assert values(text.blank_to_null, [" ", "", " y"]) == [None, None, "y"]


def test_ids(values):
    assert values(lambda c: text.same_id(c, F.lit("85796")), ["85796", "85796.0", " 85796 ", "85796.5"]) == [True, True, True, False]
    assert values(lambda c: text.clean_id(c, T.BooleanType()), [True], "boolean") == [None]
    assert values(lambda c: text.clean_id(c, T.LongType()), [7], "bigint") == ["7"]


def test_urls(values):
    urls = [" HTTP://a/b ", "https://x", "javascript:x", "http:///p", "//x/y", None]
    assert values(text.clean_url, urls) == ["HTTP://a/b", "https://x", None, None, None, None]
    assert values(text.url_quote, ["a b*~/ü"]) == ["a%20b%2A~%2F%C3%BC"]


def test_uri(values):
    got = values(text.split_uri, ["gs://bucket/a/b/", "gs://bucket", "bucket/a"])
    assert [(r["bucket"], r["prefix"]) if r else None for r in got] == [("bucket", "a/b"), ("bucket", ""), None]
    assert values(lambda c: text.relative_name(c, F.lit("a")), ["a/b/c", "ab/c"]) == ["b/c", None]


def test_ip(values):
    ips = [" 8.8.8.8 ", "8.8.8.8", "2001:0db8::1", "bad", None, "256.1.1.1", "01.2.3.4", "::ffff:1.2.3.4", "1.2.3"]
    assert values(ip.canonical_ip, ips) == ["8.8.8.8", "8.8.8.8", "2001:db8::1", None, None, None, None, "::ffff:1.2.3.4", None]
    assert values(ip.ipv4_number, ["0.0.1.2", "255.255.255.255", "x"]) == [258, 2**32 - 1, None]
    assert values(ip.ip_order_key, ["0.0.1.2", "::1"]) == ["0" * 20 + "ffff00000102", "0" * 31 + "1"]


def test_keys(spark):
    row = spark.range(1).select(
        surrogate_key(F.lit("a"), F.lit(1)).alias("k"), surrogate_key(F.lit("a|1")).alias("same"),
        surrogate_key(F.lit("a"), F.lit(None)).alias("none"),
        load_id(F.lit("b"), F.lit("n"), F.lit(1)).alias("one"), load_id(F.lit("b"), F.lit("n"), F.lit(None)).alias("two"),
    ).first()
    assert row["k"] == row["same"] and len(row["k"]) == 32 and row["none"] is None
    assert row["one"] != row["two"] and row["one"].startswith("gcs_load_") and len(row["one"]) == 9 + 64


def test_calendar(spark):
    fields = time.calendar_fields(F.col("d"))
    df = spark.createDataFrame([(date(2021, 1, 3),)], "d date").select(*[c.alias(n) for n, c in fields.items()])
    assert df.first().asDict() == {
        "day_of_week": 1, "day_name": "Sunday", "day_of_month": 3, "day_of_year": 3, "week_of_year": 53,
        "month_number": 1, "month_name": "January", "quarter_number": 1, "year_number": 2021, "is_weekend": True,
    }


def test_mask(values):
    got = values(text.mask_email, ["A@x.de ", "a@x.de", None])
    assert got[0] == got[1] and "@" not in got[0] and got[2] is None
