"""Exchange rates: quotes → one map per day → rates to the base currency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key

BASE = "USD"


def valid_quote(quotes: DataFrame) -> Column:
    """A quote counts if its currency is not empty and its rate is a number, not a boolean."""
    kind = dict(quotes.dtypes)["rate"]
    numeric = kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
    if not numeric:
        return F.lit(False)
    return F.coalesce(F.col("quote") != "", F.lit(False)) & F.col("rate").isNotNull()


def rejected_quotes(quotes: DataFrame) -> DataFrame:
    return quotes.where(~valid_quote(quotes))


def pivot_rates(quotes: DataFrame, order: str, base: str = BASE, strict: bool = True) -> DataFrame:
    """(date, base, rates) with ``rates`` sorted by currency; the last of repeated quotes wins.

    After the first aggregate a day holds one row per currency, so the collected map is small
    whatever the number of quotes.  A rejected quote fails the job and its day is named; without
    ``strict`` only the rejected quotes are left out (:func:`rejected_quotes` has them).
    """
    valid = valid_quote(quotes)
    if strict:
        problem = F.concat(F.lit("rejected exchange rate on "), F.coalesce(F.col("date").cast("string"), F.lit("no day")))
        quotes = quotes.withColumn("quote", F.when(valid, F.col("quote")).otherwise(F.raise_error(problem).cast("string")))
    else:
        quotes = quotes.where(valid)
    last = quotes.groupBy("date", "quote").agg(F.max_by("rate", order).cast("double").alias("rate"))
    return (
        last.groupBy("date")
        .agg(F.array_sort(F.collect_list(F.struct("quote", "rate"))).alias("pairs"))
        .select("date", F.lit(base).alias("base"), F.map_from_entries("pairs").alias("rates"))
    )


def flatten_rates(landed: DataFrame) -> DataFrame:
    """(date_key, currency_code, rate_from_base); the rates may be a map or JSON text."""
    rates = F.col("rates")
    if dict(landed.dtypes)["rates"] == "string":
        rates = F.from_json(rates, "map<string,string>")
    return landed.select(
        F.col("date").cast("string").try_cast("date").alias("date_key"), F.explode(rates).alias("code", "rate")
    ).select(
        "date_key",
        F.upper("code").alias("currency_code"),
        F.col("rate").cast("string").try_cast("double").alias("rate_from_base"),
    )


def rates_to_base(landed: DataFrame, currencies: DataFrame, dates: DataFrame, base: str = BASE) -> DataFrame:
    """Daily rates to the base currency for known currencies and dates, the base itself being 1.

    ``currencies`` has currency_key and currency_code, ``dates`` has date_key.  Currencies and
    calendar days are bounded by the mapping and the calendar, so both are small sides.
    """
    quoted = (
        flatten_rates(landed)
        .where(F.col("rate_from_base").isNotNull())
        .join(currencies.select("currency_code", "currency_key"), "currency_code")
        .join(dates.select("date_key"), "date_key")
        .select("date_key", "currency_key", F.try_divide(F.lit(1.0), F.col("rate_from_base")).alias("rate_to_usd"))
    )
    base_key = currencies.where(F.col("currency_code") == base).agg(F.max("currency_key")).scalar()
    own = dates.select("date_key", base_key.alias("currency_key"), F.lit(1.0).alias("rate_to_usd")).where(
        F.col("currency_key").isNotNull()
    )
    return (
        quoted.unionByName(own)
        .distinct()
        .select(surrogate_key(F.col("date_key"), F.col("currency_key")).alias("exchange_rate_key"), "*")
    )


def convert(facts: DataFrame, rates: DataFrame, price: str, out: str) -> DataFrame:
    """Add the price in the base currency by same-day rate, 2 decimals; NULL without a rate."""
    rate = rates.select("currency_key", "date_key", "rate_to_usd")
    return (
        facts.join(rate, ["currency_key", "date_key"], "left")
        .withColumn(out, F.round(F.col(price).cast("double") * F.col("rate_to_usd"), 2).cast("decimal(38,9)"))
        .drop("rate_to_usd")
    )
