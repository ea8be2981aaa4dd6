"""Builds the star schema as Parquet tables, in dependency order."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY
from ..operators.increment import increment_table, write_parts
from ..operators.lookup import with_audit, with_comments
from ..operators.rates import rates_to_base
from ..session import DENSE_PAGES, shuffles_freed
from . import dims, marts, sales

COMMENTS = {
    "customer_key": "Key of one version of a customer; -1 is the unknown customer.",
    "product_key": "Key of a product; -1 is the unknown product.",
    "location_key": "Key of a place; -1 is the unknown place.",
    "currency_key": "Key of a currency; -1 is the unknown currency.",
    "store_key": "Key of a store; -1 is the unknown store.",
    "date_key": "Calendar day; 1970-01-01 is the unknown day.",
    "detail_key": "Key of an order line.",
    "start_time": "First moment (UTC) at which the version holds.",
    "end_time": "First moment (UTC) at which the version no longer holds.",
    "is_current": "Whether the version is the latest of its customer.",
    "rate_to_usd": "Price of one unit of the currency in USD on that day.",
    "sales_amount": "Units of the product in the order.",
    "sales_local_price": "Unit price in the currency of the order.",
    "sales_usd_price": "Unit price in USD by the rate of the day; empty without a rate.",
}


class Warehouse:
    """Tables below ``root``; each is written once its inputs are and read back from Parquet.

    Written dimensions have a known size, so Spark broadcasts those that are small and shuffles
    the others, and no plan recomputes its inputs.
    """

    def __init__(self, spark: SparkSession, root: str, today: date | None = None):
        self.spark, self.root, self.today = spark, root, today

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def view(self, name: str) -> None:
        self.table(name).createOrReplaceTempView(name)

    def save(self, name: str, df: DataFrame, audit: bool = True) -> DataFrame:
        """Full rebuild of a table with audit columns and column descriptions."""
        full = with_audit(df, today=self.today) if audit else df
        with_comments(full, COMMENTS).write.mode("overwrite").options(**DENSE_PAGES).parquet(self.path(name))
        return self.table(name)

    def increment(
        self, name: str, parts: list[DataFrame], keys: list[str], mark: str, lateness: str = "drop", refresh: bool = False
    ) -> DataFrame:
        full = [with_comments(with_audit(part, today=self.today), COMMENTS) for part in parts]
        if refresh:
            write_parts(full, self.path(name), "overwrite")
            return self.table(name)
        return increment_table(self.spark, self.path(name), full, keys, mark, lateness=lateness)

    def together(self, *jobs: Callable[[], DataFrame]) -> list[DataFrame]:
        """Run independent jobs at the same time; the cluster's scheduler shares its cores."""
        with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
            return list(pool.map(lambda job: job(), jobs))

    def build(
        self, events: DataFrame, raw_location: DataFrame, raw_product: DataFrame, landed_rates: DataFrame,
        mapping: DataFrame, lateness: str = "drop", refresh: bool = False,
    ) -> "Warehouse":
        """Rebuild the dimensions, extend both facts, rebuild the marts.

        ``lateness`` is the rule for order lines that are not newer than the fact; ``refresh``
        builds the facts anew, as after a change of the mapping or of old rates.
        """
        with shuffles_freed(self.spark):
            return self._build(events, raw_location, raw_product, landed_rates, mapping, lateness, refresh)

    def _build(
        self, events: DataFrame, raw_location: DataFrame, raw_product: DataFrame, landed_rates: DataFrame,
        mapping: DataFrame, lateness: str, refresh: bool,
    ) -> "Warehouse":
        made = self.together(
            lambda: self.save("dim_customer", dims.dim_customer(events)),
            lambda: self.save("dim_date", dims.dim_date(events, self.today)),
            lambda: self.save("dim_currency", dims.dim_currency(events, mapping)),
            lambda: self.save("dim_store", dims.dim_store(events)),
            lambda: self.save("dim_product", dims.dim_product(raw_product)),
            lambda: self.save("stg_location", dims.located_ips(raw_location), audit=False),
        )
        customer, calendar, currency, store, product, ips = made

        known_currency = currency.where(F.col("currency_key") != UNKNOWN_KEY)
        known_day = calendar.where(F.col("date_key") != F.lit(dims.UNKNOWN_DATE))
        location, rates = self.together(
            lambda: self.save("dim_location", dims.dim_location(ips)),
            lambda: self.increment(
                "fact_exchange_rate", [rates_to_base(landed_rates, known_currency, known_day)],
                ["date_key", "currency_key"], "date_key", refresh=refresh,
            ),
        )

        def fact_of(within: DataFrame, stretch: sales.Stretch, timed: bool | None) -> DataFrame:
            return sales.sales_fact(
                sales.order_lines(within, near_ips, together=sales.FACT_TOGETHER), visits=sales.checkout_visits(within),
                customer=sales.versions_in(customer, stretch), product=product, location=location,
                currency=currency, store=store, calendar=calendar, mapping=mapping, rates=rates,
                sold=sales.sold_products(within) if timed else None,
            ).sortWithinPartitions("time_stamp", "order_id")

        near_ips = sales.small_side(ips)
        stretches = sales.time_slices(events)
        files = dict(zip(stretches, sales.files_of(events, stretches) or ())) if len(stretches) > 1 else {}
        many = product.count() >= sales.MANY_PRODUCTS
        taken = sales.untimed_apart(stretches) if many else [(stretch, None) for stretch in stretches]
        parts = []
        for stretch, timed in taken:
            within = sales.events_in(events, stretch, timed, files.get(stretch))
            if within is not None:
                parts.append(fact_of(within, stretch, timed))
        self.increment(
            "fact_sales_order_detail",
            parts,
            ["order_id", "product_key", "time_stamp"],
            "time_stamp",
            lateness,
            refresh,
        )
        # One after the other: each adds up the whole fact per order in a shuffle.
        for name, mart in self.mart_queries().items():
            self.save(name, mart(), audit=False)
        return self

    def mart_queries(self) -> dict[str, Callable[[], DataFrame]]:
        fact = self.table("fact_sales_order_detail")
        return {
            "revenue_by_country": lambda: marts.revenue_by_country(fact, self.table("dim_location")),
            "revenue_order_by_week": lambda: marts.revenue_by_weekday(fact, self.table("dim_date")),
            "order_by_product": lambda: marts.units_by_product(fact, self.table("dim_product")),
            "revenue_mom_analysis": lambda: marts.revenue_month_over_month(fact, self.table("dim_date")),
            "revenue_aov_customer_analysis": lambda: marts.order_value_summary(fact),
        }
