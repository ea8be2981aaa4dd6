"""A star schema that grows by batches at the cost of what is new.

Events land in folders of their day.  A ledger knows which days a batch has touched and which batches
the fact has taken in.  The fact is kept by day as well: a load reads the landed events of the touched
days, looks their keys up in the versions that hold then, and replaces these days alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY
from ..functions.time import parse_epoch
from ..operators.increment import after_mark, high_water_mark
from ..operators.lookup import with_audit, with_comments, with_unknown_member
from ..operators.rates import rates_to_base
from ..operators.scd2 import unknown_version, version_dimension
from ..operators.version_store import VersionStore, one_of
from ..session import path_exists, shuffles_freed, table_exists
from . import dims, sales
from .warehouse import COMMENTS

DAY = "event_day"


class DailyWarehouse:
    """Landing, ledger, dimensions and the sales fact below ``root``.

    Batches have names that serve as folder names.  Every step of a batch replaces what it wrote
    before, so a broken load is simply run again.  ``grain`` is what a folder of events holds: a day,
    or a week, month or year, named by its first day, where days have too few events for a file.
    """

    def __init__(self, spark: SparkSession, root: str, today: date | None = None, grain: str = "day"):
        if grain not in ("day", "week", "month", "year"):
            raise ValueError(f"unknown grain {grain!r}")
        self.spark, self.root, self.today, self.grain = spark, root.rstrip("/"), today, grain
        self.customers = VersionStore(
            spark, f"{self.root}/customers", "customer_device_id", dims.CUSTOMER_ATTRIBUTES, dims.CUSTOMER_PREFERENCE,
            key="customer_key",
        )

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def _day(self, at: Column) -> Column:
        day = F.to_date(at)
        return day if self.grain == "day" else F.trunc(day, self.grain)

    # Landing and ledger -------------------------------------------------------------------------

    def land(self, events: DataFrame, batch: str) -> None:
        """Write a batch by event day and enter its days in the ledger.

        Events without a readable time have a folder of their own.
        """
        days = events.withColumn(DAY, self._day(parse_epoch(F.col("time_stamp"))))
        path = f"{self._path('landing')}/batch={batch}"
        with shuffles_freed(self.spark):
            days.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(path)
        # Counts come from the footers of the files just written.
        counts = self.spark.read.schema(days.schema).parquet(path).groupBy(DAY).agg(F.count(F.lit(1)).alias("documents"))
        counts.write.mode("overwrite").parquet(f"{self._path('ledger')}/batch={batch}")

    def _batches(self, name: str) -> DataFrame:
        if not path_exists(self.spark, self._path(name)):
            return self.spark.createDataFrame([], "batch string")
        return self.table(name).select(F.col("batch").cast("string").alias("batch")).distinct()

    def open_batches(self) -> list[str]:
        """Landed batches that the fact has not taken in; a run leaves few of them."""
        waiting = self._batches("ledger").join(self._batches("loaded"), "batch", "left_anti")
        return sorted(r["batch"] for r in waiting.collect())

    def landed(self, days: Sequence[date | None] | None = None, batches: Sequence[str] | None = None) -> DataFrame:
        """Landed events; ``days`` and ``batches`` name the folders that are opened."""
        events = self.table("landing")
        if days is not None:
            events = events.where(one_of(DAY, days))
        return events if batches is None else events.where(F.col("batch").cast("string").isin(list(batches)))

    # Dimensions ---------------------------------------------------------------------------------

    def extend(self, name: str, rows: DataFrame, key: Sequence[str]) -> DataFrame:
        """Append the rows whose key the dimension does not have."""
        fresh = with_comments(with_audit(rows, today=self.today), COMMENTS)
        if not table_exists(self.spark, self._path(name)):
            fresh.write.mode("overwrite").parquet(self._path(name))
        else:
            known = self.table(name).select(*key)
            same = F.lit(True)
            for column in key:
                same = same & fresh[column].eqNullSafe(known[column])
            fresh.join(known, same, "left_anti").write.mode("append").parquet(self._path(name))
        return self.table(name)

    def dim_customer(self, since: datetime | None = None) -> DataFrame:
        texts = ("customer_device_id", *dims.CUSTOMER_ATTRIBUTES)
        versions = version_dimension(self.customers.versions(since), texts, missing=dims.MISSING)
        return with_unknown_member(versions, unknown_version("customer_key", texts))

    # Load ---------------------------------------------------------------------------------------

    def load(
        self, raw_location: DataFrame, raw_product: DataFrame, landed_rates: DataFrame, mapping: DataFrame,
        lateness: str = "merge",
    ) -> list[date | None]:
        """Take in all batches that are open and return the days that changed.

        ``raw_location`` and ``raw_product`` need to hold no more than what is new.  With
        ``lateness="merge"`` the touched days are found again from all that landed for them; with
        "drop" only order lines beyond the newest of the fact are added.
        """
        with shuffles_freed(self.spark):
            return self._load(raw_location, raw_product, landed_rates, mapping, lateness)

    def _load(
        self, raw_location: DataFrame, raw_product: DataFrame, landed_rates: DataFrame, mapping: DataFrame, lateness: str
    ) -> list[date | None]:
        batches = self.open_batches()
        if not batches:
            return []
        if lateness not in ("merge", "drop"):
            raise ValueError(f"unknown lateness {lateness!r}")
        ledger = self.table("ledger").where(F.col("batch").cast("string").isin(batches))
        # One row per touched day.
        days = sorted((r[DAY] for r in ledger.select(DAY).distinct().collect()), key=lambda d: (d is not None, d or date.min))
        new = self.landed(days, batches)
        self.customers.load(dims.customer_states(new), "record_time", "+".join(batches))
        store = self.extend("dim_store", dims.dim_store(new), ["store_key"])
        currency = self.extend("dim_currency", dims.dim_currency(new, mapping), ["currency_key"])
        calendar = self.extend("dim_date", dims.dim_date(new, self.today), ["date_key"])
        product = self.extend("dim_product", dims.dim_product(raw_product), ["product_key"])
        ips = self.extend("stg_location", dims.located_ips(raw_location), ["ip", *dims.PLACE_COLUMNS])
        location = self.extend("dim_location", dims.dim_location(ips), ["location_key", *dims.PLACE_COLUMNS])
        # Days times currencies: small whatever the events are.
        rates = rates_to_base(
            landed_rates, currency.where(F.col("currency_key") != UNKNOWN_KEY),
            calendar.where(F.col("date_key") != F.lit(dims.UNKNOWN_DATE)),
        )
        near_ips = sales.small_side(ips)
        mark = self._mark() if lateness == "drop" else None
        many = product.count() >= sales.MANY_PRODUCTS
        # A few days at a time, so that only their lines are in shuffles.
        for some, until in self._day_groups(days, batches if lateness == "drop" else None, apart=many):
            events = self.landed(some) if lateness == "merge" else self.landed(some, batches)
            sold = sales.sold_products(events) if many and None not in some else None
            fact = self._fact(
                events, some, product, location, near_ips, currency, store, calendar, mapping, rates, until, sold
            )
            if lateness == "merge":
                self._write(fact, "overwrite")
            else:
                self._write(after_mark(fact, "time_stamp", mark), "append")
        for batch in batches:
            done = self.spark.range(1).select(F.lit(len(days)).alias("days"))
            done.write.mode("overwrite").parquet(f"{self._path('loaded')}/batch={batch}")
        return days

    def _day_groups(
        self, days: list[date | None], batches: Sequence[str] | None, apart: bool = False
    ) -> list[tuple[list[date | None], date | None]]:
        """The days in order, in groups of about as many documents, each with the first day of the next one.

        ``apart`` gives events without a time a group of their own.
        """
        ledger = self.table("ledger").where(one_of(DAY, days))
        if batches is not None:
            ledger = ledger.where(F.col("batch").cast("string").isin(list(batches)))
        # One row per touched day.
        sizes = {r[DAY]: r["documents"] for r in ledger.groupBy(DAY).agg(F.sum("documents").alias("documents")).collect()}
        total = sum(sizes.values())
        wanted = max(1, min(sales.SLICES, -(-total // sales.SLICE_DOCUMENTS)))
        groups: list[list[date | None]] = []
        before, last = 0, -1
        for day in days:
            number = before * wanted // max(total, 1)
            if number != last or (apart and groups[-1] == [None]):
                groups.append([])
                last = number
            groups[-1].append(day)
            before += sizes.get(day, 0)
        return [(group, after[0] if after else None) for group, after in zip(groups, [*groups[1:], None])]

    def _fact(self, events: DataFrame, days: list[date | None], product, location, ips, currency, store, calendar, mapping, rates, until: date | None = None, sold: DataFrame | None = None):
        """Order lines of the given days, which end before ``until``, with their keys."""
        visits = sales.checkout_visits(events)
        known = [d for d in days if d is not None]
        since = datetime.combine(min(known), time(), timezone.utc) if known else datetime.now(timezone.utc) + timedelta(days=1)
        devices = visits.select(F.col("device").alias("customer_device_id")).distinct()
        versions = self.customers.versions(since)
        if until is not None:
            versions = versions.where(F.col("start_time") < F.lit(datetime.combine(until, time(), timezone.utc)))
        customer = versions.join(devices, "customer_device_id", "left_semi")
        fact = sales.sales_fact(
            sales.order_lines(events, ips, together=sales.FACT_TOGETHER), visits=visits, customer=customer, product=product, location=location,
            currency=currency, store=store, calendar=calendar, mapping=mapping, rates=rates, sold=sold,
        )
        return with_comments(with_audit(fact, today=self.today), COMMENTS)

    def _write(self, fact: DataFrame, mode: str) -> None:
        by_day = fact.withColumn(DAY, self._day(F.col("time_stamp")))
        # Lines of an order repeat most of their keys.
        sorted_days = by_day.hint("rebalance", DAY).sortWithinPartitions(DAY, "time_stamp", "order_id")
        sorted_days.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(
            self._path("fact_sales_order_detail")
        )

    def _mark(self) -> datetime | None:
        """Newest time of the fact, from its last day alone."""
        if not path_exists(self.spark, self._path("fact_sales_order_detail")):
            return None
        fact = self.table("fact_sales_order_detail")
        last = fact.select(DAY).distinct().agg(F.max(DAY).alias("day")).first()["day"]
        return None if last is None else high_water_mark(fact.where(F.col(DAY) == F.lit(last)), "time_stamp")
