"""Product URL candidates from browsing events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_id, clean_url, url_quote
from .first_n import first_n

# The event types that carry a product.
STANDARD_EVENTS = (
    "view_product_detail",
    "select_product_option",
    "select_product_option_quality",
    "add_to_cart_action",
    "product_detail_recommendation_visible",
    "product_detail_recommendation_noticed",
)
RECOMMEND_CLICK_EVENT = "product_view_all_recommend_clicked"
PRODUCT_EVENTS = (*STANDARD_EVENTS, RECOMMEND_CLICK_EVENT)
MAX_URLS = 3


def product_sightings(events: DataFrame, order: str = "_id") -> DataFrame:
    """(product_id, url?, source, order) of product events; rows without an id are dropped.

    A click on a recommendation tells about the page it was made on, hence its viewed product
    and referrer.
    """
    types = {field.name: field.dataType for field in events.schema.fields}

    def product(name: str) -> Column:
        return clean_id(F.col(name), types[name])

    clicked = F.col("collection") == RECOMMEND_CLICK_EVENT
    return (
        events.where(F.col("collection").isin(*PRODUCT_EVENTS))
        .select(
            F.when(clicked, product("viewing_product_id"))
            .otherwise(F.coalesce(product("product_id"), product("viewing_product_id")))
            .alias("product_id"),
            clean_url(F.when(clicked, F.col("referrer_url")).otherwise(F.col("current_url"))).alias("url"),
            F.col("collection").alias("source"),
            order,
        )
        .where(F.col("product_id").isNotNull())
    )


def url_candidates(events: DataFrame, n: int = MAX_URLS, order: str = "_id") -> DataFrame:
    """First ``n`` distinct URLs of each product with priority and first source."""
    return first_n(product_sightings(events, order), "product_id", "url", "source", order, n).select(
        "product_id", "url", "source", "priority"
    )


def new_products(events: DataFrame, known: DataFrame, order: str = "_id") -> DataFrame:
    """Products sighted (with or without a URL) that are not known yet."""
    return product_sightings(events, order).select("product_id").distinct().join(
        known.select("product_id"), "product_id", "left_anti"
    )


def discovery_counts(events: DataFrame, known: DataFrame, order: str = "_id") -> DataFrame:
    """One row: events scanned, products added."""
    added = new_products(events, known, order).agg(F.count("*")).scalar()
    scanned = events.where(F.col("collection").isin(*PRODUCT_EVENTS))
    return scanned.agg(F.count("*").alias("scanned")).select("scanned", added.alias("added"))


def attempt_urls(products: DataFrame, candidates: DataFrame, template: str) -> DataFrame:
    """URLs to try per product in order: its candidates, then the id template, without repeats."""
    before, mark, after = template.partition("{product_id}")
    if not mark:
        raise ValueError("the template needs {product_id}")
    last_resort = products.select(
        "product_id",
        F.concat(F.lit(before), url_quote(F.col("product_id")), F.lit(after)).alias("url"),
        F.lit(2**31 - 1).alias("priority"),
    )
    return (
        candidates.select("product_id", "url", F.col("priority").cast("int"))
        .unionByName(last_resort)
        .groupBy("product_id", "url")
        .agg(F.min("priority").alias("priority"))
    )
