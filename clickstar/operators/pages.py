"""From fetched pages to product records."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable
from itertools import chain
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import HTTP_URL, last_chars, normal_id

DATA_URL_VARIABLE = "react_data_url"
NO_VARIABLE = "script variable not found"
BAD_URL = "script variable holds no http(s) url"
NO_JSON = "payload is no json"
TOO_DEEP = "payload is nested too deep"
NO_PRODUCT = "no object with product_id in the json"
WRONG_PRODUCT = "product_id differs"

# One-letter escapes of script strings; a hex escape is \uXXXX.
ESCAPES = {"/": "/", "\\": "\\", "'": "'", '"': '"', "n": "\n", "r": "\r", "t": "\t"}
_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|(.))", re.S)
_SURROGATE = re.compile("[\ud800-\udfff]")

# The product fields kept; fields a payload lacks become NULL.
PRODUCT_FIELDS = (
    "product_id", "name", "sku", "attribute_set_id", "attribute_set", "type_id", "price",
    "min_price", "max_price", "min_price_format", "max_price_format", "gold_weight",
    "none_metal_weight", "fixed_silver_weight", "material_design", "qty", "collection",
    "collection_id", "product_type", "product_type_value", "category", "category_name",
    "store_code", "platinum_palladium_info_in_alloy", "bracelet_without_chain",
    "show_popup_quantity_eternity", "visible_contents", "gender", "configure_mode",
    "included_chain_weight",
)


def _variable_pattern(name: str) -> str:
    # Runs of ordinary characters are matched possessively, so long values need no deep recursion.
    quoted = "|".join(rf"{q}([^{q}\\]*+(?:\\.[^{q}\\]*+)*+){q}" for q in "'\"")
    return rf"(?is)\b{re.escape(name)}\s*=\s*(?:{quoted})"


def plain_text(text: str) -> str:
    """Text that can be stored as UTF-8: halves of a pair are joined, lone ones become U+FFFD."""
    if not _SURROGATE.search(text):
        return text
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


def unescaped(text: str) -> str:
    """The value of a script string, by one scan from left to right; unknown escapes stay."""
    return plain_text(
        _ESCAPE.sub(lambda found: chr(int(found[1], 16)) if found[1] else ESCAPES.get(found[2], found[0]), text)
    )


@F.pandas_udf(T.StringType())
def _resolve(base: pd.Series, value: pd.Series) -> pd.Series:
    def against(page: str | None, text: str | None) -> str | None:
        try:
            return None if text is None else plain_text(urljoin(page or "", html.unescape(unescaped(text))))
        except ValueError:
            return None

    return base.combine(value, against).astype(object)


def script_variable_url(pages: DataFrame, variable: str = DATA_URL_VARIABLE) -> DataFrame:
    """Add ``data_url`` and ``error`` to pages(url, html).

    The page text is searched inside the JVM; only the short matched value goes to Python, for
    unescaping and resolving against the page URL.
    """
    pattern = _variable_pattern(variable)
    page = F.col("html")
    value = F.when(
        page.rlike(pattern),
        F.concat(F.regexp_extract(page, pattern, 1), F.regexp_extract(page, pattern, 2)),
    )
    resolved = pages.withColumn("__value", value).withColumn("__url", _resolve("url", "__value"))
    valid = F.coalesce(F.col("__url").rlike(HTTP_URL), F.lit(False))
    return resolved.withColumns(
        {
            "data_url": F.when(valid, F.col("__url")),
            "error": F.when(F.col("__value").isNull(), NO_VARIABLE).when(~valid, BAD_URL),
        }
    ).drop("__value", "__url")


def _children(value: object) -> Iterable[object]:
    return value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()


def _product_in(payload: str | None) -> tuple[str | None, str | None]:
    """JSON text of the product object of one payload, or an error.

    The levels of the document are looked through from the top.  A full product has a product_id
    and a sku or a name; the first one of the topmost level that has any wins.  Without one the
    first object with a product_id counts.
    """
    try:
        level = [json.loads(payload or "")]
        known = []
        while level:
            named = [value for value in level if isinstance(value, dict) and "product_id" in value]
            full = next((value for value in named if "sku" in value or "name" in value), None)
            if full is not None:
                known = [full]
                break
            known += named[:1]
            level = list(chain.from_iterable(map(_children, level)))
        return (plain_text(json.dumps(known[0], ensure_ascii=False)), None) if known else (None, NO_PRODUCT)
    except RecursionError:
        return None, TOO_DEEP
    except ValueError:
        return None, NO_JSON


@F.pandas_udf(T.StructType([T.StructField("product", T.StringType()), T.StructField("error", T.StringType())]))
def product_object(payloads: pd.Series) -> pd.DataFrame:
    """The product object of each JSON payload, or why there is none.

    Its depth is unknown, so no fixed set of JSON paths finds it, and a variant keeps the fields of
    an object by name, not in their order, which decides here; rows stay where they are.
    """
    found = [_product_in(payload) for payload in payloads]
    return pd.DataFrame(found, columns=["product", "error"], dtype=object)


def find_products(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``product`` (JSON text) and, where none was found, ``error``."""
    found = df.withColumn("__found", product_object(payload))
    return found.withColumns({"product": F.col("__found.product"), "error": F.col("__found.error")}).drop("__found")


def product_fields(product: Column, fields: tuple[str, ...] = PRODUCT_FIELDS) -> list[Column]:
    """The whitelisted fields of a product object as text columns."""
    parsed = F.from_json(product, ", ".join(f"`{name}` string" for name in fields))
    return [parsed[name].alias(name) for name in fields]


def judge_attempts(fetched: DataFrame) -> DataFrame:
    """Mark each fetched(product_id, priority, url, payload, error) row: ``product`` or ``error``.

    A row that failed to fetch keeps its error; else the payload must hold a product object with
    the requested id.
    """
    found = (
        fetched.withColumn("__found", product_object(F.when(F.col("error").isNull(), F.col("payload"))))
        .withColumns({"product": F.col("__found.product"), "problem": F.col("__found.error")})
    )
    actual = F.get_json_object("product", "$.product_id")
    same = normal_id(actual).eqNullSafe(normal_id(F.col("product_id")))
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .when(~same, F.concat(F.lit(WRONG_PRODUCT + " (wanted "), F.col("product_id"),
                              F.lit(", found "), F.coalesce(actual, F.lit("null")), F.lit(")")))
    )
    return found.select(
        "product_id", "priority", "url", F.when(error.isNull(), F.col("product")).alias("product"),
        error.alias("error"),
    )


def fetched_products(judged: DataFrame) -> DataFrame:
    """The first good URL of each product: (product_id, priority, source_url, product)."""
    good = F.col("error").isNull()
    return judged.where(good).groupBy("product_id").agg(
        F.min("priority").alias("priority"),
        F.min_by("url", "priority").alias("source_url"),
        F.min_by("product", "priority").alias("product"),
    )


def fetch_failures(judged: DataFrame) -> DataFrame:
    """Failed URLs that were tried before the first good one, with the URL that recovered them."""
    winners = fetched_products(judged).select(
        "product_id", F.col("priority").alias("won_at"), F.col("source_url").alias("recovered_via")
    )
    return (
        judged.where(F.col("error").isNotNull())
        .join(winners, "product_id", "left")
        .where(F.col("won_at").isNull() | (F.col("priority") < F.col("won_at")))
        .select("product_id", "priority", "url", "error", "recovered_via")
    )


def lost_products(judged: DataFrame, chars: int | None = None) -> DataFrame:
    """Products without any good URL and the joined error text of their URLs, in order of priority.

    ``chars`` keeps the end of the text only.  A URL that is missing is empty in the text.
    """
    lost = judged.join(judged.where(F.col("error").isNull()).select("product_id").distinct(), "product_id", "left_anti")
    piece = F.concat(F.coalesce("url", F.lit("")), F.lit(": "), F.col("error")).alias("piece")
    return (
        lost.groupBy("product_id")
        .agg(F.array_sort(F.collect_list(F.struct("priority", piece))).alias("pieces"))
        .select("product_id", last_chars(F.array_join(F.col("pieces.piece"), " | "), chars).alias("last_error"))
    )
