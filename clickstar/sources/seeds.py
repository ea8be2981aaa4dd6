"""Currency mapping: the seed table and the check of a proposed mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, trim_ws

MAPPING_SCHEMA = "raw_currency string, currency_code string, currency_name string"

# Currency texts as the shops write them, with ISO code and name.
CURRENCY_MAPPING = (
    ("AU $", "AUD", "Australian dollar"),
    ("лв.", "BGN", "Bulgarian lev"),
    ("BOB Bs", "BOB", "Boliviano"),
    ("R$", "BRL", "Brazilian real"),
    ("CAD $", "CAD", "Canadian dollar"),
    ("CHF", "CHF", "Swiss franc"),
    ("CLP", "CLP", "Chilean peso"),
    ("COP $", "COP", "Colombian peso"),
    ("CRC ₡", "CRC", "Costa Rican colón"),
    ("Kč", "CZK", "Czech koruna"),
    ("DOP $", "DOP", "Dominican peso"),
    ("€", "EUR", "Euro"),
    ("£", "GBP", "Pound sterling"),
    ("GTQ Q", "GTQ", "Guatemalan quetzal"),
    ("HKD $", "HKD", "Hong Kong dollar"),
    ("kn", "HRK", "Croatian kuna"),
    ("Ft", "HUF", "Hungarian forint"),
    ("₹", "INR", "Indian rupee"),
    ("￥", "JPY", "Japanese yen"),
    ("د.ك.‏", "KWD", "Kuwaiti dinar"),
    ("MXN $", "MXN", "Mexican peso"),
    ("NZD $", "NZD", "New Zealand dollar"),
    ("PEN S/.", "PEN", "Peruvian sol"),
    ("₱", "PHP", "Philippine peso"),
    ("zł", "PLN", "Polish złoty"),
    ("₲", "PYG", "Paraguayan guaraní"),
    ("Lei", "RON", "Romanian leu"),
    ("din.", "RSD", "Serbian dinar"),
    ("kr", "SEK", "Swedish krona"),
    ("SGD $", "SGD", "Singapore dollar"),
    ("₺", "TRY", "Turkish lira"),
    ("$", "USD", "United States dollar"),
    ("USD $", "USD", "United States dollar"),
    ("UYU", "UYU", "Uruguayan peso"),
    ("₫", "VND", "Vietnamese đồng"),
)


def currency_mapping(spark: SparkSession) -> DataFrame:
    """The built-in mapping.  Rows listed in the query have a known size, so Spark broadcasts them."""
    rows = ", ".join(str(row) for row in CURRENCY_MAPPING)
    names = ", ".join(field.split()[0] for field in MAPPING_SCHEMA.split(", "))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS mapping({names})")


def read_seed(spark: SparkSession, path: str, schema: str = MAPPING_SCHEMA) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)


def currency_frequency(checkouts: DataFrame) -> DataFrame:
    """Currency texts of all cart items, trimmed, with their number, most frequent first.

    Only the currency field of the nested items is read.
    """
    text = blank_to_null(F.col("raw_currency"))
    return (
        checkouts.select(F.explode("cart_products.currency").alias("raw_currency"))
        .select(text.alias("raw_currency"))
        .where(F.col("raw_currency").isNotNull())
        .groupBy("raw_currency")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.col("occurrences").desc())
    )


def checked_mapping(mapping: DataFrame, observed: DataFrame) -> DataFrame:
    """Proposed mapping rows, cleaned, with ``problem`` NULL where a row may be used.

    A row needs a three-letter code, a raw currency that occurs in the data, and no other row
    that maps the same raw currency differently.
    """
    wanted = ["raw_currency", "currency_code", "currency_name"]
    if sorted(mapping.columns) != sorted(wanted):
        raise ValueError(f"a mapping has exactly the columns {wanted}")
    clean = mapping.select(
        trim_ws(F.col("raw_currency")).alias("raw_currency"),
        F.upper(trim_ws(F.col("currency_code"))).alias("currency_code"),
        trim_ws(F.col("currency_name")).alias("currency_name"),
    ).distinct()
    clashes = clean.groupBy("raw_currency").agg(F.count("*").alias("versions"))
    seen = observed.select("raw_currency").distinct().withColumn("seen", F.lit(True))
    return (
        clean.join(clashes, "raw_currency")
        .join(seen, "raw_currency", "left")
        .withColumn(
            "problem",
            F.when(F.col("seen").isNull(), "not observed")
            .when(~F.col("currency_code").rlike("^[A-Z]{3}$"), "bad code")
            .when(F.col("versions") > 1, "conflicting rows"),
        )
        .select(*wanted, "problem")
    )


def valid_mapping(mapping: DataFrame, observed: DataFrame) -> DataFrame:
    return (
        checked_mapping(mapping, observed)
        .where(F.col("problem").isNull())
        .drop("problem")
        .orderBy("currency_code", "raw_currency")
    )
