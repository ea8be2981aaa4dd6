"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# No digest looks like this.
UNKNOWN_KEY = "-1"


def surrogate_key(*parts: Column) -> Column:
    """Key of the parts' text joined by pipes: the whole MD5 as hex text; NULL if any part is NULL.

    A shorter digest would let keys of large dimensions meet: with 60 bits some 40 pairs of 10**10.
    """
    texts = [part.cast("string") for part in parts]
    joined = texts[0]
    for text in texts[1:]:
        joined = F.concat(joined, F.lit("|"), text)
    return F.md5(joined)


def packed_key(key: Column) -> Column:
    """A key as bytes, for shuffles: a digest as its sixteen, other text with any other length.

    Different keys stay different, and NULL stays NULL.
    """
    text = key.cast("string")
    plain = F.encode(text, "utf-8")
    return (
        F.when(text.rlike(r"^[0-9a-f]{32}\z"), F.unhex(text))
        .when(F.octet_length(text) < 16, plain)
        .otherwise(F.concat(F.lit(bytearray(1)), plain))
    )


def load_id(bucket: Column, name: Column, generation: Column) -> Column:
    """Stable id of one generation of one file, so that it is loaded at most once."""
    identity = F.concat_ws(
        "\n", bucket, name, F.coalesce(generation.cast("string"), F.lit(""))
    )
    return F.concat(F.lit("gcs_load_"), F.sha2(identity, 256))
