"""Boilerplate lines: lines that occur on many sites are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# A line is boilerplate from this number of sites on; one of fewer characters than SHORT_CHARS, which two
# authors may well write alike, from SHORT_SITES on.
MIN_SITES = 5
SHORT_CHARS = 20
SHORT_SITES = 10
# Size of the sketches (log2 of the registers).
SKETCH_BITS = 12
_SPACE = " \t\r\x0b\x0c"


def _parts(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _stripped(line: str) -> Column:
    return F.btrim(F.col(line), F.lit(_SPACE))


def occurrences(
    docs: DataFrame, min_sites: int = MIN_SITES, short_chars: int = SHORT_CHARS, short_sites: int = SHORT_SITES
) -> DataFrame:
    """(doc_id, text_key, site, pos, key, least): all lines but empty ones, by the hash of their text, and
    from how many sites on each is boilerplate."""
    base = docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"),
        F.col("source").cast("string").alias("site"), F.posexplode(_parts()).alias("pos", "line"),
    )
    line = _stripped("line")
    least = F.when(F.length(line) < short_chars, short_sites).otherwise(min_sites)
    return base.where(line != "").select(
        "doc_id", "text_key", "site", "pos", F.unhex(F.md5(line)).alias("key"), least.alias("least")
    )


def boilerplate(found: DataFrame) -> DataFrame:
    """(key, first): hashes of lines on ``least`` sites or more, and their first (doc_id, pos).

    One sketch of the sites per line, merged by the aggregation, settles lines far from the
    threshold; those within its error are counted exactly.
    """
    # Three standard errors of the sketch, and what rounding hides.
    margin = F.floor(3 * 1.04 / 2 ** (SKETCH_BITS / 2) * F.col("least")) + 1
    spread = written(
        found.groupBy("key").agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(SKETCH_BITS))).alias("sites"),
            F.min(F.struct("doc_id", "pos")).alias("first"), F.max("least").alias("least"),
        ).where(F.col("sites") >= F.col("least") - margin), "spread",
    )
    near = spread.where(F.col("sites") <= F.col("least") + margin)
    # Sites of a line first, which adds a hot line up where it is read; a semi-join would be pushed below
    # this and deal all occurrences of a line to one task.
    pairs = found.where("site IS NOT NULL").groupBy("key", "site").agg(F.lit(1).alias("one"))
    exact = pairs.join(near.select("key"), "key").groupBy("key").agg(F.count("one").alias("exact_sites"))
    return written(
        spread.where(F.col("sites") > F.col("least") + margin).select("key", "first").union(
            near.join(exact, "key").where(F.col("exact_sites") >= F.col("least")).select("key", "first")
        ), "boilerplate",
    )


def dedup_lines(
    docs: DataFrame, min_sites: int = MIN_SITES, short_chars: int = SHORT_CHARS, short_sites: int = SHORT_SITES
) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) without the lines that occur on many sites.

    A line is a part between line feeds, compared without ASCII white space at its ends.  If it occurs
    in documents of ``min_sites`` sources or more, or of ``short_sites`` if it has fewer than
    ``short_chars`` characters, it goes from everywhere but its first place: smallest doc_id, then first
    line.  What is left is joined
    by line feeds again; ``n_chars`` follows the text where the column exists.  All rows and columns
    stay; two columns ``n_lines`` and ``n_removed`` are put last (replacing such ones).

    Null texts stay null, empty ones empty; both have one empty line, which is never removed.
    Sources that are null count as no site.  Rows without doc_id are neither counted nor changed.
    Rows that repeat a doc_id and text are treated alike.
    """
    found = written(occurrences(docs, min_sites, short_chars, short_sites), "lines")
    bad = boilerplate(found)
    removed = found.join(bad, "key").where(F.struct("doc_id", "pos") != F.col("first")).groupBy("doc_id", "text_key").agg(
        F.collect_set("pos").alias("__llm_removed")
    ).withColumnsRenamed({"doc_id": "__llm_id", "text_key": "__llm_text"})
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.select(*names).withColumn("__llm_key", F.xxhash64("text")).join(
        removed, (F.col("doc_id") == F.col("__llm_id")) & (F.col("__llm_key") == F.col("__llm_text")), "left"
    )
    parts = _parts()
    places = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "__llm_removed")
    left = F.array_join(F.transform(places, lambda i: F.get(parts, i)), "\n")
    n_lines = F.size(parts).cast("bigint")
    n_removed = F.coalesce(F.size("__llm_removed"), F.lit(0)).cast("bigint")
    out = joined.withColumns({
        "__llm_left": F.when(F.col("__llm_removed").isNull(), F.col("text")).otherwise(left),
        "__llm_lines": n_lines, "__llm_gone": F.when(F.col("__llm_removed").isNull(), 0).otherwise(n_removed),
    })
    changed = {"text": F.col("__llm_left")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("__llm_removed").isNull(), F.col("n_chars")).otherwise(
            F.length("__llm_left").cast(kind)
        )
    return out.select(
        *[changed[c].alias(c) if c in changed else F.col(c) for c in names],
        F.col("__llm_lines").alias("n_lines"), F.col("__llm_gone").cast("bigint").alias("n_removed"),
    )
