"""Slowly changing dimensions, type 2: build the versions and look them up as of a time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import UNKNOWN_KEY, surrogate_key
from ..functions.time import iso_micros
from .carry import carry_value, time_chunk

FIRST_TIME = "1900-01-01 00:00:00"
LAST_TIME = "9999-01-01 00:00:00"

# With one row per second left, a (entity, chunk) group has at most 8 million rows, which one task
# sorts with ease; most entities then have few chunks, hence few carry rows.
CHUNK_DAYS = 91


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def best_row(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], preference: Sequence[str]
) -> DataFrame:
    """One row per ``keys``: the one with most preferred attributes filled, then the largest.

    A struct maximum compares the filled flags first and then the values, NULL lowest; unlike a
    row number it pre-aggregates before the shuffle.
    """
    flags = [F.col(name).isNotNull().alias(f"has_{name}") for name in preference]
    best = F.max(F.struct(*flags, *preference)).alias("best")
    return df.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"best.{name}").alias(name) for name in attributes]
    )


def build_versions(
    events: DataFrame,
    entity: str,
    ts: str,
    attributes: Sequence[str],
    preference: Sequence[str] | None = None,
    *,
    key: str = "version_key",
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Versions ``[start_time, end_time)`` of an entity, a new one at each attribute change.

    Rows without entity or time are left out.  A value that becomes NULL, or stops being NULL,
    is a change.  Returns key, entity, attributes, start_time, end_time, is_current.
    """
    observed = events.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
    states = best_row(observed, [entity, ts], attributes, preference or attributes).select(
        entity,
        F.col(ts).alias("start_time"),
        time_chunk(F.col(ts), chunk_days).alias("chunk"),
        F.struct(*attributes).alias("state"),
    )
    changes = carry_value(
        states, [entity], ["chunk"], ["start_time"], "state", "previous_state"
    ).where(~F.col("state").eqNullSafe(F.col("previous_state")))
    # The changes are still grouped by (entity, chunk): the next one is found in place, and only
    # the last one of a chunk needs the first change of the chunks behind it.
    following = F.lead("start_time").over(Window.partitionBy(entity, "chunk").orderBy("start_time"))
    heads = changes.groupBy(entity, "chunk").agg(F.min("start_time").alias("head"))
    behind = carry_value(heads, [entity], [], ["chunk"], "head", "later", ahead=True).drop("head")
    return (
        changes.withColumn("following", following)
        .join(behind, [entity, "chunk"], "left")
        .withColumn("next_start", F.coalesce("following", "later"))
        .select(
            surrogate_key(F.col(entity), iso_micros(F.col("start_time"))).alias(key),
            entity,
            *[F.col(f"state.{name}").alias(name) for name in attributes],
            "start_time",
            F.coalesce("next_start", _time(LAST_TIME)).alias("end_time"),
            F.col("next_start").isNull().alias("is_current"),
        )
    )


def version_dimension(
    versions: DataFrame, text_columns: Sequence[str], *, missing: str = "XNA"
) -> DataFrame:
    """Defaults for missing attributes and interval ends."""
    return versions.withColumns(
        {
            **{name: F.coalesce(name, F.lit(missing)) for name in text_columns},
            "start_time": F.coalesce("start_time", _time(FIRST_TIME)),
            "end_time": F.coalesce("end_time", _time(LAST_TIME)),
            "is_current": F.coalesce("is_current", F.lit(False)),
        }
    )


def unknown_version(key: str, text_columns: Sequence[str]) -> Mapping[str, Column]:
    return {
        key: F.lit(UNKNOWN_KEY),
        **{name: F.lit("Unknown") for name in text_columns},
        "start_time": _time(FIRST_TIME),
        "end_time": _time(LAST_TIME),
        "is_current": F.lit(False),
    }


def asof_lookup(
    facts: DataFrame,
    versions: DataFrame,
    *,
    on: tuple[str, str],
    ts: str,
    key: str,
    start: str = "start_time",
    end: str = "end_time",
    points: DataFrame | None = None,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Left as-of join: add ``key`` of the version with ``start <= ts < end``, else NULL.

    The versions of one entity must not overlap, as :func:`build_versions` guarantees.  Joining
    on the entity alone would compare every fact of a hot entity with all of its versions.
    Instead the distinct (entity, second) points are placed between the versions with bounded
    windows, and the facts pick up the answer with a plain equality join.  ``points`` may name a
    frame with all (entity, ts) pairs of the facts that is cheaper to read than the facts.
    """
    fact_entity, version_entity = on
    needed = facts if points is None else points
    points = needed.where(F.col(fact_entity).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(fact_entity).alias("entity"), F.col(ts).alias("at"), F.lit(1).alias("side")
    ).distinct()
    steps = versions.where(F.col(version_entity).isNotNull()).select(
        F.col(version_entity).alias("entity"),
        F.col(start).alias("at"),
        F.lit(0).alias("side"),
        F.struct(F.col(end).alias("until"), F.col(key).alias("found")).alias("version"),
    )
    timeline = points.unionByName(steps, allowMissingColumns=True).withColumn(
        "chunk", time_chunk(F.col("at"), chunk_days)
    )
    answers = (
        carry_value(timeline, ["entity"], ["chunk"], ["at", "side"], "version", "hit", inclusive=True)
        .where((F.col("side") == 1) & (F.col("at") < F.col("hit.until")))
        .select(
            F.col("entity").alias(fact_entity), F.col("at").alias(ts), F.col("hit.found").alias(key)
        )
    )
    return facts.join(answers, [fact_entity, ts], "left")
