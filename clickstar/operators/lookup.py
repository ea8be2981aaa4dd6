"""Dimension lookups, unknown members, null defaults and audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import WAREHOUSE_ZONE, today_in


def lookup_key(
    facts: DataFrame, dim: DataFrame, on: Mapping[str, str] | Sequence[str], key: str,
    out: str | None = None,
) -> DataFrame:
    """Left join that adds one dimension column; ``on`` maps fact to dimension columns.

    NULL fact values never match.  No broadcast hint: Spark broadcasts a dimension only if its
    measured size is below ``spark.sql.autoBroadcastJoinThreshold``, and AQE splits the hot keys
    of a shuffled one.  A dimension with repeated keys repeats the fact, as in SQL.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {name: name for name in on}
    names = {fact: f"__dim_{i}" for i, fact in enumerate(pairs)}
    side = dim.select(
        *[F.col(dim_name).alias(names[fact]) for fact, dim_name in pairs.items()],
        F.col(key).alias(out or key),
    )
    condition = [facts[fact] == side[alias] for fact, alias in names.items()]
    return facts.join(side, condition, "left").drop(*names.values())


def default_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by per-column defaults, keeping each column's type."""
    types = {field.name: field.dataType for field in df.schema.fields}
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.lit(value).cast(types[name])) for name, value in defaults.items()}
    )


def latest_rows(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The last row of each key, for landing tables to which changed rows were appended again.

    Without it every version of a repeated key stays, and a lookup repeats the fact.
    """
    others = [name for name in df.columns if name not in keys]
    last = F.max_by(F.struct(*others), order).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"last.{name}").alias(name) for name in others])


def with_unknown_member(df: DataFrame, member: Mapping[str, object]) -> DataFrame:
    """Append the one row that facts without a match point at; ``member`` fills every column."""
    missing = set(df.columns) ^ set(member)
    if missing:
        raise ValueError(f"unknown member and dimension differ in {sorted(missing)}")
    row = df.sparkSession.range(1).select(
        *[
            (member[field.name] if isinstance(member[field.name], Column) else F.lit(member[field.name]))
            .cast(field.dataType)
            .alias(field.name)
            for field in df.schema.fields
        ]
    )
    return df.unionByName(row)


def with_audit(
    df: DataFrame, actor: str = "dbt", zone: str = WAREHOUSE_ZONE, today: date | None = None
) -> DataFrame:
    day = today_in(zone, today)
    return df.withColumns(
        {
            "inserted_date": day,
            "inserted_by": F.lit(actor),
            "updated_date": day,
            "updated_by": F.lit(actor),
        }
    )


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions; they are kept in the files and in catalog tables."""
    return df.select(
        *[
            F.col(field.name).alias(
                field.name, metadata={**field.metadata, "comment": comments[field.name]}
            )
            if field.name in comments
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )
