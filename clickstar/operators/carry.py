"""Look back (or ahead) along a key's history with windows of bounded size.

A plain ``lag``/``last`` window sorts the whole history of a key in one task, which fails when
one device owns a third of all rows.  Here a history is cut into chunks.  Each chunk is one
window partition, and a chunk starts from a *carry row* that holds the last value of the chunks
before it.  Carry rows come from one partial aggregate per (key, chunk), so only the short list
of chunks of a key ever meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CARRIED = "__carried"
_IS_CARRY = "__is_carry"


def carry_value(
    df: DataFrame,
    keys: Sequence[str],
    chunks: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    *,
    inclusive: bool = False,
    ahead: bool = False,
) -> DataFrame:
    """Add ``out``: the nearest non-null ``value`` before each row of the same ``keys``.

    ``chunks`` are columns from coarse to fine that rise with ``order``; every (keys, chunks)
    group must be of bounded size.  ``inclusive`` also looks at the row itself, ``ahead`` looks
    at later rows instead of earlier ones.  Key and chunk columns must not be NULL.
    """
    group = [*keys, *chunks]

    def direction(name: str) -> Column:
        # The carry row has NULL order columns and has to come first in both directions.
        return F.col(name).desc_nulls_first() if ahead else F.col(name).asc_nulls_first()

    window = (
        Window.partitionBy(*group)
        .orderBy(*[direction(name) for name in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    nearest = F.last(value, ignorenulls=True).over(window)
    if not chunks:
        return df.withColumn(out, nearest)

    rank = F.struct(*order)
    present = F.col(value).isNotNull()
    pick = F.min_by if ahead else F.max_by
    ends = df.groupBy(*group).agg(
        pick(F.when(present, F.col(value)), F.when(present, rank)).alias(value)
    )
    carry = (
        carry_value(ends, keys, chunks[:-1], [chunks[-1]], value, _CARRIED, ahead=ahead)
        .where(F.col(_CARRIED).isNotNull())
        .select(*group, F.col(_CARRIED).alias(value), F.lit(True).alias(_IS_CARRY))
    )
    rows = df.withColumn(_IS_CARRY, F.lit(False))
    return (
        rows.unionByName(carry, allowMissingColumns=True)
        .withColumn(out, nearest)
        .where(~F.col(_IS_CARRY))
        .drop(_IS_CARRY)
    )


def time_chunk(ts: Column, days: int) -> Column:
    """Number of the ``days``-long stretch of time that holds a timestamp."""
    return F.floor(F.unix_seconds(ts) / F.lit(days * 86400)).cast("bigint")
