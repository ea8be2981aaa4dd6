"""Address ranges that may contain or overlap each other, laid out so that the narrowest one is found.

An address is a text of hex digits, four of which make a step.  A range is cut into pieces: each
covers whole steps ``start .. until`` below one prefix, at most two pieces per length of prefix.  Below
one prefix there are 65,536 steps, so the pieces there are painted over each other, the narrowest range
last, and what shows are segments that do not overlap.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

BITS = 16
STEPS = 1 << BITS
_PIECE = "prefix string, start int, until int, rank string"


def pieces(low: int, high: int, levels: int) -> Iterator[tuple[str, int, int]]:
    """(prefix, start, until) of the pieces of the range of two numbers of ``levels`` steps."""
    for level in range(levels, 0, -1):
        above_low, first = divmod(low, STEPS)
        above_high, last = divmod(high, STEPS)
        text = lambda above, level=level: f"{above:0{4 * (level - 1)}x}" if level > 1 else ""
        if above_low == above_high:
            if level == 1 or first or last != STEPS - 1:
                yield text(above_low), first, last
                return
        else:
            if first:
                yield text(above_low), first, STEPS - 1
                above_low += 1
            if last != STEPS - 1:
                yield text(above_high), 0, last
                above_high -= 1
            if above_low > above_high:
                return
        low, high = above_low, above_high


def flatten(ranges: DataFrame, found: Sequence[str]) -> DataFrame:
    """Segments (prefix, start, until, rank, ``found`` …) of ``ranges`` (low, high, ``found`` …).

    ``low`` and ``high`` are hex texts of one length, both inclusive; ranges without an end or with the
    ends the wrong way round are left out.  ``rank`` orders by width, then the later start.  The result
    is computed once: range tables are small beside what is looked up in them.
    """
    found = list(found)
    whole = ranges.where("low <= high").select("low", "high", *found)
    kept = T.StructType([f for f in whole.schema.fields if f.name in found])
    schema = T.StructType([*T.StructType.fromDDL(_PIECE).fields, *kept.fields])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], []
            for i, (low, high) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                bits, first, last = 4 * len(low), int(low, 16), int(high, 16)
                # Of ranges of one width the later one comes first.
                rank = f"{last - first + 1:033x}{(1 << bits) - 1 - first:0{len(low)}x}"
                for piece in pieces(first, last, bits // BITS):
                    rows.append(i)
                    made.append((*piece, rank))
            index = pa.array(rows, pa.int64())
            columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.string(), pa.int32(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(n).take(index) for n in found)], names=schema.names)

    def paint(table: pa.Table) -> pa.Table:
        # Widest first; equal ranges in the order of what they hold, so that one of them always wins.
        table = table.sort_by([(name, "descending") for name in ("rank", *found)])
        shown = np.full(STEPS + 1, -1, np.int64)
        for i, (start, until) in enumerate(zip(table["start"].to_pylist(), table["until"].to_pylist(), strict=True)):
            shown[start : until + 1] = i
        starts = np.flatnonzero(np.r_[True, shown[1:] != shown[:-1]])
        untils = np.r_[starts[1:], STEPS + 1] - 1
        covered = shown[starts] >= 0
        segments = table.take(pa.array(shown[starts][covered]))
        for name, values in (("start", starts), ("until", untils)):
            segments = segments.set_column(segments.schema.get_field_index(name), name, pa.array(values[covered], pa.int32()))
        return segments

    return cut_lineage(whole.mapInArrow(cut, schema).groupBy("prefix").applyInArrow(paint, schema))


def narrowest(points: DataFrame, key: str, digits: int, segments: DataFrame, found: Sequence[str]) -> DataFrame:
    """``points`` with the columns ``found`` of the narrowest range that covers the hex text ``key`` of
    ``digits`` digits; NULL without one.  Rows of ``points`` are distinct.

    Each prefix of an address asks for one step; the distinct questions below a prefix are few and are
    answered by the last segment that starts before them.
    """
    steps = [
        F.struct(
            F.substring(key, 1, at).alias("prefix"), F.conv(F.substring(key, at + 1, 4), 16, 10).cast("int").alias("step")
        )
        for at in range(0, digits, 4)
    ]
    wanted = points.select(*points.columns, F.explode(F.array(*steps)).alias("asked")).select(*points.columns, "asked.*")
    questions = wanted.where(F.col("step").isNotNull()).select("prefix", "step").distinct()
    line = questions.withColumn("side", F.lit(1)).unionByName(
        segments.select(
            "prefix", F.col("start").alias("step"), F.lit(0).alias("side"), F.struct("until", "rank", *found).alias("segment")
        ), allowMissingColumns=True,
    )
    before = Window.partitionBy("prefix").orderBy("step", "side").rowsBetween(Window.unboundedPreceding, 0)
    answers = line.withColumn("segment", F.last("segment", ignorenulls=True).over(before)).where(
        (F.col("side") == 1) & (F.col("step") <= F.col("segment.until"))
    ).select("prefix", "step", "segment")
    best = F.min_by("segment", F.col("segment.rank")).alias("best")
    return wanted.join(answers, ["prefix", "step"], "left").groupBy(*points.columns).agg(best).select(
        *points.columns, *[F.col(f"best.{name}").alias(name) for name in found]
    )
