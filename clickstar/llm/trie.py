"""Prefix trie of conversations: equal ones collapse to weighted sequences, whose prefixes are added up.

Only digests of the turns move.  A prefix is known by its depth and 128 bits of sums over its turns,
which running sums give without walking a conversation from its start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freed, written

# Turns of one conversation that a window takes at most, where turns are numbered without gaps.
CHUNK = 1_024
# Ids of one list part, as a power of two.
PART_BITS = 10
# Characters of a text by which equal turns are put in order before its digest decides.
HEAD = 64
KEY = ["depth", "k1", "k2"]


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, head, digest, n_words) of each row: what is needed of a turn without its text.

    Null roles and texts count as empty; rows without conv_id belong to no conversation and are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_words"),
    )


def _running(rows: DataFrame, by: str, chunk: Column, order: list, sums: dict[str, Column]) -> DataFrame:
    """``rows``, read twice, with running sums per ``by`` in an order that ``chunk`` follows.

    A window takes one chunk; what earlier chunks add up to is joined where there are any.
    """
    rows = rows.withColumn("chunk", chunk)
    inside = Window.partitionBy(by, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(by, "chunk").agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    carry = totals.select(by, "chunk", *(F.sum(n).over(before).alias(f"{n}_before") for n in sums)).where(
        " and ".join(f"{n}_before is not null" for n in sums)
    )
    summed = rows.select("*", *(F.sum(c).over(inside).alias(n) for n, c in sums.items()))
    joined = summed.join(carry, [by, "chunk"], "left")
    for name in sums:
        joined = joined.withColumn(name, F.col(name) + F.coalesce(f"{name}_before", F.lit(0)))
    return joined.drop("chunk", *(f"{n}_before" for n in sums))


def numbered(digests: DataFrame) -> DataFrame:
    """(conv_id, position, digest, n_words): the turns of :func:`turn_digests` numbered from 0.

    Turns are ordered by ``turn``, null first; equal ones by role, the start of the text, its digest.
    """
    chunk = F.coalesce(F.expr(f"turn div {CHUNK}"), F.lit(-(1 << 62)))
    rows = _running(digests, "conv_id", chunk, ["turn", "role", "head", "digest"], {"position": F.lit(1)})
    return rows.select("conv_id", (F.col("position") - 1).alias("position"), "digest", "n_words")


def _paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, n_words) of every prefix of every conversation, the empty one included."""
    mark = [F.xxhash64("position", "digest"), F.xxhash64("digest", "position", F.lit(1))]
    sums = {}
    for i, hashed in enumerate(mark):
        # Parts of 32 bits, so that no sum overflows.
        sums[f"s{2 * i}"] = F.shiftrightunsigned(hashed, 32)
        sums[f"s{2 * i + 1}"] = hashed.bitwiseAND(F.lit(0xFFFFFFFF))
    summed = _running(turns, "conv_id", F.expr(f"position div {CHUNK}"), ["position"], sums)
    names = list(sums)
    return summed.select(
        "conv_id", (F.col("position") + 1).alias("depth"),
        F.xxhash64("position", *names).alias("k1"), F.xxhash64(*names[::-1], "position").alias("k2"), "n_words",
    ).unionByName(
        convs.select("conv_id", *(F.lit(0).cast("bigint").alias(n) for n in [*KEY, "n_words"]))
    )


def _digests_of_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per sequence of ordered parts of its id list, fed part by part."""
    key, digest, done = None, None, []

    def rows() -> pa.RecordBatch:
        columns = [pa.array([d[i] for d in done], pa.string() if i == 3 else pa.int64()) for i in range(4)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=[*KEY, "ends_sha256"])

    for batch in batches:
        for *now, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
            if now != key:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = now, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if done:
            yield rows()
    if key is not None:
        done.append((*key, digest.hexdigest()))
        yield rows()


def _ends(wholes: DataFrame) -> DataFrame:
    """Digest of the ascending ids of the conversations that are each sequence.

    The list of a sequence is built in parts of a bounded range of ids; the parts, in order, go through
    one running digest, which SHA-256 leaves no way around, without ever being together in memory.
    """
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))
    parts = wholes.groupBy(*KEY, F.shiftright("conv_id", PART_BITS).alias("part")).agg(F.array_join(ids, ",").alias("ids"))
    return parts.repartition(*KEY).sortWithinPartitions(*KEY, "part").mapInArrow(
        _digests_of_ends, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string"
    )


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv_id, position, digest, n_words), which is read twice.

    ``convs`` (conv_id) names all conversations, those without turns as well.  See :func:`prefix_trie`.
    """
    paths = written(_paths(turns, convs), "paths")
    # Whole sequences, each with the count of its conversations and the first of them.
    wholes = written(
        paths.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("whole")).select("conv_id", "whole.*"), "wholes"
    )
    sequences = written(
        wholes.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("first")), "sequences"
    )
    ends = written(_ends(wholes), "ends")
    whole_of = sequences.select(F.col("first").alias("conv_id"), F.col("depth").alias("whole_depth"), "weight")
    collapsed = written(paths.join(whole_of, "conv_id"), "collapsed")
    freed(paths, wholes)
    # A sequence that another one goes on from is no leaf.
    proper = collapsed.where("depth < whole_depth").select(*KEY).distinct()
    leaves = written(
        sequences.join(proper, KEY, "left_anti").select(F.col("first").alias("conv_id"), F.lit(True).alias("leaf")), "leaves"
    )
    rows = written(collapsed.join(leaves, "conv_id", "left"), "rows")
    freed(collapsed, sequences, leaves)
    nodes = written(
        rows.groupBy(*KEY).agg(
            F.sum("weight").alias("n_convs"), F.min("conv_id").alias("node"),
            F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("owner"),
        ), "nodes",
    )
    # Every node is owned by the first leaf below it, so that it is counted once in each node above it,
    # and what a leaf owns is the lower end of its path.
    own = F.col("owner") == F.col("conv_id")
    walk = written(
        rows.where("leaf").join(nodes, KEY).select(
            "conv_id", *KEY, "node", "n_convs", own.alias("own"),
            F.when(own, (F.col("n_convs") - 1) * F.col("n_words")).otherwise(0).alias("saved"),
            F.expr(f"depth div {CHUNK}").alias("chunk"),
        ), "walk",
    )
    freed(rows, nodes)
    up = Window.partitionBy("conv_id", "chunk").orderBy(F.desc("depth"))
    inside = walk.select(
        "*", F.sum("saved").over(up.rowsBetween(Window.unboundedPreceding, 0)).alias("below"),
        F.lead("node").over(up).alias("parent"), F.lag("own").over(up).alias("own_child"),
    )
    # The same across the ends of chunks, for long conversations only.
    across = Window.partitionBy("conv_id").orderBy("chunk")
    edges = walk.groupBy("conv_id", "chunk").agg(
        F.sum("saved").alias("saved"), F.max_by("node", "depth").alias("last"), F.min_by("own", "depth").alias("own")
    ).select(
        "conv_id", "chunk", F.lag("last").over(across).alias("parent_before"), F.lead("own").over(across).alias("own_after"),
        F.sum("saved").over(across.rowsBetween(1, Window.unboundedFollowing)).alias("saved_after"),
    ).where("parent_before is not null or own_after is not null")
    whole = inside.join(edges, ["conv_id", "chunk"], "left")
    summed = whole.groupBy(*KEY).agg(
        F.max("node").alias("conv_id"),
        F.max(F.when(F.col("own"), F.coalesce("parent", "parent_before"))).alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"),
        F.sum(F.coalesce("own_child", "own_after", F.lit(False)).cast("bigint")).alias("n_children"),
        F.count(F.lit(1)).alias("n_leaves"),
        F.sum(F.col("below") + F.coalesce("saved_after", F.lit(0))).alias("saved_tokens"),
    )
    return summed.join(ends, KEY, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of ``conversations`` (conv_id, turn, role, text).

    A node is a distinct sequence of first turns; its members are the conversations that start with it.
    Returns conv_id (smallest member, with ``depth`` the node's name), depth, parent_conv_id (null at the
    root), n_convs (members), n_children, n_leaves (childless nodes in its subtree, which includes it),
    saved_tokens (over its subtree, members but one times the words of a node's last text) and
    ends_sha256 (of the ids of members without further turns).

    Turns are ordered by ``turn``, null first, then role and text; repeated rows are turns each.  Null
    roles and texts count as empty, rows without conv_id are left out, other columns are ignored.
    Without conversations there is no root.
    """
    turns = written(numbered(written(turn_digests(conversations), "digests")), "turns")
    return trie(turns, turns.where("position = 0").select("conv_id"))
