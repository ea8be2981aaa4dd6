"""Near-duplicate vectors: Euclidean p-stable hashing into several tables, then exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .graph import components

LEAST_COSINE = 0.9
# Share of the pairs at exactly the least cosine that the tables are to find; nearer ones are found
# more often.
RECALL = 0.97
# Width of the quantisation, and vectors that share a bucket by chance on average.
WIDTH = 2.0
CHANCE = 64
# Vectors of a bucket that are compared in one block.
BLOCK = 512
_SEED = 20_240_229


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Chance that one quantised Gaussian projection agrees for two points at this distance."""
    r = width / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int, least_cosine: float = LEAST_COSINE, recall: float = RECALL) -> tuple[int, int]:
    """(projections per table, tables) for this number of vectors.

    Buckets hold about CHANCE orthogonal vectors; the tables then follow from the recall.
    """
    near, far = same_cell(math.sqrt(2 - 2 * least_cosine)), same_cell(math.sqrt(2))
    per_table = max(4, math.ceil(math.log(max(rows, 2) / CHANCE) / -math.log(far)))
    return per_table, math.ceil(math.log(1 - recall) / math.log(1 - near**per_table))


def table_keys(unit: np.ndarray, per_table: int, tables: int) -> np.ndarray:
    """Bucket of each vector (rows) in each table, as 64-bit hashes of the quantised projections."""
    rng = np.random.default_rng([_SEED, unit.shape[1]])
    directions = rng.normal(size=(unit.shape[1], tables * per_table))
    shifts = rng.uniform(0, WIDTH, tables * per_table)
    cells = np.floor((unit @ directions + shifts) / WIDTH).astype(np.int64).view(np.uint64)
    keys = np.full((len(unit), tables), unit.shape[1], np.uint64)
    for i in range(per_table):
        keys = (keys ^ cells[:, i::per_table]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def _unpack(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, digest, unit): digest of the components and the normalised vector, both null where
    the vector can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            digests, units = [], []
            for vector in batch.column(1).to_pylist():
                unit = None
                if vector and None not in vector:
                    v = np.array(vector, np.float64)
                    top = np.abs(v).max()
                    if np.isfinite(top) and top > 0:
                        # Scaled first, so that squares neither overflow nor vanish.
                        unit = v / top
                        unit /= math.sqrt(float(unit @ unit))
                digests.append(None if unit is None else hashlib.md5(v.tobytes()).digest())
                units.append(None if unit is None else unit.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.array(units, pa.binary())], names=["vec_id", "digest", "unit"]
            )

    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(
        run, "vec_id bigint, digest binary, unit binary"
    )


def _in_tables(classes: DataFrame, per_table: int, tables: int) -> DataFrame:
    """(bucket_table, bucket, rep, size, unit, keys): each vector once per table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket_table", "bucket", "rep", "size", "unit", "keys"]
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                units = batch.column(2).to_pylist()
                keys = np.empty((len(units), tables), np.int64)
                # Vectors of different lengths have buckets of their own.
                lengths = np.array([len(u) for u in units])
                for length in np.unique(lengths):
                    at = np.flatnonzero(lengths == length)
                    keys[at] = table_keys(_unpack([units[j] for j in at]), per_table, tables)
                packed = pa.array([k.tobytes() for k in keys], pa.binary())
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(units), t, np.int32)), pa.array(np.ascontiguousarray(keys[:, t])), batch.column(0),
                         batch.column(1), batch.column(2), packed], names=names,
                    )

    return classes.select("rep", "size", "unit").mapInArrow(
        run, "bucket_table int, bucket bigint, rep bigint, size bigint, unit binary, keys binary"
    )


def spanning(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect what the symmetric matrix connects, at most one per row."""
    seen = np.zeros(len(linked), bool)
    for root in np.flatnonzero(linked.any(axis=1)):
        if seen[root]:
            continue
        seen[root] = True
        frontier = np.array([root])
        while len(frontier):
            reached = linked[frontier].any(axis=0) & ~seen
            seen |= reached
            frontier = np.flatnonzero(reached)
            for member in frontier:
                yield int(root), int(member)


def compare(table: int, left: int, right: int, block: np.ndarray, units: np.ndarray, keys: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of the rows link here: cosine of ``least`` or more, and no earlier table where
    they share a bucket, so that a pair counts once."""
    linked = units @ units.T >= least
    if left == right:
        np.fill_diagonal(linked, False)
    else:
        linked &= block[:, None] != block[None, :]
    if linked.any():
        for earlier in range(table):
            linked &= keys[:, earlier, None] != keys[None, :, earlier]
    return linked


def _links(tiles: DataFrame, tables: int, least: float) -> DataFrame:
    """(a, b, n): edges that connect linked vectors (n is null), and links per vector (b is null).

    ``tiles`` come sorted, a tile (two blocks of a bucket) after the other.
    """

    def of_tile(tile: tuple, rows: list) -> tuple[list, list, list]:
        a, b, n = [], [], []
        units, keys = _unpack([r[2] for r in rows]), np.frombuffer(b"".join(r[3] for r in rows), np.int64).reshape(len(rows), -1)
        linked = compare(tile[0], tile[2], tile[3], np.array([r[4] for r in rows]), units, keys, least)
        if linked.any():
            counts = linked @ np.array([r[1] for r in rows], np.int64)
            for i in np.flatnonzero(counts):
                a.append(rows[i][0])
                b.append(None)
                n.append(int(counts[i]))
            for i, j in spanning(linked):
                a.append(rows[i][0])
                b.append(rows[j][0])
                n.append(None)
        return a, b, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for t, bucket, left, right, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tile = (t, bucket, left, right)
                if tile != now:
                    if len(rows) > 1:
                        for column, more in zip(out, of_tile(now, rows), strict=True):
                            column.extend(more)
                    now, rows = tile, []
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b", "n"])
        if len(rows) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in of_tile(now, rows)], names=["a", "b", "n"])

    return tiles.mapInArrow(run, "a bigint, b bigint, n bigint")


def embedding_groups(rows: DataFrame, least_cosine: float = LEAST_COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``rows`` (vec_id, embedding).

    Two vectors link if their cosine in double precision is ``least_cosine`` or more.  Equal vectors
    are one class, compared through its smallest vec_id; a link between classes counts for each
    member.  Classes that share a bucket in one of the tables are compared, in blocks of bounded
    size where a bucket is large, so every pair in a bucket is, and no pair is written out:
    a block gives the counts of its rows and edges that connect them.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing;
    vectors of different lengths neither.  Rows without vec_id are not compared: no links, no
    component, kept.  Rows that repeat a vec_id and vector are members of their class.  Other
    columns are ignored.  An empty table gives an empty one.
    """
    known = written(vectors(rows), "vectors")
    usable = known.where("digest IS NOT NULL AND vec_id IS NOT NULL")
    classes = written(
        usable.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.any_value("unit").alias("unit")),
        "classes",
    )
    # A vec_id may stand for several vectors; each class is a node of its own until the end.
    nodes = written(classes.withColumn("node", F.xxhash64("digest")), "nodes")
    per_table, tables = plan(classes.count(), least_cosine, recall)
    placed = _in_tables(nodes.select(F.col("node").alias("rep"), "size", "unit"), per_table, tables)
    sizes = written(
        placed.groupBy("bucket_table", "bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "buckets"
    )
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    tiles = placed.join(sizes.hint("merge"), ["bucket_table", "bucket"]).withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64(F.lit("block"), "rep"), F.col("blocks")).cast("int")
    ).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket_table", "bucket", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        "rep", "size", "unit", "keys", "block",
    )
    tile = ["bucket_table", "bucket", "left", "right"]
    found = written(_links(tiles.repartition(*tile).sortWithinPartitions(*tile), tables, least_cosine), "links")
    roots = components(found.where("b IS NOT NULL").select("a", "b"))
    counts = found.where("n IS NOT NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    joined = written(
        nodes.select("digest", "node", "rep", "size").join(counts, "node", "left").join(roots, "node", "left")
        .select("digest", "rep", "size", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("root", "node").alias("root")), "joined",
    )
    least = joined.groupBy("root").agg(F.min("rep").alias("least_id"))
    by_class = written(
        joined.join(least, "root").select("digest", (F.col("n") + F.col("size") - 1).alias("links"), "least_id"), "by_class"
    )
    none = known.where("digest IS NULL OR vec_id IS NULL").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return usable.select("vec_id", "digest").join(by_class, "digest").select(
        "vec_id", F.col("links").alias("n_links"), F.col("least_id").alias("component_id"),
        (F.col("vec_id") == F.col("least_id")).alias("kept"),
    ).unionByName(none)
