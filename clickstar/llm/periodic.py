"""Periodic runs of words: suffix classes united by decreasing common prefix, as Kruskal unites trees.

A run is a stretch of consecutive words with a smallest period that no neighbouring word extends.
Its first word and the one a period later start suffixes whose common prefix is the run less one
period.  All suffixes with a common prefix that long form a class, and these two lie next to each
other in it: a place between them would give the run a smaller period.  So it is enough to unite the
classes of a document in the order of their common prefixes, longest first, and to look at the
places that become neighbours.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, text_bytes, word_blocks

# Words of short documents whose suffixes are sorted together.
BATCH_WORDS = 1 << 17
# Places in one block of an ordered set.
PLACES = 1_024

RUNS = "array<struct<start bigint, length bigint, period bigint>>"


def least_prefix(min_length: int, min_exponent: int) -> int:
    """Least common prefix of two suffixes a period apart in any run that counts."""
    return min(max((min_exponent - 1) * q, min_length - q, 1) for q in range(1, max(min_length, 1) + 1))


class Numbers(dict):
    """Words → numbers from 0 in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Places:
    """An ordered set of places in blocks, so that neither adding nor finding one moves them all."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, place: int):
        self.blocks, self.firsts, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def around(self, place: int) -> tuple[int, int]:
        """The places before and after one that is not in the set; -1 where there is none."""
        at = bisect_right(self.firsts, place) - 1
        if at < 0:
            return -1, self.firsts[0]
        block = self.blocks[at]
        i = bisect_left(block, place)
        if i < len(block):
            return block[i - 1], block[i]
        return block[-1], self.firsts[at + 1] if at + 1 < len(self.blocks) else -1

    def add(self, place: int) -> None:
        at = max(bisect_right(self.firsts, place) - 1, 0)
        block = self.blocks[at]
        insort(block, place)
        self.firsts[at] = block[0]
        self.size += 1
        if len(block) > 2 * PLACES:
            self.blocks[at : at + 1] = [block[:PLACES], block[PLACES:]]
            self.firsts[at : at + 1] = [block[0], block[PLACES]]

    def unite(self, other: Places) -> list[tuple[int, int]]:
        """Take in the places of a set that is not larger; pairs of both sets that are neighbours now."""
        met, last, gap = [], -1, None
        for place in other:
            before, after = self.around(place)
            if (before, after) != gap:
                # A new gap of this set: what stood last in the one before has its right neighbour there.
                if gap is not None and gap[1] >= 0:
                    met.append((last, gap[1]))
                if before >= 0:
                    met.append((before, place))
                gap = before, after
            last = place
        if gap[1] >= 0:
            met.append((last, gap[1]))
        for place in other:
            self.add(place)
        return met


def _repeated(words: np.ndarray, doc: np.ndarray, gram: int) -> np.ndarray:
    """Places whose next ``gram`` words occur elsewhere in their document; a place more by chance of
    the hash does no harm."""
    count = max(len(words) - gram + 1, 0)
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    key = doc[:count].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    for k in range(gram):
        key = key * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + count]
    places = np.flatnonzero(doc[:count] == doc[len(doc) - count :])
    order = places[np.argsort(key[places])]
    same = key[order[1:]] == key[order[:-1]]
    return np.sort(order[np.r_[False, same] | np.r_[same, False]] if len(order) else order)


def _suffix_order(
    words: np.ndarray, doc: np.ndarray, end: np.ndarray, repeated: np.ndarray, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places by document and suffix, the index at which each one's class of equal grams begins, and
    the rank of each place.

    Ranks are refined by doubling the words they stand for.  A place whose gram is unique in its
    document needs no more than its rank by this gram, and only if a repeated one lies a gram before.
    """
    after = repeated + gram
    places = np.union1d(repeated, after[after < end[repeated]])
    columns = [np.where(places + k < end[places], words[np.minimum(places + k, len(words) - 1)], -1) for k in range(gram)]
    by = np.lexsort([*columns[::-1], doc[places]])
    order = places[by]
    new = np.r_[True, doc[order[1:]] != doc[order[:-1]]]
    for column in columns:
        new[1:] |= column[by[1:]] != column[by[:-1]]
    index = np.arange(len(order))
    first = np.maximum.accumulate(np.where(new, index, 0))
    rank = np.full(len(words), -1, np.int64)
    rank[order] = first
    open_, width = index[~(new & np.r_[new[1:], True])], gram
    while len(open_):
        places = order[open_]
        major, beyond = rank[places], places + width
        # A suffix that ends comes before those that go on.
        minor = np.where(beyond < end[places], rank[np.minimum(beyond, len(words) - 1)], -1)
        by = np.lexsort((minor, major))
        places, major, minor = places[by], major[by], minor[by]
        order[open_] = places
        new_major = np.r_[True, major[1:] != major[:-1]]
        new = new_major | np.r_[True, minor[1:] != minor[:-1]]
        # Open places of a class are neighbours in the order, so its parts begin where they stand.
        index = np.arange(len(places))
        inside = index - np.maximum.accumulate(np.where(new_major, index, 0))
        rank[places] = major + inside[np.maximum.accumulate(np.where(new, index, 0))]
        open_ = open_[~(new & np.r_[new[1:], True])]
        width *= 2
    return order, first, rank


def _common_prefixes(
    words: list[int], ends: list[int], sorted_places: list[int], first: list[int], rank: np.ndarray, gram: int
) -> list[int]:
    """Words that each suffix shares with the one before it in its class, 0 for the first ones.

    A suffix shares at least all but one of the words that the suffix one place earlier shares.
    """
    shared = [0] * len(sorted_places)
    known, before = gram, -2
    for place in sorted(sorted_places):
        known = max(known - 1, gram) if place == before + 1 else gram
        before = place
        at = int(rank[place])
        if first[at] == at:
            known = gram
            continue
        other, end = sorted_places[at - 1], ends[at]
        stop = end - max(place, other)
        while known < stop and words[place + known] == words[other + known]:
            known += 1
        shared[at] = known
    return shared


def find_runs(words: np.ndarray, doc: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """(start, length, period) of every run, starts counted over all words.

    ``words`` are numbers of words, ``doc`` the ascending numbers of their documents.
    """
    gram = least_prefix(min_length, min_exponent)
    repeated = _repeated(words, doc, gram)
    if not len(repeated):
        return np.empty((0, 3), np.int64)
    begin_of, end_of = np.searchsorted(doc, doc, "left"), np.searchsorted(doc, doc, "right")
    order, first, rank = _suffix_order(words, doc, end_of, repeated, gram)
    starts, numbers, places = begin_of[order].tolist(), words.tolist(), order.tolist()
    shared = _common_prefixes(numbers, end_of[order].tolist(), places, first.tolist(), rank, gram)
    # Kruskal: each suffix and the one before it are an edge as long as their common prefix.
    root, sets = list(range(len(places))), [None] * len(places)
    runs = []
    for at in np.argsort(-np.array(shared), kind="stable").tolist():
        prefix = shared[at]
        if not prefix:
            break
        a, b = at - 1, at
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        one, two = sets[a] or Places(places[a]), sets[b] or Places(places[b])
        if one.size < two.size:
            a, b, one, two = b, a, two, one
        met = one.unite(two)
        root[b], sets[a], sets[b] = a, one, None
        begin = starts[at]
        for left, right in met:
            period = right - left
            if (
                prefix >= (min_exponent - 1) * period
                and prefix + period >= min_length
                and (left == begin or numbers[left - 1] != numbers[right - 1])
            ):
                runs.append((left, prefix + period, period))
    return np.array(sorted(runs), np.int64).reshape(-1, 3)


class _Batch:
    """Documents whose runs are found together."""

    def __init__(self, min_length: int, min_exponent: int):
        self.limits = min_length, min_exponent
        self.clear()

    def clear(self) -> None:
        self.ids, self.texts, self.words, self.known, self.size = [], [], [], Numbers(), 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        number = self.known.__getitem__
        parts = [np.fromiter(map(number, block), np.int64, len(block)) for block in word_blocks(text)]
        words = np.concatenate(parts) if parts else np.empty(0, np.int64)
        self.ids.append(doc_id)
        self.texts.append(text)
        self.words.append(words)
        self.size += len(words)

    def _kept(self, i: int, runs: np.ndarray, names: list[bytes]) -> bytes:
        words = self.words[i]
        if not len(runs):
            return b" ".join(b" ".join(block) for block in word_blocks(self.texts[i]) if block)
        edges = np.zeros(len(words) + 1, np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        kept = words[np.cumsum(edges[:-1]) == 0]
        step = BLOCK_BYTES // 8
        return b" ".join(
            b" ".join(map(names.__getitem__, kept[k : k + step].tolist())) for k in range(0, len(kept), step)
        )

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        counts = np.array([len(w) for w in self.words], np.int64)
        starts = np.cumsum(counts) - counts
        runs = find_runs(np.concatenate(self.words), np.repeat(np.arange(len(counts)), counts), *self.limits)
        cuts = np.r_[np.searchsorted(runs[:, 0], starts), len(runs)]
        names = list(self.known)
        kept = []
        for i, (a, b) in enumerate(pairwise(cuts.tolist())):
            runs[a:b, 0] -= starts[i]
            kept.append(self._kept(i, runs[a:b], names))
        structs = pa.StructArray.from_arrays(
            [pa.array(runs[:, k]) for k in range(3)], names=["start", "length", "period"]
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids, pa.int64()), pa.array(counts),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), structs), pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "kept"],
        )
        self.clear()


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, kept) of each row of ``docs`` (doc_id, text).

    Words stand between ASCII white space and are numbered from 0.  A run is a stretch of words with
    smallest period q, of at least ``min_length`` words and ``min_exponent`` (2 or more) periods,
    that no neighbouring word extends.  ``runs`` are ordered by start, then period.  ``kept`` joins
    by one space the words that no run contains after its first q words.  Null and empty texts have
    no words, no runs and an empty ``kept``.  Repeated rows and rows without doc_id are treated each
    on their own; other columns are ignored.
    """
    if min_exponent < 2:
        raise ValueError("a run has two periods at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = _Batch(min_length, min_exponent)
        for rows in batches:
            for doc_id, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                text = text.as_py()
                # Six bytes a word are usual; a long text is worked on alone.
                if batch.size and batch.size + len(text) // 6 > BATCH_WORDS:
                    yield from batch.rows()
                batch.add(doc_id, text)
            yield from batch.rows()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("t")).mapInArrow(
        run, f"doc_id bigint, n_words bigint, runs {RUNS}, kept string"
    )
