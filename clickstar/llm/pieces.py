"""SentencePiece BPE: a text falls into marked words, each distinct one is segmented once.

No piece goes on after a white space marker that follows another character, so a marked word (markers
and what follows them) is segmented on its own.  The distinct words of a block of texts are a table;
its ids are joined back by the position of each word.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import Strings
from .common import Recent, worker_store

# The marker of white space, and how decoding writes an id of unknown text.
MARK, UNKNOWN_TEXT = "▁", " ⁇ "
# Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
# Characters that are cut into words at a time, rows whose ids a worker holds, words it remembers.
BLOCK_CHARS = 1 << 20
BATCH_ROWS = 1_000
REMEMBERED = 120_000
# Words of more characters merge through a heap.
SHORT = 48


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield number, data[at : at + size]
            at += size


class Model:
    """Pieces of a model file whose text is only marked, not changed otherwise, before it is segmented."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        trainer = {k: v for n, part in message if n == 2 for k, v in _fields(part)}
        marking = {k: v for n, part in message if n == 3 for k, v in _fields(part)}
        pieces = [dict(_fields(part)) for n, part in message if n == 1]
        kinds = [p.get(3, NORMAL) for p in pieces]
        names = [p.get(1, b"").decode() for p in pieces]
        scores = [np.frombuffer(p.get(2, b"\0\0\0\0"), "<f4")[0] for p in pieces]
        plain = not marking.get(2) and marking.get(3, 1) and not marking.get(4, 1) and marking.get(5, 1)
        if trainer.get(3) != 2 or not plain or trainer.get(24, 0) or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("not a BPE model that only marks white space")
        # Merges in order: the highest score first, and further left first among equal ones.
        order = {score: rank for rank, score in enumerate(sorted(set(scores), reverse=True))}
        self.id_of = {name: i for i, name in enumerate(names) if kinds[i] == NORMAL}
        self.rank = {name: order[scores[i]] for name, i in self.id_of.items()}
        self.bytes_of = {int(name[1:-1], 16): i for i, name in enumerate(names) if kinds[i] == BYTE}
        self.unknown = kinds.index(UNKNOWN)
        if any(re.search(f"[^{MARK}]{MARK}", name) for name in self.id_of):
            raise ValueError("a piece of this model goes on after a white space marker")
        text_of = {i: name.replace(MARK, " ").encode() for name, i in self.id_of.items()}
        text_of |= {i: bytes([byte]) for byte, i in self.bytes_of.items()} | {self.unknown: UNKNOWN_TEXT.encode()}
        self.text_of = Strings(text_of)
        # Pieces with a text, and those whose text begins with a marker.
        self.shown = np.array([kind != CONTROL for kind in kinds])
        self.marked = np.array([kind == NORMAL and name.startswith(MARK) for kind, name in zip(kinds, names, strict=True)])
        # Characters that join no other one are words of their own: control characters in the main.
        joining = {c for name in self.id_of if len(name) > 1 for c in name}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in joining and chr(c) != " ")
        self.words = re.compile(f" +[^ {alone}]*|[^ {alone}]+|[{alone}]" if alone else " +[^ ]*|[^ ]+")

    def pieces(self, word: str) -> list[str]:
        """The pieces of a marked word: the best pair is merged as long as there is one."""
        if len(word) > SHORT:
            return self._pieces_of_long(word)
        rank, parts = self.rank.get, list(word)
        none = len(self.rank)
        ranks = [rank(a + b, none) for a, b in pairwise(parts)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], none)
        return parts

    def _pieces_of_long(self, word: str) -> list[str]:
        """The same in a time that grows little more than the word."""
        rank, parts = self.rank.get, list(word)
        right, left = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        found = []
        for i, (a, b) in enumerate(pairwise(parts)):
            if (best := rank(a + b)) is not None:
                found.append((best, i, a + b))
        heapq.heapify(found)
        while found:
            _, i, name = heapq.heappop(found)
            j = right[i]
            # Either part may have been merged with another one since.
            if not parts[i] or j >= len(parts) or parts[i] + parts[j] != name:
                continue
            parts[i], parts[j], right[i] = name, "", right[j]
            if right[j] < len(parts):
                left[right[j]] = i
                if (best := rank(name + parts[right[j]])) is not None:
                    heapq.heappush(found, (best, i, name + parts[right[j]]))
            if (k := left[i]) >= 0 and (best := rank(parts[k] + name)) is not None:
                heapq.heappush(found, (best, k, parts[k] + name))
        return [p for p in parts if p]

    def ids(self, word: str) -> list[int]:
        made, id_of = [], self.id_of.get
        for part in self.pieces(word.replace(" ", MARK)):
            known = id_of(part)
            if known is not None:
                made.append(known)
            elif self.bytes_of:
                made.extend(map(self.bytes_of.__getitem__, part.encode("utf-8", "replace")))
            elif not made or made[-1] != self.unknown:
                made.append(self.unknown)
        return made


def _each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    """U+FFFD for every byte that is not UTF-8."""
    return "�" * (error.end - error.start), error.end


class Coder:
    """Encodes and decodes texts, remembering the ids of words between calls."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.known = Recent(REMEMBERED)
        codecs.register_error("clickstar_each_byte", _each_byte)

    def _work_out(self, words: set[str]) -> Iterator[tuple[str, bytes]]:
        for word in words:
            yield word, np.array(self.model.ids(word), "<u4").tobytes()

    def blocks(self, text: str) -> Iterator[str]:
        """A marked text in blocks that begin with a marker after another character."""
        # A marker in the text itself is no other than a space, and a text begins with one more.
        text = " " + text.replace(MARK, " ") if text else ""
        start = 0
        while len(text) - start > BLOCK_CHARS:
            cut = text.find(" ", start + BLOCK_CHARS)
            while cut > 0 and text[cut - 1] == " ":
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[start:cut]
            start = cut
        yield text[start:] if start else text

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text, in order, as 32-bit little-endian."""
        waiting, size = [], 0
        for text in texts:
            if len(text) > BLOCK_CHARS:
                yield from self._finish(waiting)
                waiting, size = [], 0
                yield b"".join(next(self._finish([block])) for block in self.blocks(text))
                continue
            waiting.extend(self.blocks(text))
            size += len(text)
            if size > BLOCK_CHARS:
                yield from self._finish(waiting)
                waiting, size = [], 0
        yield from self._finish(waiting)

    def _finish(self, blocks: list[str]) -> Iterator[bytes]:
        """Ids of each block: the distinct words are segmented together, then joined by position."""
        words = list(map(self.model.words.findall, blocks))
        ids_of = self.known.learn(set().union(*words), self._work_out)
        for block in words:
            yield b"".join(map(ids_of, block))

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4")
        shown = self.model.shown[numbers]
        # Bytes on both sides of a piece without text are no character together.
        parts = [numbers] if shown.all() else np.split(numbers, np.flatnonzero(~shown))
        texts = [self.model.text_of.join(part) for part in parts]
        first = numbers[shown][:1]
        if len(first) and self.model.marked[first[0]]:
            at = next(i for i, text in enumerate(texts) if text)
            texts[at] = texts[at][1:]
        return "".join(text.decode("utf-8", "clickstar_each_byte") for text in texts)


def coder(path: str) -> Coder:
    store = worker_store()
    if store.get("pieces_path") != path:
        store["pieces"], store["pieces_path"] = Coder(path), path
    return store["pieces"]


def encode(docs: DataFrame, path: str, and_decode: bool = False) -> DataFrame:
    """(doc_id, ids) of each row of ``docs`` (doc_id, text); ids are 32-bit little-endian.

    ``path`` names a SentencePiece model: BPE, with white space marked and text not changed otherwise;
    another model is refused.  No begin or end is added; names of control pieces in a text are text.
    ``and_decode`` adds ``text`` as :func:`decode` does, by the same Python workers.  Null and empty
    texts have no ids.  Repeated rows are encoded alike; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(path)
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(i, BATCH_ROWS)
                ids = list(known.encode(batch.column(1).to_pylist()))
                columns = [batch.column(0), pa.array(ids, pa.binary())]
                if and_decode:
                    columns.append(pa.array(map(known.decode, ids), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][: len(columns)])

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("t")
    ).mapInArrow(run, "doc_id bigint, ids binary" + (", text string" if and_decode else ""))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``text``: the text of the ids, without the marker it begins with.

    Control pieces have no text; every byte that is not UTF-8 becomes U+FFFD.  Null ids give null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = coder(path)
        for batch in batches:
            made = [None if i is None else known.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")
