"""Byte-level BPE: distinct words are encoded by one depth-first walk of their trie; decoding."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, worker_store

# Characters that are cut into words at a time, and words whose ids a worker remembers.
BLOCK_CHARS = 1 << 20
# Rows whose ids a worker holds at a time.
BATCH_ROWS = 1_000
REMEMBERED = 120_000

# How a text falls into words: the fixed pattern of this vocabulary, and the same for texts of ASCII
# and Latin-1 letters only, where the classes can be listed.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_LATIN = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_BLANK = r"\t-\r "
_LATIN_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^{_BLANK}{_LATIN}0-9]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
_NOT_LATIN = re.compile(rf"[^\t-\r -~{_LATIN}]")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in files of this kind → the byte.

    Printable Latin-1 characters stand for themselves, the other bytes in order for U+0100 onwards.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Strings:
    """Byte strings by number, joined without a step per string."""

    def __init__(self, by_number: dict[int, bytes]):
        count = max(by_number, default=-1) + 1
        parts = [by_number.get(i, b"") for i in range(count)]
        self.sizes = np.fromiter(map(len, parts), np.int64, count)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def join(self, numbers: np.ndarray) -> bytes:
        out = []
        for i in range(0, len(numbers), 1 << 18):
            part = numbers[i : i + (1 << 18)]
            sizes = self.sizes[part]
            shift = self.starts[part] - (np.cumsum(sizes) - sizes)
            out.append(self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))].tobytes())
        return b"".join(out)


class Vocabulary:
    """Tokens and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        letters, model = byte_letters(), data["model"]
        as_bytes = lambda name: bytes(map(letters.__getitem__, name))
        self.bytes_of = {i: as_bytes(name) for name, i in model["vocab"].items()}
        self.size_of = {i: len(b) for i, b in self.bytes_of.items()}
        ids = {b: i for i, b in self.bytes_of.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # Rank of the merge of two tokens, and the merge that makes a token.
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(pairs):
            left, right = ids[as_bytes(left)], ids[as_bytes(right)]
            self.rank[left, right] = rank
            self.parts.setdefault(ids[self.bytes_of[left] + self.bytes_of[right]], (left, right))
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
        self.text_of = Strings(self.bytes_of | {i: text.encode() for text, i in self.special.items()})
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        # The tokens read from their last byte on, as a trie: (node, byte) → node, node → token.
        self.back: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for token, i in ids.items():
            node = 0
            for byte in reversed(token):
                key = node << 8 | byte
                node = self.back.get(key, 0)
                if not node:
                    node = self.back[key] = len(self.ends)
                    self.ends.append(-1)
            self.ends[node] = i
        self._edges: dict[tuple[int, bool], list[tuple[int, float]]] = {}
        self._whole: dict[int, bool] = {}
        self._meet: dict[int, bool] = {}

    def edge(self, token: int, right: bool) -> list[tuple[int, float]]:
        """What stands at the right (or left) end of ``token`` while it is built, from its last (or
        first) byte on, each with the rank of the merge that ends its time there."""
        known = self._edges.get((token, right))
        if known is None:
            chain_, up = [], float("inf")
            while True:
                chain_.append((token, up))
                if token not in self.parts:
                    break
                pair = self.parts[token]
                token, up = pair[right], self.rank[pair]
            known = self._edges[chain_[0][0], right] = chain_[::-1]
        return known

    def apart(self, left: int, right: int, limit: float = float("inf")) -> bool:
        """Whether no merge below ``limit`` ever joins two tokens that stand side by side."""
        a, b, i, j = self.edge(left, True), self.edge(right, False), 0, 0
        while True:
            (x, x_up), (y, y_up) = a[i], b[j]
            rank = self.rank.get((x, y), limit)
            # Equal ranks are the same pair; the one further left is merged first.
            if rank < limit and rank < x_up and rank <= y_up:
                return False
            if x_up == y_up == float("inf"):
                return True
            if x_up <= y_up:
                i += 1
            else:
                j += 1

    def whole(self, token: int) -> bool:
        """Whether the bytes of a token are encoded as this token alone."""
        known = self._whole.get(token)
        if known is None:
            pair = self.parts.get(token)
            known = pair is None or (
                self.whole(pair[0]) and self.whole(pair[1]) and self.apart(*pair, limit=self.rank[pair])
            )
            self._whole[token] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether ``right`` can come next after ``left`` in an encoding; remembered."""
        if len(self._meet) >= 4 * REMEMBERED:
            self._meet.clear()
        fits = self._meet[left << 32 | right] = self.whole(right) and self.apart(left, right)
        return fits

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Ids of distinct words.

        Sorted words are the trie in depth-first order: the stack holds the last token of each
        prefix on the way to the current word, and words with a common prefix share its states.
        The tokens before the last one are the encoding of the bytes before it, so the last token of
        a prefix is the one that ends there and stays apart from the last token of what precedes it.
        """
        path, last = b"", [-1]
        size_of, back, ends, meet = self.size_of, self.back.get, self.ends, self._meet.get
        for word in sorted(words):
            shared = 0
            for x, y in zip(path, word, strict=False):
                if x != y:
                    break
                shared += 1
            # The words are distinct and sorted, so this word goes on beyond what it shares.
            del last[shared + 1 :]
            for depth in range(shared + 1, len(word) + 1):
                # The tokens that end here, and where they begin, the shortest first.
                found, node, at = [], 0, depth
                while at:
                    at -= 1
                    node = back(node << 8 | word[at])
                    if node is None:
                        break
                    if ends[node] >= 0:
                        found.append((ends[node], at))
                while True:
                    token, at = found.pop()
                    if at:
                        left = last[at]
                        fits = meet(left << 32 | token)
                        if fits is None:
                            fits = self.follows(left, token)
                    else:
                        fits = self.whole(token)
                    if fits:
                        last.append(token)
                        break
            made, depth = [], len(word)
            while depth:
                token = last[depth]
                made.append(token)
                depth -= size_of[token]
            path = word
            made.reverse()
            yield word, made


class Encoder:
    """Encodes texts, remembering the ids of words between calls."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.words = Recent(REMEMBERED)

    def _work_out(self, words: set[str]) -> Iterator[tuple[str, bytes]]:
        """Packed ids of words; those that are new go through the trie together."""
        text_of = {w.encode("utf-8", "replace"): w for w in words}
        for word, ids in self.vocabulary.encode_words(text_of):
            yield text_of[word], pack("<%dI" % len(ids), *ids)

    def blocks(self, text: str) -> Iterator[list[str] | int]:
        """The words of a text, a bounded number at a time, and the ids of special tokens."""
        at = 0
        for found in chain(self.vocabulary.split_special.finditer(text), (None,)):
            yield from self._plain(text[at : found.start()] if found else text[at:] if at else text)
            if found:
                yield self.vocabulary.special[found[0]]
                at = found.end()

    def _plain(self, text: str) -> Iterator[list[str]]:
        words = _WORDS if _NOT_LATIN.search(text) else _LATIN_WORDS
        start = 0
        while len(text) - start > BLOCK_CHARS and (cut := _CUT.search(text, start + BLOCK_CHARS)):
            yield words.findall(text[start : cut.start()])
            start = cut.start()
        yield words.findall(text[start:] if start else text)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, in order, as 32-bit little-endian."""
        waiting: list[list] = []
        size = 0
        for text in texts:
            if len(text) > BLOCK_CHARS:
                yield from self._finish(waiting)
                waiting, size = [], 0
                yield b"".join(next(self._finish([[block]])) for block in self.blocks(text))
                continue
            waiting.append(list(self.blocks(text)))
            size += len(text)
            if size > BLOCK_CHARS:
                yield from self._finish(waiting)
                waiting, size = [], 0
        yield from self._finish(waiting)

    def _finish(self, texts: list[list]) -> Iterator[bytes]:
        met: set[str] = set()
        for block in chain.from_iterable(texts):
            if not isinstance(block, int):
                met.update(block)
        ids_of = self.words.learn(met, self._work_out)
        for blocks in texts:
            yield b"".join(
                pack("<I", block) if isinstance(block, int) else b"".join(map(ids_of, block)) for block in blocks
            )

    def decode(self, ids: bytes) -> str:
        return self.vocabulary.text_of.join(np.frombuffer(ids, "<u4")).decode("utf-8", "replace")


def decimals(count: int) -> Strings:
    """The numbers below ``count`` in decimal, each with a comma."""
    return Strings({i: f"{i},".encode() for i in range(count)})


def encoder(path: str) -> Encoder:
    store = worker_store()
    if store.get("bpe_path") != path:
        store["bpe"], store["bpe_path"] = Encoder(path), path
    return store["bpe"]


def encode(docs: DataFrame, path: str, and_decode: bool = False) -> DataFrame:
    """(doc_id, ids) of each row of ``docs`` (doc_id, text); ids are 32-bit little-endian.

    ``and_decode`` adds ``text`` as :func:`decode` does, by the same Python workers.

    ``path`` names a tokenizer file with a byte-level BPE.  Strings of its special tokens in a text
    become these tokens; nothing is added, cut off or filled up.  Null and empty texts have no ids.
    Repeated rows are encoded alike; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
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
    """``encoded`` (doc_id, ids) with ``text``: the text of the ids, special tokens included.

    Bytes that are not UTF-8 become U+FFFD.  Null ids give null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            made = [None if i is None else known.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")
