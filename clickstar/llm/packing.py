"""Packing of documents into fixed windows of tokens: concatenate, then cut."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import text_bytes, word_blocks, worker_store, written

WINDOW = 2048
END_ID = 1
# Rows that a task works on at a time, so that ids of few rows are in memory.
ROWS = 512
# Pieces and words whose ids a worker remembers.
REMEMBERED = 150_000

# Byte → the letter that stands for it in the file.
BYTE_LETTERS = {byte: letter for letter, byte in byte_letters().items()}

# Words of these characters are cut into pieces here: Unicode normalisation leaves them alone, and
# their classes can be listed.  The pattern is that of the vocabulary.
_LETTERS = "a-zªµºß-öø-ÿ"
_PLAIN = re.compile(r"[!-~ªµºÀ-ÖØ-öø-ÿ]+")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^0-9{_LETTERS}]+")
# Most words are ASCII letters, with such signs at most behind them: the letters are a piece, the signs another.
_SIGNS = b".,;:!?)\"'"


class Known(dict):
    """Packed ids of words, worked out when first met; about REMEMBERED to twice as many stay.

    When it is full, what it holds becomes ``before``, from which words that are met again move back.
    """

    def __init__(self, work_out: Callable):
        super().__init__()
        self.work_out, self.before = work_out, {}

    def __missing__(self, word):
        ids = self.before.get(word)
        if ids is None:
            ids = self.work_out(word)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class TextIds:
    """Ids of texts, packed in 16 or 32 bits, for tokenizers that drop white space, so that a text's
    ids are those of its words.

    Ids of words are remembered, and ids of their pieces; words with characters beyond Latin-1
    letters go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u4" if size > 1 << 16 else "<u2")
        # Each id in its bytes.
        self.packs = [np.array(i, self.kind).tobytes() for i in range(size)]
        self.pieces, self.words = Known(self._piece), Known(self._word)
        # Whether the pattern above is that of the file.
        self.known = True
        self.known = all(
            self._word(word.encode()) == self._library(word) for word in ("it's", "We'll", "Ärger12!?", "(x<y>&z)", "l'été--42_a_")
        )

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _library(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(BYTE_LETTERS)
        packs = self.packs
        made = [packs[token.id] for token in self.model.tokenize(letters)]
        return made[0] if len(made) == 1 else b"".join(made)

    def _word(self, word: bytes) -> bytes:
        head = word.rstrip(_SIGNS)
        if self.known and head.isalpha():
            ids = self.pieces[head.lower().decode()]
            return ids if len(head) == len(word) else ids + self.pieces[word[len(head) :].decode()]
        text = word.decode()
        if self.known and "<|" not in text and _PLAIN.fullmatch(text):
            pieces = _PIECES.findall(text.lower())
            return self.pieces[pieces[0]] if len(pieces) == 1 else b"".join([self.pieces[piece] for piece in pieces])
        return self._library(text)

    def of_text(self, text: bytes, end: int) -> bytes:
        ids_of = self.words.__getitem__
        if self.known and b"<|" not in text:
            # A-Z and a-z have the same ids, but for the names of special tokens.
            text = text.lower()
        return b"".join([*(b"".join(map(ids_of, words)) for words in word_blocks(text)), self._packed([end])])


def text_ids(path: str) -> TextIds:
    store = worker_store()
    if store.get("text_ids_path") != path:
        store["text_ids"], store["text_ids_path"] = TextIds(path), path
    return store["text_ids"]


def few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def tokens(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(part, at, doc_id, n, width, ids): ids of each row with ``end_id``, in 16 or 32 bits.

    ``part`` is the partition read and ``at`` the tokens before the row in it, so (part, at) is the
    order in which the rows are concatenated.  A partition that is read again gives the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, known = TaskContext.get().partitionId(), 0, text_ids(path)
        for batch in few_rows(batches):
            made = [known.of_text(t.as_py(), end_id) for t in batch.column(1)]
            width = known.kind.itemsize
            sizes = np.array([len(m) // width for m in made], np.int64)
            starts = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(made), part, np.int32)), pa.array(starts), batch.column(0), pa.array(sizes),
                    pa.array(np.full(len(made), width, np.int32)), pa.array(made, pa.binary()),
                ],
                names=["part", "at", "doc_id", "n", "width", "ids"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes().alias("t")).mapInArrow(
        run, "part int, at bigint, doc_id bigint, n bigint, width int, ids binary"
    )


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of ``window`` tokens.

    All documents are concatenated, each with ``end_id`` at its end, and cut every ``window``
    tokens, so only the last sequence is shorter.  Two passes: the tokens are written once with
    their offsets in the partition; the totals of the partitions, one row each, add up to the
    global offsets; then each row is cut where windows end, without a shuffle.

    One row per piece: doc_id, start (tokens of the document before it), length, ids (32-bit
    little-endian), doc_tokens, sequence_id, offset.  Null and empty texts are the end id alone.
    Repeated rows and rows without doc_id are documents of their own.  Other columns are ignored.
    An empty table has no pieces.
    """
    held = tokens(docs, path, end_id)
    scratch = written(held, "tokens")
    totals = scratch.groupBy("part").agg(F.max(F.col("at") + F.col("n")).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in few_rows(batches):
            rows, ids = [], []
            for doc, first, n, width, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = np.frombuffer(data, f"<u{width}").astype("<u4")
                done = 0
                while done < n:
                    sequence, offset = divmod(first + done, window)
                    length = min(window - offset, n - done)
                    rows.append((doc, done, length, n, sequence, offset))
                    ids.append(made[done : done + length].tobytes())
                    done += length
            doc, start, length, n, sequence, offset = zip(*rows, strict=True) if rows else ([],) * 6
            columns = [pa.array(c, pa.int64()) for c in (doc, start, length, n, sequence, offset)]
            columns.insert(3, pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # One row of 16 bytes per partition that was read, whatever is in it.
    return scratch.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("first"), "n", "width", "ids"
    ).mapInArrow(
        run, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    )


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, n_tokens, bounds, ids) from the pieces of :func:`pack`.

    ``bounds`` are the boundary records (offset, doc_id, start, length) in order; ``ids`` is filled
    up with ``pad_id`` to ``window``, except where the count of tokens is a power of two.  A
    sequence has at most ``window`` pieces.
    """
    part = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    joined = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), part.alias("p"))
    pad = F.when(F.bit_count("n_tokens") == 1, 0).otherwise(window - F.col("n_tokens")).cast("int")
    filler = F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), pad)
    return joined.select(
        "sequence_id", "n_tokens",
        F.expr("transform(p, x -> struct(x.offset AS offset, x.doc_id AS doc_id, x.start AS start, x.length AS length))").alias("bounds"),
        F.unhex(F.concat(F.expr("array_join(transform(p, x -> hex(x.ids)), '')"), filler)).alias("ids"),
    )
