"""SentencePiece encoding and decoding against the public library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from clickstar.llm import pieces, queries
from clickstar.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"
PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return pieces.Coder(PATH)


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def odd_texts(seed, count):
    rng = random.Random(seed)
    parts = [
        "a", "b", "e", "th", "in", " ", "  ", "    ", "\n", "\t", "\r", "▁", "▁▁", "é", "日", "本", "😀", "\x00", "​",
        "﻿", "<s>", "</s>", "<unk>", "<0x41>", ".", ",", "'s", "1", "23", "x" * 60, " " * 50, "́", "\U0010ffff", "{\r",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(count)]
    chars = lambda: chr(rng.choice([rng.randint(1, 127), rng.randint(128, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
    return texts + ["".join(chars() for _ in range(rng.randint(0, 60))) for _ in range(count // 3)]


def test_encode_like_the_library(library, coder):
    texts = odd_texts(1, 6_000)
    assert [numbers(i) for i in coder.encode(texts)] == library.encode(texts)


def test_decode_like_the_library(library, coder):
    rng = random.Random(2)
    odd = [0, 1, 2, 3, 35, 100, 130, 131, 200, 230, 259, 260, 264, 28705, 31999]
    for _ in range(5_000):
        ids = [rng.choice([*odd, rng.randrange(32_000)]) for _ in range(rng.randint(0, 8))]
        assert coder.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_long_words_and_blocks(library, monkeypatch):
    texts = ["x" * 30_000 + " " * 20_000 + "ab" * 9_000, "the  quick \n brown▁▁fox " * 500, " " * 3_000, "é" * 2_000]
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 100)
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    small = pieces.Coder(PATH)
    assert [numbers(i) for i in small.encode(texts)] == library.encode(texts)


def test_short_and_long_words_merge_alike(coder, monkeypatch):
    words = [w for text in odd_texts(3, 300) for w in text.replace(" ", "▁").split("\n")]
    assert [coder.model.pieces(w) for w in words] == [coder.model._pieces_of_long(w) for w in words]


def test_other_models_are_refused(tmp_path):
    for data in (b"", b"\x0a\x05\x0a\x03abc\x12\x02\x18\x01", b"\x12\x02\x18\x02\x1a\x02\x20\x01"):
        path = tmp_path / "other.model"
        path.write_bytes(data)
        with pytest.raises(ValueError, match="not a BPE model"):
            pieces.Model(str(path))


def test_odd_rows(spark, library, odd_docs, no_docs, odd_rows):
    encoded = pieces.encode(odd_docs, PATH)
    got = sorted(((r.doc_id, numbers(r.ids), r.text) for r in pieces.decode(encoded, PATH).collect()), key=str)
    ids = [(r[0], library.encode(r[1] or "")) for r in odd_rows]
    assert got == sorted(((i, x, library.decode(x)) for i, x in ids), key=str)
    assert sorted(map(str, pieces.encode(odd_docs, PATH, and_decode=True).collect())) == sorted(
        map(str, pieces.decode(encoded, PATH).collect())
    )
    assert pieces.encode(no_docs, PATH).collect() == []
    assert pieces.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), PATH).first().text is None


def test_query_against_the_library(spark, library):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in queries.REGISTRY["op13_sentencepiece"](spark, SF).collect()}
    want = {}
    for doc in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(doc.text or "")
        want[doc.doc_id] = len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))
    assert got == want
