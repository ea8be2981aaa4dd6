"""The prefix trie against one built of whole sequences in plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from clickstar.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, k1 string, first int, weight int"


def sequences(rows):
    """Ordered (role, text) of every conversation."""
    turns = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[conv_id].append((turn is not None, turn or 0, role, text[:64], digest, text))
    return {c: [(t[2], t[5]) for t in sorted(t)] for c, t in turns.items()}


def borrowed(convs):
    out = {}
    for c, own in convs.items():
        h = (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    words = lambda node: len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
    out = []
    for node, of in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        ends = ",".join(str(c) for c in sorted(of) if len(convs[c]) == len(node))
        out.append((
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children), len(leaves),
            sum((len(members[n]) - 1) * words(n) for n in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def random_rows(seed, convs=60):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-45, 400), convs):
        for _ in range(rng.choice([1, 1, 2, 3, 4, 7])):
            turn = rng.choice([None, 0, 1, 1, 2, 3, 4, 5, 6])
            text = rng.choice([None, "", "a b", "a b", "x", " \t ", "é  ü\nz", "w " * 40 + "one", "w " * 40 + "two"])
            rows.append((c, turn, rng.choice([None, "user", "assistant"]), text))
    # One conversation with many turns, rows of no conversation, repeated rows.
    rows += [(400, i, "user", f"turn {i % 3}") for i in range(50)] + [(None, 1, "user", "lost"), rows[0], rows[0]]
    rows += [(c, i, "user", f"turn {i % 3}") for c in (420, 440) for i in range(50 - c % 7)]
    return [(*r, n, f"k{n}", n, None) for n, r in enumerate(rows)]


@pytest.mark.parametrize("seed,chunk", [(1, 1_024), (2, 4)])
def test_against_whole_sequences(spark, monkeypatch, tmp_path, seed, chunk):
    monkeypatch.setattr(trie, "CHUNK", chunk)
    monkeypatch.setattr(trie, "PART_BITS", 3)
    rows = random_rows(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted((tuple(r) for r in trie.prefix_trie(frame).collect()), key=str) == brute(sequences(rows))
    # The query, with borrowed openings, against Python and against its SQL.
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.REGISTRY["op12_prefix_trie"](spark, str(tmp_path))
    want = brute(borrowed(sequences(rows)))
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    database = duckdb.connect()
    database.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(database.execute(queries.ORACLE["op12_prefix_trie"]).fetchall(), key=str) == want


def test_empty_and_single(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(none).collect() == []
    assert queries.rebuilt(trie.numbered(trie.turn_digests(none))).collect() == []
    one = spark.createDataFrame([(7, None, None, None, 1, "", 1, 1)], SCHEMA)
    assert sorted(tuple(r)[:7] for r in trie.prefix_trie(one).collect()) == [(7, 0, None, 1, 1, 1, 0), (7, 1, 7, 1, 0, 1, 0)]


def test_one_sequence_of_many_conversations(spark):
    """A hot sequence: its id list is hashed in parts, in numerical order."""
    rows = [(c, t, "user", "same words here") for c in range(0, 30_000, 10) for t in range(2)]
    nodes = trie.prefix_trie(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    ids = ",".join(str(c) for c in range(0, 30_000, 10))
    assert sorted((r.depth, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens) for r in nodes) == [
        (0, 3_000, 1, 1, 2_999 * 6), (1, 3_000, 1, 1, 2_999 * 6), (2, 3_000, 0, 1, 2_999 * 3)
    ]
    assert hashlib.sha256(ids.encode()).hexdigest() in {r.ends_sha256 for r in nodes if r.depth == 2}


def test_a_text_of_a_million_words(spark):
    long = "word " * 1_000_000
    rows = [(1, 0, "user", long), (2, 0, "user", long), (2, 1, "user", long + "x"), (3, 0, "user", long + "x")]
    nodes = trie.prefix_trie(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).collect()
    assert sorted((r.conv_id, r.depth, r.n_convs, r.saved_tokens) for r in nodes) == [
        (1, 0, 3, 1_000_000), (1, 1, 2, 1_000_000), (2, 2, 1, 0), (3, 1, 1, 0)
    ]
