"""Embedding groups against brute force."""

import math

import numpy as np
import pytest
from clickstar.llm import embedding


def brute(rows):
    """(vec_id, links, component) of rows whose ids are distinct."""
    unit = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, float) / np.abs(v).max()
            unit[i] = x / np.linalg.norm(x)
    linked = {i: [j for j in unit if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in unit}
    out = {}
    for i, _ in rows:
        reach, todo = {i}, [i]
        while todo:
            for j in linked.get(todo.pop(), ()):
                if j not in reach:
                    reach.add(j)
                    todo.append(j)
        out[i] = (len(linked.get(i, ())), None if i is None else min(reach))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    out = []
    for size in (1, 1, 1, 2, 5, 30, 60):
        centre = rng.normal(size=32)
        out += [(centre + rng.normal(size=32) * rng.choice([0.02, 0.1, 0.25])).tolist() for _ in range(size)]
    out += [out[-1]] * 40 + [[2 * x for x in out[-1]]] + [rng.normal(size=32).tolist() for _ in range(150)]
    out += [None, [], [0.0] * 32, [math.nan] * 32, [math.inf] + [1.0] * 31, [None] + [1.0] * 31, [1e-200] * 32, [1e200] * 32, [1.0, 2.0], [2.0, 4.0]]
    order = rng.permutation(len(out))
    return [(int(i) * 3, out[k]) for i, k in enumerate(order)] + [(None, out[0])]


@pytest.mark.parametrize("block", [512, 16])
def test_groups(spark, rows, monkeypatch, block):
    monkeypatch.setattr(embedding, "BLOCK", block)
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, label int, digest int").repartition(3)
    want = brute(rows)
    got = {r.vec_id: r for r in embedding.embedding_groups(table, recall=0.9999).collect()}
    assert len(got) == len(rows)
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())
    # With the usual recall no link is invented, and at least nine tenths are found.
    usual = embedding.embedding_groups(table).collect()
    assert all(r.n_links <= want[r.vec_id][0] for r in usual)
    assert sum(r.n_links for r in usual) >= 0.9 * sum(n for n, _ in want.values())
    assert embedding.embedding_groups(table.where("false")).count() == 0


def test_plan_reaches_its_recall():
    for rows in (100, 10**6):
        per_table, tables = embedding.plan(rows)
        rng = np.random.default_rng(rows)
        a = rng.normal(size=(400, 48))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b = rng.normal(size=a.shape)
        b -= (a * b).sum(axis=1, keepdims=True) * a
        b /= np.linalg.norm(b, axis=1, keepdims=True)
        both = embedding.table_keys(np.concatenate((a, 0.9 * a + math.sqrt(1 - 0.81) * b)), per_table, tables)
        assert (both[:400] == both[400:]).any(axis=1).mean() >= 0.93
