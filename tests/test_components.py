import random

import numpy as np
import pytest

from strataform.operators.components import connected_components, least_labels

ZIGZAG = [i // 2 if i % 2 else 999 - i // 2 for i in range(500)]
SHAPES = {
    "star, centre last": [(i, 500) for i in range(500)],
    "star, centre first": [(0, i) for i in range(1, 500)],
    "path": [(i, i + 1) for i in range(400)],
    "zigzag path": list(zip(ZIGZAG, ZIGZAG[1:], strict=False)),
    "caterpillar": [(1000 + i, 1001 + i) for i in range(60)] + [(1000 + i, i * 10 + j) for i in range(60) for j in range(5)],
    "hubs above their leaves": [(9000 + h, h * 7 + j) for h in range(40) for j in range(9)],
    "cliques": [(c * 20 + i, c * 20 + j) for c in range(9) for i in range(12) for j in range(i)],
}


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes(spark, shape):
    edges = SHAPES[shape]
    rounds = []
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.id: r.group_id for r in connected_components(frame, finish_edges=0, rounds=rounds).collect()}
    assert got == brute(edges)
    # Few rounds whatever the order of the ids.
    assert len(rounds) <= 6 and all(b < a for a, b in zip(rounds, rounds[1:], strict=False))
    assert {r.id: r.group_id for r in connected_components(frame).collect()} == got


def test_nulls_repeats_and_strings(spark):
    rng = random.Random(4)
    edges = [(rng.choice("abcdefghijklm") + str(rng.randrange(9)), rng.choice("abcdefghijklm") + str(rng.randrange(9))) for _ in range(60)]
    edges += edges[:9] + [(b, a) for a, b in edges[:9]] + [(None, "a1"), ("a1", None), ("z", "z"), (None, None)]
    frame = spark.createDataFrame(edges, "u string, v string")
    assert {r.id: r.group_id for r in connected_components(frame).collect()} == brute(edges)
    assert {r.id: r.group_id for r in connected_components(frame, finish_edges=5).collect()} == brute(edges)
    assert connected_components(frame.limit(0)).count() == 0


def test_hot_labels(spark, monkeypatch):
    # All joins by shuffle, hot keys apart.
    from strataform.operators import components

    monkeypatch.setattr(components, "BROADCAST_LIMIT_BYTES", 0)
    edges = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r.id: r.group_id for r in connected_components(spark.createDataFrame(edges, "u long, v long"), finish_edges=0).collect()}
    assert got == brute(edges)


def test_dense_groups_need_no_rounds(spark):
    # Far more edges than one task may take, on few nodes: what joins the nodes is few.
    edges = [(c * 1000 + i, c * 1000 + j) for c in range(5) for i in range(60) for j in range(i)]
    rounds = []
    frame = spark.createDataFrame(edges, "u long, v long")
    got = {r.id: r.group_id for r in connected_components(frame, finish_edges=2000, rounds=rounds).collect()}
    assert got == brute(edges) and rounds == []


def test_least_labels():
    rng = np.random.default_rng(2)
    u, v = rng.integers(0, 300, 250), rng.integers(0, 300, 250)
    want = brute(list(zip(u.tolist(), v.tolist(), strict=True)))
    assert all(least_labels(u, v, 300)[x] == r for x, r in want.items())
