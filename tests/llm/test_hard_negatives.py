"""Hard negatives against a plain search, spanning trees, bounds and edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tijara.llm import hard_negatives as hn

VECTORS = "vec_id bigint, embedding array<float>, label int, score string, row int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "clash", 1) for i, v, x in rows], VECTORS)


def plain(rows, step=50):
    """The contract, row by row, over (vec_id, vector, label)."""
    best: dict = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        key = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        best[i] = min(best.get(i, key), key)
    out = []
    for a, (label, q) in best.items():
        if a % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, other) for i, (other, p) in best.items() if i != a)
        for s, i, _ in [r for r in scored if r[2] == label][:5]:
            window = [r for r in scored if r[2] != label and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a, i, k, j, -s, -t) for k, (t, j, _) in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows, step=50):
    q = hn.quantised(frame(spark, rows), "vec_id", F.col("label"), "embedding", 256)
    return sorted(map(tuple, hn.hard_negatives(q, F.col("vec_id") % step == 0).collect()))


def cloud(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    label = rng.integers(0, labels, n)
    v = (centres[label] * 0.4 + rng.normal(size=(n, dim))).round(1)
    return [(i, v[i].tolist(), int(label[i])) for i in range(n)]


@pytest.mark.parametrize("step", [50, 3])
def test_equals_plain_search(spark, step):
    rows = cloud(400, 8, 1)
    got = mined(spark, rows, step)
    assert got == plain(rows, step) and got


def test_many_groups_blocks_and_passes(spark, monkeypatch):
    """Several trees in several passes over small blocks give the same rows."""
    monkeypatch.setattr(hn, "GROUP", 7)
    monkeypatch.setattr(hn, "GROUPS", 2)
    rows = cloud(300, 6, 2)
    assert mined(spark, rows, 5) == plain(rows, 5)


def test_edge_cases(spark):
    rows = cloud(120, 4, 3)
    rows += [(0, rows[0][1], rows[0][2])] * 3  # a repeated anchor
    rows += [(7, [9.0, 9.0, 9.0, 9.0], 3), (200, None, 1), (201, [1.0, None, 1.0, 1.0], 1), (202, [1.0, float("nan"), 1.0, 1.0], 1),
             (203, [float("inf")] * 4, 1), (204, [1.0] * 4, None), (None, [1.0] * 4, 1), (250, [], 1), (251, [0.5], 1)]
    rows += [(1000 + i, [1.0, 2.0, -1.0, 0.5], i % 2) for i in range(60)]  # ties
    assert mined(spark, rows, 10) == plain(rows, 10)
    assert mined(spark, [], 10) == [] and mined(spark, [(50, [1.0], 1)], 10) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2 ** 22 + 977 * i), float(-(2 ** 21) + 33 * i), float(i)], i % 2) for i in range(60)]
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_spanning_tree_and_bounds():
    rng = np.random.default_rng(4)
    points = rng.integers(-300, 300, (60, 5))
    order, parent, edge = hn.spanning_tree(points)
    place = {int(i): k for k, i in enumerate(order)}
    assert sorted(place) == list(range(60)) and all(place[int(parent[i])] < place[int(i)] for i in order[1:])
    # Kruskal's total
    pairs = sorted((float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(60) for j in range(i))
    root, total = list(range(60)), 0.0
    for d, i, j in pairs:
        if root[i] != root[j]:
            total += d
            root = [root[i] if r == root[j] else r for r in root]
    assert math.isclose(edge.sum(), total)
    tree = hn.Tree(np.arange(60), np.zeros(60), points, 300)
    block = rng.integers(-300, 300, (40, 5)).astype(float)
    inside = []

    def wanted(i, low, high):
        exact = block @ points[i]
        inside.append(bool(((low <= exact) & (exact <= high)).all()))
        return high > 100_000

    for i, rows, scores in tree.walk(block, np.linalg.norm(block, axis=1), wanted):
        assert (scores == block[rows] @ points[i]).all()
    assert all(inside) and len(inside) == 59
