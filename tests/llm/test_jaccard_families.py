"""The Jaccard join on families of near copies of many sizes, against all pairs."""

from __future__ import annotations

import random

import pytest

from tests.llm.conftest import frame
from tijara.llm.jaccard_join import jaccard_components


def all_pairs(rows, k, percent):
    """component_id by a comparison of every two texts."""
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        grams = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        sets[i] = grams
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = sorted((find(x), find(y)))
                root[b] = a
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def families(seed):
    """Texts cut, extended and edited around the threshold, over few words, with shared passages and short texts."""
    rng = random.Random(seed)
    common = [f"c{rng.randrange(30)}" for _ in range(40)]
    rows = []
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 8, 20, 60, 150, 400]))]
        if rng.random() < 0.5:
            base[len(base) // 2:len(base) // 2] = common
        for _ in range(rng.randrange(1, 14)):
            t = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3]) * max(1, len(t) // 60)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(50)}"
            cut = rng.choice([0, 0, len(t) // 30, len(t) // 12])
            rows.append((len(rows), " ".join(t[cut:] if rng.random() < 0.5 else t + [f"y{rng.randrange(9)}"] * cut)))
    return rows


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 3, 90), (2, 5, 80), (3, 1, 80)])
def test_families(spark, seed, k, percent):
    rows = families(seed)
    got = sorted(map(tuple, jaccard_components(frame(spark, rows), k, percent).collect()))
    want = all_pairs(rows, k, percent)
    assert got == want and len({c for _, _, c in want}) < len(rows)


def test_repeated_ids_with_different_texts(spark):
    """Texts of one doc_id are one document: it links with what any of them links with, in either row."""
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(60))
    rows = [(7, a), (7, b), (7, b), (9, a), (3, b), (12, a + " b"), (20, "other words here")]
    got = sorted(map(tuple, jaccard_components(frame(spark, rows)).collect()))
    assert got == [(3, 58, 3), (7, 38, 3), (7, 58, 3), (7, 58, 3), (9, 38, 3), (12, 39, 3), (20, 1, 20)]
