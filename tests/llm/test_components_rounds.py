"""Components: how many tables their rounds write, and links that come later."""

from __future__ import annotations

import random

import pytest

from tijara.llm import components as module


def pairs(spark, rows):
    return spark.createDataFrame(rows, "a bigint, b bigint")


def brute(rows):
    of = {x: x for row in rows for x in row if row[0] != row[1]}
    for _ in of:
        for a, b in rows:
            if a != b:
                of[a] = of[b] = min(of[a], of[b])
    return of


def as_dict(found):
    rows = found.collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


@pytest.fixture
def written(monkeypatch):
    """Names of the tables that the components write."""
    names = []
    real = module.stored
    monkeypatch.setattr(module, "stored", lambda df, name: (names.append(name), real(df, name))[1])
    return names


def test_stars_take_no_round(spark, written):
    stars = [(k, 1) for k in range(2, 40)] + [(50, k) for k in range(51, 60)] + [(4, 4), (1, 7)]
    assert as_dict(module.components(pairs(spark, stars))) == brute(stars)
    assert written == ["links"]


def test_no_links(spark, written):
    assert as_dict(module.components(pairs(spark, []))) == {}
    assert written == ["links"]


@pytest.mark.parametrize("seed", [1, 2])
def test_later_links_equal_all_links_at_once(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(k, k + 1) for k in range(70, 80)]
    later = [(rng.randrange(90), rng.randrange(90)) for _ in range(15)] + [(100, 101), (101, 102), (90, 75), (5, 5)]
    found = module.joined(module.components(pairs(spark, rows)), pairs(spark, later))
    assert as_dict(found) == brute(rows + later)


def test_links_inside_a_component_take_no_round(spark, written):
    rows = [(k, k + 1) for k in range(1, 30)]
    found = module.components(pairs(spark, rows))
    written.clear()
    inside = [(a, b) for a in range(1, 30) for b in range(a + 2, 31, 3)]
    assert as_dict(module.joined(found, pairs(spark, inside))) == brute(rows)
    assert written == ["links", "found"]


def test_settled_after_the_last_round_is_no_error(spark, monkeypatch):
    monkeypatch.setattr(module, "MAX_ROUNDS", 0)
    assert as_dict(module.components(pairs(spark, [(2, 1), (3, 1)]))) == {1: 1, 2: 1, 3: 1}
    with pytest.raises(RuntimeError):
        module.components(pairs(spark, [(2, 1), (3, 2)]))
