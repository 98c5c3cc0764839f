"""Closure of trees of any depth."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tijara.operators.tree import closure, subtree_values


def _nodes(spark, pairs):
    return spark.createDataFrame(pairs, "id int, parent_id int")


def _climbed(pairs):
    """Breadth-first from every node upwards."""
    ids = {i for i, _ in pairs if i is not None}
    out = {}
    for node in ids:
        level, depth = {node}, 0
        while level:
            for n in level:
                out[n, node] = depth
            level = {p for i, p in pairs if i in level and p in ids and (p, node) not in out}
            depth += 1
    return sorted((a, d, n) for (a, d), n in out.items())


@pytest.mark.parametrize("pairs", [
    [(1, None), (2, 1), (3, 2), (4, 2), (5, None)],
    [(1, 3), (2, 1), (3, 2), (4, 3)],                                 # a cycle with a tail
    [(1, 1), (2, 1)],                                                 # its own parent
    [(1, 99), (2, 1), (None, 2), (None, None)],                       # a parent that is no node, no id
    [(1, None), (2, 1), (2, 1), (3, 2), (3, 1)],                      # repeated rows, two ways: the shortest
])
def test_small_trees(spark, pairs):
    assert sorted(map(tuple, closure(_nodes(spark, pairs), "id", "parent_id").collect())) == _climbed(pairs)


def test_random_forest(spark):
    rnd = random.Random(3)
    pairs = [(i, rnd.randrange(i) if i and rnd.random() < 0.9 else None) for i in range(120)]
    assert sorted(map(tuple, closure(_nodes(spark, pairs), "id", "parent_id").collect())) == _climbed(pairs)


def test_depth_is_no_silent_cap(spark):
    chain = _nodes(spark, [(i, i - 1 if i else None) for i in range(30)])
    assert closure(chain, "id", "parent_id", max_depth=40).where("descendant_id = 29").count() == 30
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT"):
        closure(chain, "id", "parent_id", max_depth=10).count()


def test_empty_table(spark):
    assert closure(_nodes(spark, []), "id", "parent_id").collect() == []


def test_subtree_values(spark):
    tree = closure(_nodes(spark, [(1, None), (2, 1), (3, 2)]), "id", "parent_id")
    sold = spark.createDataFrame([(3, 10), (3, 5), (2, 1), (9, 100), (None, 7)], "category int, gmv int")
    assert rows(subtree_values(tree, sold, "category", F.sum("gmv").alias("gmv"))) == [(1, 16), (2, 16), (3, 15)]
