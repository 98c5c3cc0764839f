"""Catalogue jobs whose output has far more rows than their tables: nothing of it is shuffled or sorted."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tijara.operators.dims import left_join_blocks, left_join_dealt
from tijara.registry import all_queries


def _optimized(spark, name):
    return all_queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_sku_catalogue_multiplies_last(spark):
    joins = [line for line in _optimized(spark, "sku_catalogue") if "Join LeftOuter" in line]
    assert "_pc_cat" in joins[0] and "_deal" in joins[0]


def test_rate_card_sorts_and_dedups_before_children(spark):
    plan = _optimized(spark, "commission_rate_card")
    first = {word: next(i for i, line in enumerate(plan) if word in line) for word in ("Generate", "Sort", "Aggregate", "Join")}
    assert first["Generate"] < min(first["Sort"], first["Aggregate"], first["Join"])


def test_joins_of_many_rows_equal_left_join(spark):
    left = spark.createDataFrame([(i, None if i % 7 == 0 else i % 3, f"n{i % 2}") for i in range(40)] + [(5, 2, "n1")],
                                 "id bigint, k bigint, name string")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, None), (None, "x"), (9, "y")], "r bigint, v string")
    want = rows(left.join(right, F.col("k") == F.col("r"), "left"), "id", "k", "name", "v")
    assert rows(left_join_dealt(left, right, "k", "r", "id"), "id", "k", "name", "v") == want
    for size in (1, 2, 1000):
        got = left_join_blocks(left, right, ["k", "name"], "k", "r",
                               [F.col("name").asc_nulls_last(), F.col("k").asc_nulls_last()], size)
        assert rows(got, "id", "k", "name", "v") == want
        keys = [(r["name"], r["k"] is None, r["k"] or 0) for r in got.collect()]
        assert keys == sorted(keys)
