"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each entry runs one job (or one operator of a job) over the domain tables derived
from the bundled test data, with the test parameters below.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tijara.sources.io import Tables
from tijara.sources.testdata import TestTables

# test parameters (the reference's wall-clock "now" and fixed dates become arguments)
AS_OF = dt.date(2001, 8, 1)
RFM_START = dt.date(1995, 1, 1)
ORDER_WINDOW = (dt.datetime(1998, 1, 1), dt.datetime(1998, 1, 31))
AUDIT_CUT_DATE = dt.date(2023, 6, 21)
AUDIT_MONTH = 6
SURVEY_PATTERNS = ("recommend us", "suggest us")
SIZE_THRESHOLD = 50000
EXCLUSIVE_SELLER = 47

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(name: str):
    def deco(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = fn
        return fn
    return deco


_TABLES: dict[tuple[int, str], tuple[SparkSession, Tables]] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    """Domain tables of one test directory, planned once per session (plans only, no data).

    The cache holds the session object itself, so its id cannot be reused while cached.
    """
    key = (id(spark), sf_dir)
    hit = _TABLES.get(key)
    if hit is None or hit[0] is not spark:
        hit = _TABLES[key] = (spark, TestTables(spark, sf_dir))
    return hit[1]


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables_for(spark, sf_dir))

    run.__name__ = name
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import tijara.queries  # noqa: F401  (registers)
    return {name: runner(name) for name in QUERIES}
