"""Every registered query against its DuckDB oracle on the smallest test tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

from tests.conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(repr(_norm(r[i])) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


def _names():
    from tijara.registry import all_queries

    return sorted(all_queries())


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries

    assert set(_names()) <= set(queries()) and set(_names()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", _names())
def test_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries

    df = queries()[name](spark, SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _bag(df.columns, srows) == _bag(ocols, orows)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["month_name", "delivered_gmv"]
    assert df.count() >= 0
