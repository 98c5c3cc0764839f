"""Queries that SQL can express, against their DuckDB SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tests.llm.conftest import SMALL
from tijara.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    df = QUERIES[name](spark, SMALL)
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(cur.fetchall())


def test_all_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(ORACLES) <= set(__spark_entry__.oracle_sql())
