"""Per-key record selection: latest record, best-scored record, n-th latest values.

All of them are ``row_number`` over a window partitioned by the key and filtered
on the rank, which Catalyst plans as a ``WindowGroupLimit`` (partial top-k before
the shuffle, final top-k after), so a hot key ships at most k rows per map task
instead of all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1,
                  rank_col: str | None = None, drop_null_keys: bool = True) -> DataFrame:
    """Rows ranked 1..n per key by ``order`` (give a total order for determinism).

    With ``drop_null_keys`` rows whose key is NULL are dropped (as the equality
    self-join a rank filter replaces does); otherwise NULL keys form one group.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    name = rank_col or "_rank"
    out = df
    for k in keys if drop_null_keys else ():
        out = out.where(F.col(k).isNotNull())
    out = out.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def latest_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """The row holding the max of ``order_col`` per key, in one pass over ``df``.

    ``order_col`` is meant to be a surrogate id; of rows that tie on it one is kept. NULL keys and
    NULL order values drop out.
    """
    return top_n_per_key(df.where(F.col(order_col).isNotNull()), [key], [F.col(order_col).desc()])


def completeness_score(fields: Sequence[str | Column]) -> Column:
    """Number of non-NULL fields (0/1 presence flags summed)."""
    flags = [c.isNotNull().cast("int") for c in _cols(fields)]
    total = flags[0]
    for f in flags[1:]:
        total = total + f
    return total


def best_by_score(df: DataFrame, key: str, score: Column, tiebreak: Sequence[Column] = (),
                  score_col: str = "score") -> DataFrame:
    """One row per key with the highest score (ties broken by ``tiebreak``)."""
    scored = df.withColumn(score_col, score)
    return top_n_per_key(scored, [key], [F.col(score_col).desc(), *tiebreak], 1)


def nth_latest_values(df: DataFrame, key: str, value: str, n: int, names: Sequence[str]) -> DataFrame:
    """Latest, 2nd latest, ... n-th latest distinct ``value`` per key as columns.

    ``names[i]`` receives the (i+1)-th latest; missing ranks are NULL.
    """
    ranked = top_n_per_key(df.select(key, value).distinct(), [key], [F.col(value).desc()], n, rank_col="_rank",
                           drop_null_keys=False)
    return ranked.groupBy(key).agg(*[
        F.max(F.when(F.col("_rank") == i + 1, F.col(value))).alias(names[i]) for i in range(n)])
