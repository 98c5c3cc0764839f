"""Dimension joins: lookup tables, role-playing tables, category tree, text keys.

Broadcast policy: no join carries an unconditional broadcast hint. Spark
broadcasts a side only when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` at planning time, or — with AQE — when the
*measured* size of a shuffled side is under the adaptive threshold; above either
check the sort-merge join stays. Lookup tables (statuses, cities, categories) pass
those checks by being small; tables that grow with the business (users, SKUs,
stops) fall back to shuffle joins when they are large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def role(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """One role of a role-playing table: a projection with renamed columns.

    ``role(users, {"id": "driver_id", "name": "driver_name"})``
    """
    return df.select(*[F.col(src).alias(dst) for src, dst in columns.items()])



def canonical_int_key(text: Column) -> Column:
    """Integer key of a text id, NULL unless the text is exactly ``cast(int as text)``.

    ``t = cast(i as string)`` holds iff ``canonical_int_key(t) = i``, so a text-keyed
    bridge can be joined on the integer key and share the integer-key partitioning
    of the fact it meets.
    """
    as_int = text.try_cast("bigint")
    return F.when(as_int.cast("string") == text, as_int)


def category_parent(categories: DataFrame) -> DataFrame:
    """Each category with its parent (child -> parent self join).

    ``parent_ref`` is the joined parent's id: NULL when ``parent_id`` names no category.
    """
    c = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"),
                          F.col("parent_id"))
    p = categories.select(F.col("id").alias("parent_ref"), F.col("name").alias("parent_name"))
    return c.join(p, F.col("parent_id") == F.col("parent_ref"), "left")


def category_descendants(categories: DataFrame) -> DataFrame:
    """Each category with its children and grandchildren (fan-out, one row per path)."""
    top = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    sub = categories.select(F.col("id").alias("sub_id"), F.col("name").alias("sub_name"),
                                       F.col("parent_id").alias("sub_parent"))
    subsub = categories.select(F.col("id").alias("subsub_id"), F.col("name").alias("subsub_name"),
                                          F.col("parent_id").alias("subsub_parent"))
    return (top.join(sub, F.col("sub_parent") == F.col("category_id"), "left")
            .join(subsub, F.col("subsub_parent") == F.col("sub_id"), "left")
            .drop("sub_parent", "subsub_parent"))


def left_join_spread(left: DataFrame, right: DataFrame, key: str, ref: str, spread_by: str, ways: int = 1024) -> DataFrame:
    """``left LEFT JOIN right ON left.key = right.ref`` where very many ``key`` are NULL.

    NULL keys match nothing, yet a plain join hashes all of them to one task. Here a second key
    deals them over ``ways`` values of a hash of ``spread_by``; it is 0 for every other row, so
    matches and the partitioning of equal keys stay. Consecutive joins on the same key and
    ``spread_by`` share one shuffle of ``left``.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(ways))).otherwise(F.lit(0).cast("bigint"))
    side = right.withColumn("_zero", F.pmod(F.xxhash64(ref), F.lit(1)))  # a 0 that the optimiser can't fold: a join key
    return (left.withColumn("_spread", spread)
            .join(side, (F.col(key) == F.col(ref)) & (F.col("_spread") == F.col("_zero")), "left")
            .drop("_spread", "_zero"))


def left_join_fact(left: DataFrame, fact: DataFrame, left_key: str, fact_key: str,
                   left_keys: DataFrame, fact_keys: DataFrame) -> DataFrame:
    """``left LEFT JOIN fact ON left.left_key = fact.fact_key`` for a fact table far larger than
    ``left`` in which one key may hold a large share of the rows.

    A left outer join can only split skewed partitions of its left side, and here the hot key sits
    on the right. So the keys of ``left`` without facts get one empty fact row each, and an inner join,
    either side of which can be split, gives the rows of the left join. ``left_keys`` (column
    ``left_key``, not NULL) and ``fact_keys`` (column ``fact_key``) are cheap sources of the two sides'
    keys, so neither side's plan is repeated; the fact keys are made distinct map-side.
    """
    keys = fact_keys.select(F.col(fact_key).alias("_fact_key")).where("_fact_key is not null").distinct()
    lonely = left_keys.select(left_key).distinct().join(keys, F.col(left_key) == F.col("_fact_key"), "left_anti")
    empty = [F.col(left_key).alias("_meets"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in fact.schema.fields]]
    facts = fact.withColumn("_meets", F.col(fact_key)).unionByName(lonely.select(*empty))
    return left.join(facts, F.col(left_key) == F.col("_meets"), "inner").drop("_meets")


def left_join_dealt(left: DataFrame, right: DataFrame, key: str, ref: str, deal_by: str, ways: int = 8) -> DataFrame:
    """``left LEFT JOIN right ON left.key = right.ref`` where few keys hold all rows of a large ``left`` and
    ``right``, the smaller, has many rows for each.

    One task a key would be too few: ``left`` is dealt ``ways`` ways by a hash of ``deal_by`` and every way
    meets its own copy of ``right``.
    """
    copies = right.withColumn("_way", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(ways - 1))))
    return (left.withColumn("_deal", F.pmod(F.xxhash64(deal_by), F.lit(ways)))
            .join(copies, (F.col(key) == F.col(ref)) & (F.col("_deal") == F.col("_way")), "left")
            .drop("_deal", "_way"))


def left_join_blocks(left: DataFrame, right: DataFrame, groups: Sequence[str], key: str, ref: str,
                     order: Sequence[Column] = (), size: int = 1000) -> DataFrame:
    """``left LEFT JOIN right ON left.key = right.ref`` of very many rows, sorted by ``order``, without
    shuffling or sorting them.

    Rows of ``left`` that agree in ``groups`` (which hold ``key`` and all that ``order`` reads) and rows of
    ``right`` that agree in ``ref`` are packed in blocks of up to ``size``. Blocks are joined and sorted; their
    rows are written out afterwards, in place.
    """
    def blocks(df: DataFrame, by: list[str], name: str) -> DataFrame:
        rest = [c for c in df.columns if c not in by]
        number = F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(0)))
        packed = df.withColumn("_block", F.floor((number - 1) / size))
        return packed.groupBy(*by, "_block").agg(F.collect_list(F.struct(*rest)).alias(name)).drop("_block")

    j = blocks(left, list(groups), "_rows").join(blocks(right, [ref], "_matches"), F.col(key) == F.col(ref), "left")
    if order:
        j = j.orderBy(*order)
    return j.select(*groups, F.inline("_rows"), "_matches").select("*", F.inline_outer("_matches")).drop("_matches")
