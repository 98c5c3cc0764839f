"""Build the persisted marts into a named schema (the ``config(schema=...)`` models).

``all_gmv`` is written first and read back by the RFM and retailer-performance
marts: each of those reads the item facts several times (metrics, spine,
cumulative, per-user aggregates), so a written table replaces re-deriving the
order-item join per consumer and cuts the lineage a lost executor would replay.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.plans import item_facts, retailer_performance, rfm
from tijara.sources.io import Tables, write_mart


def build_gmv_mart(spark: SparkSession, t: Tables, schema: str, *, path: str | None = None) -> Tables:
    """Write ``all_gmv`` (partitioned by delivery quarter) and return tables that read it."""
    part = item_facts.GMV_PARTITION
    # rows of a quarter meet in few tasks (large quarters are split), so few files are written per folder
    gmv = item_facts.all_gmv(t).withColumn(part, rfm.quarter_start("System_Delivery_Date")).hint("rebalance", part)
    write_mart(gmv, schema, "all_gmv", path=path, partition_by=[part])
    return t.with_table("all_gmv", spark.table(f"`{schema}`.`all_gmv`"))


def partition_digests(df: DataFrame, part: str) -> DataFrame:
    """(part, digest) of each value of ``part``: row count and sums of two row hashes, whatever the rows' order.

    Combined map-side; a row's hashes cover its NULLs' places too.
    """
    cols = [F.col(c) for c in sorted(set(df.columns) - {part})]
    row = [*cols, *[c.isNull() for c in cols]]
    sums = [F.sum(h(*row).cast("decimal(20,0)")).cast("string") for h in (F.xxhash64, F.hash)]
    return df.groupBy(part).agg(F.concat_ws(":", F.count(F.lit(1)), *sums).alias("digest"))


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Inserts replace only the partitions they have rows for (tables take this from the session alone)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def refresh_mart(new: DataFrame, schema: str, name: str, part: str, *, path: str | None = None) -> dict[str, list]:
    """Bring the mart ``schema.name``, partitioned by ``part`` (not NULL), to the rows of ``new``; the partitions that
    were written and dropped.

    Digests per partition are compared, and only partitions that differ are written, by dynamic partition
    overwrite: their files are staged and swapped in when all are written, so a failed write leaves the mart as it
    was; then partitions without rows in ``new`` are dropped. A mart that isn't there is written whole. Only digests
    (one row per partition) reach the driver.
    """
    spark, table = new.sparkSession, f"`{schema}`.`{name}`"
    digests = {r[0]: r[1] for r in partition_digests(new, part).collect()}
    if not spark.catalog.tableExists(f"{schema}.{name}"):
        write_mart(new.hint("rebalance", part), schema, name, path=path, partition_by=[part])
        return {"written": sorted(digests), "dropped": []}
    stored = spark.table(table)
    before = {r[0]: r[1] for r in partition_digests(stored, part).collect()}
    changed = sorted(q for q, d in digests.items() if before.get(q) != d)
    gone = sorted(set(before) - set(digests))
    if changed:
        rows = new.where(F.col(part).isin(changed)).hint("rebalance", part).select(*stored.columns)
        with _dynamic_overwrite(spark):
            rows.write.mode("overwrite").insertInto(table)
    for q in gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{part}` = '{q}')")
    return {"written": changed, "dropped": gone}


def refresh_gmv_mart(spark: SparkSession, t: Tables, schema: str, *, path: str | None = None) -> Tables:
    """``all_gmv`` with only the changed delivery quarters written, and tables that read it."""
    part = item_facts.GMV_PARTITION
    gmv = item_facts.all_gmv(t).withColumn(part, rfm.quarter_start("System_Delivery_Date"))
    refresh_mart(gmv, schema, "all_gmv", part, path=path)
    return t.with_table("all_gmv", spark.table(f"`{schema}`.`all_gmv`"))


def build_growth_marts(spark: SparkSession, t: Tables, schema: str, *, start: dt.date, as_of: dt.date,
                       survey_patterns: Sequence[str], root: str | None = None, refresh: bool = False) -> None:
    """``all_gmv``, then the RFM report and the retailer performance profile, into ``schema``.

    ``refresh``: of ``all_gmv`` only the changed quarters are written."""
    def where(name: str) -> str | None:
        return f"{root.rstrip('/')}/{name}" if root else None

    t = (refresh_gmv_mart if refresh else build_gmv_mart)(spark, t, schema, path=where("all_gmv"))
    gmv = t["all_gmv"]
    write_mart(rfm.report(gmv, start, as_of), schema, "rfm_report", path=where("rfm_report"))
    write_mart(retailer_performance.retailer_performance(t, gmv, as_of=as_of, patterns=survey_patterns),
               schema, "retailer_performance", path=where("retailer_performance"))
