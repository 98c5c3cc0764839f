"""The to-date history as a kept state into which new, late and corrected facts are merged.

The state is ``rfm.daily_facts`` (sums and counts per user, day and order), stored by delivery quarter. Sums add up, so a
batch of facts changes it by its own summary: new or late facts are added, a corrected fact is taken back as it was
(weight -1) and added as it is. Only the quarters that a batch touches are read and written again, by dynamic
partition overwrite: Spark stages the new files and swaps them in when all are written, so a write that fails
leaves the state as it was. Rows that were taken back wholly stay with a count of 0 (a quarter is never left without
a file to replace the old ones) and are not read. A batch must be merged once. The report is taken from the state, without
the facts.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.functions.timeutil import quarter_start
from tijara.plans import rfm

KEYS = ("user_id", "System_Delivery_Date", "delivered_orders")
SUMS = ("_gmv", "_rows", "_valued")
PART = "delivery_quarter"


def change(start: dt.date, added: DataFrame, taken_back: DataFrame | None = None) -> DataFrame:
    """What a batch adds to the state: facts ``added``, less facts ``taken_back`` (as they were when merged)."""
    plus = rfm.daily_facts(added, start)
    if taken_back is None:
        return plus
    minus = rfm.daily_facts(taken_back, start)
    return plus.unionByName(minus.select(*KEYS, *[(-F.col(c)).cast(minus.schema[c].dataType).alias(c) for c in SUMS]))


def combined(*summaries: DataFrame) -> DataFrame:
    """Summaries added up. A sum is NULL where no fact with a value is left, as over the facts themselves."""
    every = reduce(DataFrame.unionByName, summaries)
    kind = summaries[0].schema["_gmv"].dataType
    added = every.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return added.withColumn("_gmv", F.when(F.col("_valued") != 0, F.col("_gmv")).cast(kind))


def merge(spark: SparkSession, path: str, changes: DataFrame) -> None:
    """Merge ``changes`` into the state at ``path`` (which is made if it isn't there)."""
    changes = combined(changes).withColumn(PART, quarter_start("System_Delivery_Date"))
    try:
        kept = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        touched = [r[0] for r in changes.select(PART).distinct().collect()]  # a batch's quarters: few
        changes = combined(kept.where(F.col(PART).isin(touched)).drop(PART), changes.drop(PART)).withColumn(
            PART, quarter_start("System_Delivery_Date"))
    (changes.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PART).parquet(path))


def daily(spark: SparkSession, path: str) -> DataFrame:
    """The state's summary, as ``rfm.daily_facts`` over all merged facts gives it."""
    return spark.read.parquet(path).where("_rows > 0").drop(PART)


def report(spark: SparkSession, path: str, start: dt.date, as_of: dt.date) -> DataFrame:
    """``rfm.report`` from the state."""
    return rfm.report_of(daily(spark, path), start, as_of)
