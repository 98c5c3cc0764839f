"""Monthly delivered GMV of drop-ship orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tijara.functions import codes
from tijara.functions.timeutil import LOCAL_OFFSET_HOURS
from tijara.plans.item_facts import DROPSHIP_MONEY, dropship_item_facts


def dropship_distinct(t, *, threshold: float = 50000, offset_hours: int = LOCAL_OFFSET_HOURS,
                      money_as_double: bool = True) -> DataFrame:
    """Distinct drop-ship item rows with size class, kept when their category exists by name.

    ``left join categories on name = Category where categories.name is not null``
    under DISTINCT is a semi join: duplicate category names cannot add rows.
    The joins that only repeat rows (stops, routes, logs) are left out — DISTINCT
    would remove their copies anyway. Equal items of one order merge, as DISTINCT does.
    """
    x = dropship_item_facts(t, offset_hours, money_as_double=False, with_fanout_only_joins=False)
    names = t["categories"].select(F.col("name").alias("_cat_name"))
    a = (x.join(names, F.col("Category") == F.col("_cat_name"), "left_semi")
         .withColumn("RDS/BULK Classification", codes.size_class("Ordered GMV", threshold))
         .distinct())
    if not money_as_double:
        return a
    return a.select(*[F.col(c).cast("double").alias(c) if c in DROPSHIP_MONEY else F.col(c) for c in a.columns])


def monthly_delivered_gmv(t, *, threshold: float = 50000, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """Delivered GMV by calendar month number of the local delivery date (years merge)."""
    a = dropship_distinct(t, threshold=threshold, offset_hours=offset_hours, money_as_double=False)
    return (a.groupBy(F.month("System Delivery Date").cast("bigint").alias("month_name"))
            .agg(F.sum("Delivered GMV").cast("double").alias("delivered_gmv")))
