"""Quarterly recency / frequency / monetary history per customer.

Reads the item fact mart ``all_gmv`` (persisted, or derived from the order tables).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tijara.functions.daybits import distinct_days, distinct_months_of_quarter
from tijara.functions.rules import safe_ratio
from tijara.functions.timeutil import date_lit, quarter_end, quarter_label, quarter_start
from tijara.operators.cumulative import running
from tijara.plans.item_facts import delivered_since

QUARTER = 92  # days of the longest quarter


def first_quarter_on_or_after(start: dt.date) -> Column:
    q = quarter_start(date_lit(start))
    return F.when(q < date_lit(start), F.add_months(q, 3)).otherwise(q)


def quarter_days(start: dt.date, as_of: dt.date) -> Column:
    """Array of quarter first days in [start, as_of] (day 1 of Jan/Apr/Jul/Oct)."""
    return F.sequence(first_quarter_on_or_after(start), date_lit(as_of), F.expr("INTERVAL 3 MONTHS"))


def with_quarter_columns(df: DataFrame, first_day: str = "first_day_of_quarter") -> DataFrame:
    return df.select(quarter_label(first_day).alias("quarter"), F.col(first_day),
                     quarter_end(first_day).alias("last_day_of_quarter"), *[c for c in df.columns if c != first_day])


def quarter_metrics(gmv: DataFrame, start: dt.date) -> DataFrame:
    """Per (user, quarter of delivery): NMV, delivered orders, AOV, active months, order days,
    last / first order date. Days and months are counted as bits; orders are the only distinct count."""
    d = F.col("System_Delivery_Date")
    facts = delivered_since(gmv, start)
    nmv = F.sum("Delivered_GMV")
    orders = F.count_distinct("delivered_orders")
    return facts.groupBy("user_id", quarter_start(d).alias("quarter_from_system_delivery_date")).agg(
        nmv.cast("double").alias("NMV"),
        orders.alias("delivered_orders"),
        safe_ratio(nmv, orders).alias("AOV"),
        distinct_months_of_quarter(d).alias("months_of_orders_all_status"),
        distinct_days(F.when(F.col("user_id").isNotNull(), d), quarter_start(d), QUARTER).alias("unique_user_orders"),
        F.max(d).alias("last_order_date"),
        F.min(d).alias("first_order_date"))


def user_quarter_spine(metrics: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Every calendar quarter for every user seen in ``metrics``.

    A generator per user (``explode(sequence(...))``) — no cross join: the
    calendar is a function of the parameters, so each user row expands locally.
    """
    users = metrics.select(F.col("user_id").alias("rfm_user_id")).distinct()
    spine = users.select(F.explode(quarter_days(start, as_of)).alias("first_day_of_quarter"), "rfm_user_id")
    return with_quarter_columns(spine)


def calendar(gmv: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """The quarters in [start, as_of], if any fact lies there: one max over the delivery date."""
    seen = delivered_since(gmv, start).agg(F.max("System_Delivery_Date").alias("_last")).where("_last is not null")
    return with_quarter_columns(seen.select(F.explode(quarter_days(start, as_of)).alias("first_day_of_quarter")))


def _on_spine(per_quarter: DataFrame, user: str, quarter: str, start: dt.date, as_of: dt.date,
              **totals: Column) -> DataFrame:
    """Every quarter of every user in ``per_quarter``, with that quarter's row where there is one.

    A user's rows (one per quarter, so the calendar bounds them) are gathered into a map by quarter and
    looked up for each calendar day: no second read, no self join. ``totals`` are aggregates over all of a
    user's quarters, also those outside the calendar.
    """
    values = [c for c in per_quarter.columns if c != user]
    totals = [c.alias(name) for name, c in totals.items()]
    gathered = per_quarter.groupBy(F.col(user).alias("rfm_user_id")).agg(
        *totals, F.map_from_entries(F.collect_list(F.struct(F.col(quarter).alias("key"), F.struct(*values).alias("value")))).alias("_by"))
    spine = gathered.withColumn("first_day_of_quarter", F.explode(quarter_days(start, as_of)))
    spine = spine.withColumn("_row", F.try_element_at("_by", F.col("first_day_of_quarter")))
    kept = [c for c in gathered.columns if c not in ("_by", "rfm_user_id")]
    return spine.select("rfm_user_id", "first_day_of_quarter", *kept, *[F.col(f"_row.{c}").alias(c) for c in values])


def quarter_user_spine(gmv: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Spine with the in-quarter metrics (a NULL user's quarters carry none)."""
    m = quarter_metrics(gmv, start)
    key = "quarter_from_system_delivery_date"
    out = _on_spine(m, "user_id", key, start, as_of)
    there = F.col("rfm_user_id").isNotNull() & F.col(key).isNotNull()
    values = [c for c in m.columns if c != "user_id"]
    return with_quarter_columns(out.select("first_day_of_quarter", "rfm_user_id", F.when(there, F.col("rfm_user_id")).alias("user_id"),
                                           *[F.when(there, F.col(c)).alias(c) for c in values]))


def daily_facts(gmv: DataFrame, start: dt.date) -> DataFrame:
    """The facts summed per (user, day, order): all that the to-date report needs, and additive, so summaries of
    separate batches of facts add up to the summary of all (``plans.rfm_state`` keeps one)."""
    return (delivered_since(gmv, start).where(F.col("user_id").isNotNull())
            .groupBy("user_id", "System_Delivery_Date", "delivered_orders")
            .agg(F.sum("Delivered_GMV").alias("_gmv"), F.count(F.lit(1)).alias("_rows"), F.count("Delivered_GMV").alias("_valued")))


def _history(daily: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Per user and calendar quarter: in-quarter metrics and to-date values, from one pass over ``daily_facts``.

    A window over each order's days marks where it first occurs, and where it first occurs in a quarter. That makes
    its counts sums; days are counted as bits, and a day lies in one quarter. So nothing is expanded for
    distinct counts, and running sums give the to-date values.
    """
    d, first_q = F.col("System_Delivery_Date"), first_quarter_on_or_after(start)
    # facts dated before the first calendar quarter count to-date from that quarter on
    daily = daily.withColumn("_own", quarter_start(d)).withColumn("_q", F.greatest(quarter_start(d), first_q))
    of_order = Window.partitionBy("user_id", "delivered_orders").orderBy(d)
    ordered = F.col("delivered_orders").isNotNull()
    credited = daily.withColumn("_earlier", F.lag("_own").over(of_order)).select(
        "*", F.when(ordered & F.col("_earlier").isNull(), 1).otherwise(0).alias("_new_order"),
        F.when(ordered & ~F.col("_earlier").eqNullSafe(F.col("_own")), 1).otherwise(0).alias("_order_here"))
    inside = F.col("_own") == F.col("_q")

    def own(c: Column) -> Column:
        return F.when(inside, c)

    per_q = credited.groupBy("user_id", "_q").agg(
        F.sum("_gmv").alias("_nmv"), F.max(d).alias("_last"), F.min(d).alias("_first"),
        distinct_days(d, F.add_months("_q", -3), 2 * QUARTER).alias("_new_days"), F.sum("_new_order").alias("_new_orders"),
        F.sum("_rows").alias("_rows"), F.sum("_valued").alias("_valued"), F.max(inside).alias("_has"),
        F.sum(own(F.col("_gmv"))).alias("_own_nmv"), F.sum(own(F.col("_order_here"))).alias("_own_orders"),
        distinct_months_of_quarter(own(d)).alias("_own_months"), distinct_days(own(d), F.col("_q"), QUARTER).alias("_own_days"),
        F.max(own(d)).alias("_own_last"), F.min(own(d)).alias("_own_first"))
    spine = _on_spine(per_q, "user_id", "_q", start, as_of, _all_rows=F.sum("_rows"))
    r = running(spine, "rfm_user_id", "first_day_of_quarter",
                sums={"_c_nmv": "_nmv", "_c_orders": "_new_orders", "_c_days": "_new_days",
                      "_c_rows": "_rows", "_c_valued": "_valued"},
                mins={"_c_first": "_first"}, maxs={"_c_last": "_last"})
    return r


def _to_date() -> list[Column]:
    return [
        quarter_end("first_day_of_quarter").alias("last_day_of_quarter"), F.col("first_day_of_quarter"), F.col("rfm_user_id"),
        F.col("rfm_user_id").alias("rfm2_user_id"),
        # SUM(CASE WHEN due THEN gmv ELSE 0 END) is NULL only when every fact is due and unvalued
        F.when((F.col("_c_valued") == 0) & (F.col("_c_rows") == F.col("_all_rows")), F.lit(None))
        .otherwise(F.col("_c_nmv")).cast("double").alias("Cumulative_NMV"),
        F.col("_c_orders").cast("bigint").alias("Cumulative_delivered_orders"),
        F.col("_c_days").cast("bigint").alias("Cumulative_unique_user_orders"),
        F.col("_c_last").alias("Cumulative_last_order_date"),
        F.col("_c_first").alias("Cumulative_first_order_date")]


def _in_quarter() -> list[Column]:
    def has(c: Column) -> Column:
        return F.when(F.col("_has"), c)

    return [
        has(F.col("rfm_user_id")).alias("user_id"), has(F.col("first_day_of_quarter")).alias("quarter_from_system_delivery_date"),
        has(F.col("_own_nmv").cast("double")).alias("NMV"), has(F.col("_own_orders")).alias("delivered_orders"),
        has(safe_ratio(F.col("_own_nmv"), F.col("_own_orders"))).alias("AOV"),
        has(F.col("_own_months")).alias("months_of_orders_all_status"), has(F.col("_own_days")).alias("unique_user_orders"),
        has(F.col("_own_last")).alias("last_order_date"), has(F.col("_own_first")).alias("first_order_date")]


def cumulative(gmv: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """To-date metrics at each quarter end per user (users without facts vanish)."""
    return _history(daily_facts(gmv, start), start, as_of).select(*_to_date())


def report(gmv: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """To-date metrics with the in-quarter metrics of the same quarter."""
    return report_of(daily_facts(gmv, start), start, as_of)


def report_of(daily: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """The report from ``daily_facts``, made now or kept."""
    return _history(daily, start, as_of).select(*_to_date(), *_in_quarter())
