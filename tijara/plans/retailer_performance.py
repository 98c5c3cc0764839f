"""Retailer performance profile: one row per retailer record with purchase history,
latest survey answer and last-3-month totals.

The report takes all per-user values from one pass over the item facts (``purchase_profile``);
the single metrics are also there on their own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tijara.functions.rules import safe_ratio
from tijara.functions.timeutil import LOCAL_OFFSET_HOURS, date_lit, epoch_seconds_to_ntz, months_back, to_local
from tijara.operators.dims import role
from tijara.operators.keyed import nth_latest_values, top_n_per_key
from tijara.plans.item_facts import delivered_since

DELIVERED = (4, 5)


def last_two_order_dates(gmv: DataFrame) -> DataFrame:
    """Latest and second-latest distinct delivered date per user."""
    delivered = gmv.where(F.col("order_status_code").isin(*DELIVERED)).select("user_id", "System_Delivery_Date")
    return nth_latest_values(delivered, "user_id", "System_Delivery_Date", 2,
                             ["last_order_date", "second_last_order_date"])


def customer_metrics(gmv: DataFrame) -> DataFrame:
    """Categories bought (distinct, sorted, comma-separated), order days, AOV, first delivered date.

    A user's days are a set that the calendar bounds, so their number is the set's size; the delivered orders are the
    only distinct count, which needs no expanded rows. The category list is its own aggregate (bounded by the
    catalogue), joined back per user.
    """
    cats = F.array_sort(F.collect_set("Category"))
    d = F.col("System_Delivery_Date")
    category_list = gmv.groupBy(F.col("user_id").alias("_cu")).agg(
        F.when(F.size(cats) > 0, F.array_join(cats, ", ")).alias("categories"))
    counts = gmv.groupBy("user_id").agg(
        F.size(F.collect_set(F.when(F.col("user_id").isNotNull(), d))).cast("bigint").alias("unique_user_orders"),
        safe_ratio(F.sum("Delivered_GMV"), F.count_distinct("delivered_orders")).alias("AOV"),
        F.min(F.when(F.col("order_status_code").isin(*DELIVERED), d)).alias("first_order_date"))
    return (counts.join(category_list, F.col("user_id").eqNullSafe(F.col("_cu")), "inner")
            .select("user_id", "categories", "unique_user_orders", "AOV", "first_order_date"))


def survey_answers(results: DataFrame, surveys: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Answers to the questions whose text contains any of ``patterns``."""
    s = surveys.select(F.col("survey_id").alias("_s"), F.col("question_id").alias("_q"),
                       F.col("option_id").alias("_o"), "survey_name", "question_type", "question_text", "option_text")
    match = None
    for p in patterns:
        m = F.col("question_text").contains(p)
        match = m if match is None else (match | m)
    j = results.join(s, (F.col("option_id") == F.col("_o")) & (F.col("question_id") == F.col("_q"))
                     & (F.col("survey_id") == F.col("_s")), "inner")
    return j.where(match).select(
        "user_id", "result_id", F.col("created_at").alias("result_created_at"), "survey_id", "survey_name",
        "question_id", "question_type", "question_text", "option_id", "option_text", "selected_option")


def latest_survey_answer(results: DataFrame, surveys: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Most recent matching answer per user (ties to the highest result id)."""
    answers = survey_answers(results, surveys, patterns)
    latest = top_n_per_key(answers, ["user_id"],
                           [F.col("result_created_at").desc(), F.col("result_id").desc()], 1, drop_null_keys=False)
    return latest.withColumn("result_created_time", epoch_seconds_to_ntz("result_created_at"))


def last3m_totals(gmv: DataFrame, as_of: dt.date) -> DataFrame:
    """Punched, net, dispatched, return and cancelled GMV since ``as_of`` - 3 months.

    Cancelled is NULL for a user without cancelled rows."""
    recent = delivered_since(gmv, months_back(as_of, 3))
    return recent.groupBy("user_id").agg(
        F.sum("Ordered_GMV").cast("double").alias("total_punched_GMV_last3months"),
        F.sum("Delivered_GMV").cast("double").alias("total_NMV_last3months"),
        F.sum("Dispatched_GMV").cast("double").alias("total_dispatched_GMV_last3months"),
        F.sum("Return_GMV").cast("double").alias("total_return_GMV_last3months"),
        F.sum(F.when(F.col("order_status_code") == 6, F.col("Ordered_GMV"))).cast("double")
        .alias("total_cancelled_GMV_last3months"))


def purchase_profile(gmv: DataFrame, as_of: dt.date) -> DataFrame:
    """All per-user values of the profile from one pass over the facts.

    Facts are first summed per (user, day, status, delivered order, category), which is combined
    map-side; a user's days and categories are sets that the calendar and the catalogue bound. The days being
    gathered anyway, their number is the set's size, and the delivered orders are the only distinct count: one
    needs no expanded rows.
    """
    d, status = F.col("System_Delivery_Date"), F.col("order_status_code")
    money = ("Ordered_GMV", "Delivered_GMV", "Dispatched_GMV", "Return_GMV")
    daily = gmv.groupBy("user_id", "System_Delivery_Date", "order_status_code", "delivered_orders", "Category").agg(
        *[F.sum(c).alias(c) for c in money])
    delivered = F.when(status.isin(*DELIVERED), d)
    recent = d >= date_lit(months_back(as_of, 3))
    cats, days = F.array_sort(F.collect_set("Category")), F.sort_array(F.collect_set(delivered), asc=False)

    def last3m(c: str, also: Column = F.lit(True)) -> Column:
        return F.sum(F.when(recent & also, F.col(c))).cast("double")

    return daily.groupBy("user_id").agg(
        F.when(F.size(cats) > 0, F.array_join(cats, ", ")).alias("categories"),
        F.size(F.collect_set(F.when(F.col("user_id").isNotNull(), d))).cast("bigint").alias("unique_user_orders"),
        safe_ratio(F.sum("Delivered_GMV"), F.count_distinct("delivered_orders")).alias("AOV"),
        F.min(delivered).alias("first_order_date"), F.try_element_at(days, F.lit(1)).alias("last_order_date"),
        F.try_element_at(days, F.lit(2)).alias("second_last_order_date"),
        last3m("Ordered_GMV").alias("total_punched_GMV_last3months"), last3m("Delivered_GMV").alias("total_NMV_last3months"),
        last3m("Dispatched_GMV").alias("total_dispatched_GMV_last3months"),
        last3m("Return_GMV").alias("total_return_GMV_last3months"),
        last3m("Ordered_GMV", status == 6).alias("total_cancelled_GMV_last3months"))


def retailer_performance(t, gmv: DataFrame, *, as_of: dt.date, patterns: Sequence[str],
                         offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    r = t["retailers"].select(F.col("user_id").alias("retailer_id"), "store_name", "city_id", "area_id",
                              "sub_area_id", F.col("store_type").alias("_store_type"))
    users = t["users"].select(F.col("id").alias("user_id"), F.col("name").alias("User_Name"), "mobile",
                              F.col("created_at").alias("_signup"), "is_active")
    cities = role(t["cities"], {"id": "_city", "name": "City"})
    areas = role(t["areas"], {"id": "_area", "name": "Area"})
    sub_areas = role(t["sub_areas"], {"id": "_sub_area", "name": "Sub_Area"})
    store_types = role(t["store_type"], {"id": "_st", "name": "store_type"})
    bought = purchase_profile(gmv, as_of).withColumnRenamed("user_id", "_cm")
    nps = latest_survey_answer(t["nps_results"], t["nps_surveys"], patterns).select(
        F.col("user_id").alias("_nps"), F.col("result_created_time").alias("result_created_at"), "question_text",
        "selected_option")
    j = (r.join(users, F.col("retailer_id") == F.col("user_id"), "left")
         .join(cities, F.col("city_id") == F.col("_city"), "left")
         .join(areas, F.col("_area") == F.col("area_id"), "left")
         .join(sub_areas, F.col("_sub_area") == F.col("sub_area_id"), "left")
         .join(store_types, F.col("_store_type") == F.col("_st"), "left")
         .join(bought, F.col("_cm") == F.col("retailer_id"), "left")
         .join(nps, F.col("_nps") == F.col("retailer_id"), "left"))
    return j.select(
        "retailer_id", "user_id", "User_Name", "mobile", "store_name", "City", "Area", "Sub_Area",
        to_local("_signup", offset_hours).alias("signup_date"), "is_active", "store_type", "categories",
        "first_order_date", "AOV", "unique_user_orders", "last_order_date", "second_last_order_date",
        "result_created_at", "question_text", "selected_option", "total_punched_GMV_last3months",
        "total_NMV_last3months", "total_dispatched_GMV_last3months", "total_return_GMV_last3months",
        "total_cancelled_GMV_last3months")
