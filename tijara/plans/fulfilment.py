"""Fulfilment funnel reconciled against counted returns.

``funnel`` aggregates the item facts by 25 keys. Rather than materialising the
fan-out rows (one per transaction log x order-agent row x retailer row of an
item) and summing them, the rows that add no group key are counted per key
first — a map-side-combined aggregation that collapses even a stop or user holding
a third of all rows — and each item's measures are weighted by the product of
those counts. Sum of weighted rows == sum over the fan-out rows, exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tijara.functions import codes
from tijara.functions.rules import guarded_ratio
from tijara.functions.timeutil import LOCAL_OFFSET_HOURS, local_date, to_local
from tijara.operators.dims import left_join_spread, role
from tijara.plans import dimensions as D
from tijara.plans.item_facts import enrich_items, fulfilment_measures, items_of, real_delivered_orders, with_items

# ---------------------------------------------------------------------------
# returns discrepancy


def return_discrepancy_detail(t, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """Counted-return discrepancies with reason, SKU, route, driver and city.

    The route and its user must exist (inner joins); rows without a reason are dropped.
    """
    rd = t["return_discrepancy"].where(F.col("id").isNotNull() & F.col("reason_id").isNotNull())
    reasons = role(t["reasons"], {"id": "_reason_ref", "reason": "reason"})
    sku = t["product_sku"].select(F.col("id").alias("_sku_ref"), F.col("product_id").alias("_sku_product"))
    products = t["products"].select(F.col("id").alias("_product_ref"), F.col("name").alias("product_name"))
    routes = t["routes"].select(F.col("id").alias("_route_ref"), F.col("name").alias("route_name"),
                                F.col("status").alias("_route_status"), F.col("user_id").alias("_route_user"))
    route_status = role(t["route_status"], {"id": "_rs_ref", "name": "route_status_name"})
    users = role(t["users"], {"id": "_user_ref", "name": "driver_name"})
    drivers = t["drivers"].select(F.col("user_id").alias("driver_id"), F.col("city_id").alias("_driver_city"))
    cities = role(t["cities"], {"id": "_city_ref", "name": "city"})
    joined = (rd.join(reasons, F.col("_reason_ref") == F.col("reason_id"), "left")
              .join(sku, F.col("_sku_ref") == F.col("sku_id"), "left")
              .join(products, F.col("_sku_product") == F.col("_product_ref"), "left")
              .join(routes, F.col("_route_ref") == F.col("route_id"), "inner")
              .join(route_status, F.col("_rs_ref") == F.col("_route_status"), "left")
              .join(users, F.col("_user_ref") == F.col("_route_user"), "inner")
              .join(drivers, F.col("driver_id") == F.col("_user_ref"), "left")
              .join(cities, F.col("_city_ref") == F.col("_driver_city"), "left"))
    return joined.select(
        F.col("city").alias("City"), to_local("created_at", offset_hours).alias("Time"),
        "route_id", F.col("route_name").alias("Route"), "sku_id", F.col("product_name").alias("SKU"),
        F.col("qty").alias("App Return Qty"),
        F.coalesce(F.col("discrepancy"), F.lit(0).cast("bigint")).alias("Discrepancy in Return Qty"),
        (F.col("qty") - F.col("discrepancy")).alias("Actual Return Qty"),
        F.col("reason").alias("Discrepancy Reason"), F.col("route_status_name").alias("Route Status"),
        "driver_id", F.col("driver_name").alias("Driver"))


ROLLUP_KEYS = ("City", "Date", "route_id", "Route", "sku_id", "SKU", "Route Status", "driver_id", "Driver")


def return_discrepancy_rollup(t, reasons: Sequence[str] = codes.RETURN_REASONS,
                              offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """Per city/day/route/SKU/driver: average app return qty and discrepancy per reason.

    "App Return Qty" = avg app qty + all reason discrepancies; "Actual Return Qty" =
    avg app qty (labels as defined by the report).
    """
    detail = return_discrepancy_detail(t, offset_hours).withColumn("Date", F.to_date("Time"))
    per_reason = [F.sum(F.when(F.col("Discrepancy Reason") == r, F.col("Discrepancy in Return Qty")).otherwise(0))
                  for r in reasons]
    total = per_reason[0]
    for p in per_reason[1:]:
        total = total + p
    agg = detail.groupBy(*ROLLUP_KEYS).agg(
        (F.avg("App Return Qty") + total).alias("App Return Qty"),
        *[p.alias(f"Discrepancy Due to {r}") for p, r in zip(per_reason, reasons)],
        F.avg("App Return Qty").alias("Actual Return Qty"))
    return agg.select("City", "Date", "route_id", "Route", "sku_id", "SKU", "App Return Qty",
                      *[f"Discrepancy Due to {r}" for r in reasons], "Actual Return Qty",
                      "Route Status", "driver_id", "Driver")


# ---------------------------------------------------------------------------
# funnel

FUNNEL_KEYS = ("City", "Delivery Date", "Seller Order Status", "route_id", "Route", "Route End Time", "Route Status",
               "driver_id", "Driver", "stop_id", "retailer_user_id", "Retailer Name", "Retailer Mobile", "order_id",
               "Fulfilment Mode", "sku_id", "SKU", "Category ID", "Category", "Sub-Category ID", "Sub-Category",
               "seller_id", "Seller", "Seller Invoice ID", "Commission Rate (%)")


def _weighted_base(t, orders: DataFrame, dedupe_logs: bool) -> DataFrame:
    """Funnel rows at (order, item, key-bearing dims) grain with fan-out weight ``_w``."""
    # users that have retailer rows: row count (fan-out) and the user's name/mobile
    ret_rows = t["retailers"].groupBy(F.col("user_id").alias("_ru")).agg(F.count(F.lit(1)).alias("_n_ret"))
    users = role(t["users"], {"id": "_uid", "name": "user_name", "mobile": "user_mobile"})
    retailer_users = ret_rows.join(users, F.col("_uid") == F.col("_ru"), "left").drop("_uid")
    log_rows = (t["transaction_logs"].groupBy(F.col("stop_id").alias("_log_stop"))
                .agg((F.lit(1) if dedupe_logs else F.count(F.lit(1))).alias("_n_log")))
    agent_rows = D.agent_dim(t).groupBy("agent_order_key").agg(F.count(F.lit(1)).alias("_n_agent"))
    route = D.route_dim(t).select("stop_ref", "stop_status", "stop_status_name", "route_id", "route_name",
                                  "route_status_name", "route_end_at", "driver_id", "driver_name")
    items = enrich_items(items_of(t), t)
    base = orders.join(retailer_users, F.col("user_id") == F.col("_ru"), "left")
    base = left_join_spread(base, route, "stop_id", "stop_ref", "id")
    base = left_join_spread(base, log_rows, "stop_id", "_log_stop", "id")
    base = (base.join(agent_rows, F.col("id") == F.col("agent_order_key"), "left")
            .join(D.invoice_dim(t), F.col("id") == F.col("inv_order_id"), "left"))
    base = with_items(base, items, t, orders)
    weight = (F.coalesce(F.col("_n_ret"), F.lit(1)) * F.coalesce(F.col("_n_log"), F.lit(1))
              * F.coalesce(F.col("_n_agent"), F.lit(1)))
    return base.withColumn("_w", weight)


def commission(gmv: Column, rate: Column) -> Column:
    """Rounded commission of a value at a percentage, in exact decimals (halves away from zero)."""
    return F.round(gmv.cast("decimal(20,4)") * rate.cast("decimal(12,6)") * F.lit(Decimal("0.01")), 0).cast("double")


SORT_KEYS = ("City", "Delivery Date", "route_id", "sku_id")


def _sort_order() -> list[Column]:
    """City, delivery date (newest first), route, SKU; NULLs as the report's engine places them (ASC last, DESC first)."""
    return [F.col("City").asc_nulls_last(), F.col("Delivery Date").desc_nulls_first(),
            F.col("route_id").asc_nulls_last(), F.col("sku_id").asc_nulls_last()]


def top_sort_keys(t, n: int, modes: Sequence[int] = (1, 2), offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """The first ``n`` distinct (City, Delivery Date, route_id, sku_id) of the funnel's rows.

    A narrow pass: the order's date and stop, the stop's route, the item's SKU and the SKU's city, no measures and no
    further dimension. Every key has a funnel row at least, so the report's first ``n`` rows all lie in these keys,
    those that tie at the cut included.
    """
    orders = real_delivered_orders(t, modes).select("id", "delivered_at", "stop_id")
    route = D.route_dim(t).select("stop_ref", "route_id")
    city = D.sku_item_dim(t, True).select("item_sku", "supplier_city")
    items = t["order_items"].select("order_id", "sku_id").join(city, F.col("sku_id") == F.col("item_sku"), "left").drop("item_sku")
    rows = with_items(left_join_spread(orders, route, "stop_id", "stop_ref", "id"), items, t, orders)
    keys = rows.select(F.col("supplier_city").alias("City"), local_date("delivered_at", offset_hours).alias("Delivery Date"),
                       "route_id", "sku_id").distinct()
    return keys.orderBy(*_sort_order()).limit(n)


def funnel(t, modes: Sequence[int] = (1, 2), offset_hours: int = LOCAL_OFFSET_HOURS, *,
           dedupe_logs: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """Ordered -> dispatched -> delivered -> returned per order/SKU/route/driver (25 keys).

    Sums repeat per transaction log of the order's stop; ``dedupe_logs`` counts one. ``keys``: only the groups with
    these few SORT_KEYS values (they are broadcast); orders of other days aren't joined at all."""
    orders = real_delivered_orders(t, modes)
    if keys is not None:
        days = keys.select(F.col("Delivery Date").alias("_day")).distinct()
        orders = orders.join(F.broadcast(days), local_date("delivered_at", offset_hours).eqNullSafe(F.col("_day")), "left_semi")
    base = _weighted_base(t, orders, dedupe_logs)
    facts = base.select(
        *fulfilment_measures(offset_hours),
        to_local("route_end_at", offset_hours).alias("Route End Time"),
        F.col("route_id"), F.col("route_name").alias("Route"), F.col("route_status_name").alias("Route Status"),
        F.col("driver_id"), F.col("driver_name").alias("Driver"), F.col("stop_id"),
        F.col("user_id").alias("retailer_user_id"), F.col("user_name").alias("Retailer Name"),
        F.col("user_mobile").alias("Retailer Mobile"), F.col("invoice_id").alias("Seller Invoice ID"), "_w")
    if keys is not None:
        wanted = keys.select(*[F.col(c).alias(f"_top {c}") for c in SORT_KEYS])
        same = [facts[c].eqNullSafe(wanted[f"_top {c}"]) for c in SORT_KEYS]
        facts = facts.join(F.broadcast(wanted), same, "left_semi")
    w = F.col("_w")

    def wsum(c: Column) -> Column:
        return F.sum(c * w)

    g = facts.groupBy(*FUNNEL_KEYS).agg(
        wsum(F.col("Qty Ordered")).alias("Qty Ordered"),
        wsum(F.col("Dispatched Qty")).alias("Dispatched Qty"),
        wsum(F.col("Delivered Qty")).alias("Delivered Qty"),
        wsum(F.col("Return Qty")).alias("Return Qty"),
        wsum(F.col("SS Qty")).alias("SS Qty"),
        wsum(F.col("Total Punched GMV")).alias("Total Punched GMV"),
        wsum(F.col("Total Punched GMV") - F.col("Ordered GMV")).alias("Pre-Dispatch Cancellation"),
        wsum(F.col("Ordered GMV")).alias("Ordered GMV"),
        wsum(F.col("Ordered GMV") - F.col("Dispatched GMV")).alias("Unfulfilled"),
        wsum(F.col("Dispatched GMV")).alias("Dispatched GMV"),
        wsum(F.col("Delivered GMV")).alias("Delivered GMV"),
        wsum(F.col("Bulk Discount")).alias("Bulk Discount"),
        wsum(F.col("Return GMV")).alias("Return GMV"),
    )
    money = ["Total Punched GMV", "Pre-Dispatch Cancellation", "Ordered GMV", "Unfulfilled", "Dispatched GMV",
             "Delivered GMV", "Bulk Discount", "Return GMV"]
    out = g.select(
        *[F.col(k).cast("double").alias(k) if k == "Commission Rate (%)" else F.col(k) for k in FUNNEL_KEYS],
        "Qty Ordered", "Dispatched Qty", "Delivered Qty", "Return Qty", "SS Qty",
        *[F.col(m).cast("double").alias(m) for m in money],
        commission(F.col("Delivered GMV"), F.col("Commission Rate (%)")).alias("Commission Value"),
        guarded_ratio(F.col("Dispatched GMV"), F.col("Ordered GMV")).alias("Fulfilled (Dispatched) GMV %"),
        guarded_ratio(F.col("Delivered GMV"), F.col("Dispatched GMV")).alias("D2N %"),
        guarded_ratio(F.col("Return GMV"), F.col("Dispatched GMV")).alias("D2R %"),
        # decimal difference before the cast keeps it exact
        (F.col("Delivered GMV") - F.col("Bulk Discount")).cast("double").alias("_net"),
    )
    return out


FUNNEL_OUT = (*FUNNEL_KEYS, "Qty Ordered", "Dispatched Qty", "Delivered Qty", "Return Qty", "SS Qty",
              "Total Punched GMV", "Pre-Dispatch Cancellation", "Ordered GMV", "Unfulfilled", "Dispatched GMV",
              "Delivered GMV", "Bulk Discount", "Commission Value", "Return GMV", "Fulfilled (Dispatched) GMV %",
              "D2N %", "D2R %")


def fulfilment_funnel(t, modes: Sequence[int] = (1, 2), offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    return funnel(t, modes, offset_hours).select(*FUNNEL_OUT)


def reconciled(t, modes: Sequence[int] = (1, 2), offset_hours: int = LOCAL_OFFSET_HOURS, *,
               dedupe_logs: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """Funnel with net-of-bulk-discount value and return qty minus counted returns.

    Each funnel row meets every roll-up row of its (route, SKU) — several days fan out.
    ``keys`` as in ``funnel``.
    """
    y = funnel(t, modes, offset_hours, dedupe_logs=dedupe_logs, keys=keys)
    rd = return_discrepancy_rollup(t, offset_hours=offset_hours).select(
        F.col("route_id").alias("_rd_route"), F.col("sku_id").alias("_rd_sku"),
        F.col("Actual Return Qty").alias("_rd_actual"))
    j = y.join(rd, (F.col("route_id") == F.col("_rd_route")) & (F.col("sku_id") == F.col("_rd_sku")), "left")
    return j.select(
        *FUNNEL_OUT,
        F.col("_net").alias("Delivered Value (Net of Bulk Discounts)"),
        (F.col("Return Qty") - F.coalesce(F.col("_rd_actual"), F.col("Return Qty").cast("double")))
        .alias("Discrepency in Returns(To be Charged)"))


def top_n(t, n: int = 500, modes: Sequence[int] = (1, 2), offset_hours: int = LOCAL_OFFSET_HOURS, *,
          dedupe_logs: bool = False) -> DataFrame:
    """First ``n`` reconciled rows by city, delivery date (newest first), route, SKU.

    The remaining columns break ties so the cut is deterministic. Late materialisation: a narrow pass ranks the four
    sort keys alone (``top_sort_keys``), and the funnel, its 25 keys and its dimensions are built for the at
    most ``n`` keys found. Both cuts are a per-partition top-n followed by one merge (``TakeOrderedAndProject``).
    """
    r = reconciled(t, modes, offset_hours, dedupe_logs=dedupe_logs, keys=top_sort_keys(t, n, modes, offset_hours))
    rest = [F.col(c).asc_nulls_last() for c in r.columns if c not in SORT_KEYS]
    return r.orderBy(*_sort_order(), *rest).limit(n)
