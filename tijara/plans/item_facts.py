"""Item-level fact rows: fulfilment facts, drop-ship facts, and ``all_gmv``.

Join order is chosen for shuffles, not copied from the source text:

1. filter orders first (delivered, real, fulfilment modes) -> pushed into the scan;
2. user-keyed then stop-keyed dimensions (one shuffle of the orders per key);
3. order-id-keyed dimensions and finally the SKU-enriched items, so the result
   leaves hash-partitioned by order id — any later DISTINCT / GROUP BY whose keys
   include the order id then runs without another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tijara.functions import codes
from tijara.functions.rules import ItemCols, Rules
from tijara.functions.timeutil import LOCAL_OFFSET_HOURS, local_date, to_local
from tijara.operators.dims import left_join_fact, left_join_spread, role
from tijara.operators.keyed import latest_per_key
from tijara.plans import dimensions as D

RULES = Rules(ItemCols())

ITEM_COLS = ("order_id", "product_id", "variant_id", "sku_id", "price", "qty", "picked_qty", "return_qty",
             "discount", "commission_value", "seller_status", "updated_at")


def items_of(t) -> DataFrame:
    return t["order_items"].select(*ITEM_COLS)


def enrich_items(items: DataFrame, t, *, supplier_city: bool = True) -> DataFrame:
    """Items with catalogue, category and seller, met with one join on the SKU."""
    return items.join(D.sku_item_dim(t, supplier_city), F.col("sku_id") == F.col("item_sku"), "left").drop("item_sku")


def real_delivered_orders(t, modes: Sequence[int]) -> DataFrame:
    o = t["orders"]
    return o.where(F.col("delivered_at").isNotNull() & (F.col("is_fake") == F.lit(False))
                   & F.col("fulfilment_mode_id").isin(*modes))


def with_items(orders: DataFrame, items: DataFrame, t, order_ids: DataFrame) -> DataFrame:
    """``orders LEFT JOIN items`` on the order id; ``order_ids`` (column id) are the same orders."""
    return left_join_fact(orders, items, "id", "order_id", order_ids.select("id"), t["order_items"])


def transaction_log_rows(t, dedupe_logs: bool = False) -> DataFrame:
    """Transaction logs by stop; with ``dedupe_logs`` only each stop's newest one."""
    logs = latest_per_key(t["transaction_logs"], "stop_id", "id") if dedupe_logs else t["transaction_logs"]
    return logs.select(F.col("stop_id").alias("log_stop_id"), F.col("created_at").alias("log_created_at"))


def fulfilment_base(t, modes: Sequence[int] = (1, 2), dedupe_logs: bool = False) -> DataFrame:
    """Every joined row of the fulfilment item facts (all fan-out kept, but for the logs' if wanted)."""
    orders = real_delivered_orders(t, modes)
    items = enrich_items(items_of(t), t)
    # retailer copies per user and logs per stop fan out: those rows are the output
    # itself (the aggregating funnel counts them instead, see plans.fulfilment)
    base = orders.join(D.retailer_dim(t), F.col("user_id") == F.col("r_user_id"), "left")
    base = left_join_spread(base, D.route_dim(t), "stop_id", "stop_ref", "id")
    base = left_join_spread(base, transaction_log_rows(t, dedupe_logs), "stop_id", "log_stop_id", "id")
    base = (base.join(D.agent_dim(t), F.col("id") == F.col("agent_order_key"), "left")
            .join(D.invoice_dim(t), F.col("id") == F.col("inv_order_id"), "left"))
    return with_items(base, items, t, orders)


def fulfilment_measures(offset_hours: int = LOCAL_OFFSET_HOURS) -> list:
    r = RULES
    return [
        F.col("supplier_city").alias("City"),
        F.col("id").alias("order_id"),
        to_local("created_at", offset_hours).alias("Order Date"),
        local_date("delivered_at", offset_hours).alias("Delivery Date"),
        F.col("status").alias("order_status"),
        F.col("stop_status"),
        F.col("stop_status_name").alias("Stop Status"),
        F.col("seller_status").alias("Seller Order Status"),
        F.col("sku_id"),
        F.col("product_name").alias("SKU"),
        F.col("price").alias("Order Price"),
        r.bulk_discount().alias("Bulk Discount"),
        F.col("sub_category_id").alias("Sub-Category ID"),
        F.col("sub_category").alias("Sub-Category"),
        F.col("category_id").alias("Category ID"),
        F.col("category").alias("Category"),
        F.col("seller_id"),
        F.col("seller_name").alias("Seller"),
        F.col("invoice_id"),
        codes.decode("fulfilment_mode_id", codes.FULFILMENT_MODE).alias("Fulfilment Mode"),
        r.funnel_qty_ordered().alias("Qty Ordered"),
        r.funnel_dispatched_qty().alias("Dispatched Qty"),
        r.funnel_spot_sold_qty().alias("SS Qty"),
        r.delivered_qty().alias("Delivered Qty"),
        r.funnel_return_qty().alias("Return Qty"),
        r.funnel_punched_gmv().alias("Total Punched GMV"),
        r.funnel_ordered_gmv().alias("Ordered GMV"),
        r.funnel_dispatched_gmv().alias("Dispatched GMV"),
        r.delivered_gmv().alias("Delivered GMV"),
        F.col("commission_value").alias("Commission Rate (%)"),
        r.funnel_return_gmv().alias("Return GMV"),
    ]


FULFILMENT_MONEY = ("Order Price", "Bulk Discount", "Total Punched GMV", "Ordered GMV", "Dispatched GMV",
                    "Delivered GMV", "Commission Rate (%)", "Return GMV")


def fulfilment_item_facts(t, modes: Sequence[int] = (1, 2), offset_hours: int = LOCAL_OFFSET_HOURS, *,
                          dedupe_logs: bool = False) -> DataFrame:
    """One row per joined (order, item, log, agent, retailer row, ...) combination."""
    base = fulfilment_base(t, modes, dedupe_logs)
    cols = fulfilment_measures(offset_hours) + [
        to_local("log_created_at", offset_hours).alias("Payment/Delivery Time"),
        F.col("user_id"), F.col("user_name").alias("User Name"), F.col("user_mobile").alias("mobile"),
        F.col("store_name"), F.col("address"), F.col("latlng.lat").alias("lat"), F.col("latlng.lng").alias("lng"),
        F.col("area").alias("Area"), F.col("sub_area").alias("Sub-Area"),
        F.col("stop_id"), F.col("route_id"), F.col("route_name").alias("Route"),
        F.col("route_status_name").alias("Route Status"),
        to_local("route_started_at", offset_hours).alias("Route Start Time"),
        to_local("route_end_at", offset_hours).alias("Route End Time"),
        F.col("driver_id"), F.col("driver_name").alias("Driver"),
        F.col("order_agent_id"), F.col("order_agent").alias("Order Agent"),
        F.col("signup_agent_id"), F.col("signup_agent").alias("Signup Agent"),
    ]
    out = base.select(*cols)
    return out.select(*[F.col(c).cast("double").alias(c) if c in FULFILMENT_MONEY else F.col(c) for c in out.columns])


# ---------------------------------------------------------------------------
# drop-ship (monthly GMV) facts


def dropship_measures(offset_hours: int = LOCAL_OFFSET_HOURS) -> list:
    r = RULES
    return [
        F.col("retailer_city").alias("City"),
        F.col("master_order_id"),
        F.col("id").alias("order_id"),
        to_local("created_at", offset_hours).alias("Order Time"),
        local_date("delivered_at", offset_hours).alias("System Delivery Date"),
        local_date("delivery_date_time", offset_hours).alias("Actual Delivery Date"),
        to_local("delivery_date_time", offset_hours).alias("Actual Delivery Time"),
        F.col("status").alias("order_status_code"),
        codes.decode("status", codes.ORDER_STATUS_SHORT, default="").alias("order_status_text"),
        F.col("cancel_reason").alias("Cancellation Reason"),
        F.col("sku_id"),
        F.col("product_name").alias("SKU"),
        F.col("price").alias("Order Price"),
        F.col("category").alias("Category"),
        F.col("sub_category").alias("Sub-Category"),
        F.col("seller_id"),
        F.col("seller_name").alias("Seller"),
        r.ds_qty_ordered().alias("Qty Ordered"),
        r.ds_delivered_qty().alias("Delivered Qty"),
        r.cancelled_qty().alias("Cancelled Qty"),
        r.ds_ordered_gmv().alias("Ordered GMV"),
        r.ds_delivered_gmv().alias("Delivered GMV"),
        F.col("commission_value").alias("Commission Rate (%)"),
        r.ds_commission_value().alias("Commission Value"),
        (r.cancelled_qty() * F.col("price")).alias("Cancelled GMV"),
        F.col("user_id"),
        F.col("user_name").alias("User Name"),
        F.col("user_mobile").alias("mobile"),
        F.col("store_name"), F.col("address"),
        F.col("latlng.lat").alias("lat"), F.col("latlng.lng").alias("lng"),
        F.col("area").alias("Area"), F.col("sub_area").alias("Sub-Area"),
        F.col("order_agent_id"), F.col("order_agent").alias("Order Agent"),
        F.col("signup_agent_id"), F.col("signup_agent").alias("Signup Agent"),
        codes.presence_flag("created_by", *codes.ORDER_CHANNEL).alias("Order Channel"),
    ]


DROPSHIP_MONEY = ("Order Price", "Ordered GMV", "Delivered GMV", "Commission Rate (%)", "Cancelled GMV")


def dropship_base(t, *, modes: Sequence[int] = (3,), with_fanout_only_joins: bool = True,
                  dedupe_logs: bool = False) -> DataFrame:
    """Drop-ship order items with every dimension of the monthly report.

    The stop/route/log joins add no column; they only repeat rows. They are kept
    for the row-level facts and skipped when the caller applies DISTINCT.
    """
    orders = real_delivered_orders(t, modes)
    reasons = role(t["cancellation_reasons"], {"id": "_cr_ref", "description": "cancel_reason"})
    items = enrich_items(items_of(t), t, supplier_city=False)
    base = (orders.join(reasons, F.col("cancel_reason_id") == F.col("_cr_ref"), "left")
            .join(D.retailer_dim(t, with_city=True), F.col("user_id") == F.col("r_user_id"), "left"))
    if with_fanout_only_joins:
        base = left_join_spread(base, D.route_dim(t).select("stop_ref", "route_id"), "stop_id", "stop_ref", "id")
        base = left_join_spread(base, transaction_log_rows(t, dedupe_logs), "stop_id", "log_stop_id", "id")
    base = base.join(D.agent_dim(t), F.col("id") == F.col("agent_order_key"), "left")
    return with_items(base, items, t, orders)


def dropship_item_facts(t, offset_hours: int = LOCAL_OFFSET_HOURS, *, money_as_double: bool = True,
                        with_fanout_only_joins: bool = True, dedupe_logs: bool = False) -> DataFrame:
    out = dropship_base(t, with_fanout_only_joins=with_fanout_only_joins, dedupe_logs=dedupe_logs).select(*dropship_measures(offset_hours))
    if not money_as_double:
        return out
    return out.select(*[F.col(c).cast("double").alias(c) if c in DROPSHIP_MONEY else F.col(c) for c in out.columns])


# ---------------------------------------------------------------------------
# all_gmv: the item fact mart read by the RFM and retailer-performance jobs


def all_gmv(t, offset_hours: int = LOCAL_OFFSET_HOURS) -> DataFrame:
    """Item-grain GMV facts of real, delivered-stage orders across all fulfilment modes.

    Columns: order_id, user_id, sku_id, fulfilment_mode_id, order_status_code,
    System_Delivery_Date, Category (parent category; fans out per product category),
    Ordered_GMV, Dispatched_GMV, Delivered_GMV, Return_GMV (DECIMAL), delivered_orders
    (the order id when delivered/closed, else NULL).
    """
    o = t["orders"].where(F.col("delivered_at").isNotNull() & (F.col("is_fake") == F.lit(False)))
    stops = t["stops"].select(F.col("id").alias("stop_ref"), "stop_status")
    cats = D.sku_catalogue_dim(t).select("sku_ref", "category")
    items = items_of(t).join(cats, F.col("sku_id") == F.col("sku_ref"), "left")
    r = RULES
    return (with_items(left_join_spread(o, stops, "stop_id", "stop_ref", "id"), items, t, o)
            .select(F.col("id").alias("order_id"), "user_id", "sku_id", "fulfilment_mode_id",
                    F.col("status").alias("order_status_code"),
                    local_date("delivered_at", offset_hours).alias("System_Delivery_Date"),
                    F.col("category").alias("Category"),
                    r.funnel_ordered_gmv().alias("Ordered_GMV"),
                    r.funnel_dispatched_gmv().alias("Dispatched_GMV"),
                    r.delivered_gmv().alias("Delivered_GMV"),
                    r.funnel_return_gmv().alias("Return_GMV"),
                    F.when(r.delivered(), F.col("id")).alias("delivered_orders")))


GMV_PARTITION = "delivery_quarter"


def gmv_mart(t) -> DataFrame:
    """``all_gmv`` from the tables when present (a persisted mart), else derived."""
    return t["all_gmv"] if "all_gmv" in t else all_gmv(t)


def delivered_since(gmv: DataFrame, start) -> DataFrame:
    """Facts with ``System_Delivery_Date >= start``.

    On the persisted mart (partitioned by delivery quarter) the implied bound on the
    partition column is added as well, so only the quarters from ``start`` on are listed
    and read (partition pruning); on a derived frame it is the plain filter.
    """
    from tijara.functions.timeutil import date_lit, quarter_start

    cond = F.col("System_Delivery_Date") >= date_lit(start)
    if GMV_PARTITION in gmv.columns:
        cond = cond & (F.col(GMV_PARTITION) >= quarter_start(date_lit(start)))
    return gmv.where(cond)
