"""Registration of every query (see ``tijara.registry``)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tijara.functions import codes
from tijara.functions.rules import ItemCols, Rules
from tijara.functions.timeutil import local_date, ntz, to_local
from tijara.operators.dims import category_descendants, category_parent, left_join_spread, role
from tijara.operators.tree import closure, subtree_values
from tijara.operators.pivot import payment_pivot
from tijara.plans import audit_log, audit_store, catalogue, fulfilment, item_facts, monthly_gmv, order_mart, retailer_performance, rfm
from tijara.plans import dimensions as D
from tijara.registry import (AS_OF, AUDIT_CUT_DATE, AUDIT_MONTH, EXCLUSIVE_SELLER, ORDER_WINDOW, RFM_START,
                             SIZE_THRESHOLD, SURVEY_PATTERNS, query)
from tijara.session import checkpoint_dir

# ---- drop-ship monthly GMV ------------------------------------------------


@query("monthly_delivered_gmv")
def q_monthly_delivered_gmv(t):
    return monthly_gmv.monthly_delivered_gmv(t, threshold=SIZE_THRESHOLD)


@query("dropship_item_facts")
def q_dropship_item_facts(t):
    return item_facts.dropship_item_facts(t)


@query("fanout_then_distinct")
def q_fanout_then_distinct(t):
    return monthly_gmv.dropship_distinct(t, threshold=SIZE_THRESHOLD)


# ---- fulfilment -----------------------------------------------------------


@query("return_discrepancy_detail")
def q_return_discrepancy_detail(t):
    return fulfilment.return_discrepancy_detail(t)


@query("return_discrepancy_rollup")
def q_return_discrepancy_rollup(t):
    return fulfilment.return_discrepancy_rollup(t)


@query("fulfilment_item_facts")
def q_fulfilment_item_facts(t):
    return item_facts.fulfilment_item_facts(t)


@query("fulfilment_funnel")
def q_fulfilment_funnel(t):
    return fulfilment.fulfilment_funnel(t)


@query("fulfilment_reconciled")
def q_fulfilment_reconciled(t):
    return fulfilment.reconciled(t)


@query("fulfilment_top_n")
def q_fulfilment_top_n(t):
    return fulfilment.top_n(t, 500)


# ---- order mart and its parts ---------------------------------------------


_R = Rules(ItemCols())


def _items_orders_stops(t):
    """Every order item with its order's codes and its stop (item grain).

    The stops join the orders, at their grain: joined to the items, all items of orders without a stop
    would go to one task.
    """
    o = t["orders"].select(F.col("id").alias("_oid"), "fulfilment_mode_id", "status", "type", "stop_id", "city_id",
                           "created_by")
    s = t["stops"].select(F.col("id").alias("stop_ref"), "stop_status")
    o = left_join_spread(o, s, "stop_id", "stop_ref", "_oid")
    return t["order_items"].join(o, F.col("order_id") == F.col("_oid"), "left")


@query("stops_projection")
def q_stops_projection(t):
    return t["stops"].select("id", "stop_status", "route_id")


@query("order_items_dedup")
def q_order_items_dedup(t):
    d = order_mart.order_items_dedup(t["order_items"])
    return d.select(*[F.col(c).cast("double").alias(c) if c in ("price", "discount", "commission_value") else F.col(c)
                      for c in d.columns])


@query("order_status_decode")
def q_order_status_decode(t):
    return t["orders"].select(
        "id", codes.decode("status", codes.ORDER_STATUS).alias("OrderStatus"),
        codes.decode("type", codes.ORDER_TYPE).alias("OrderType"),
        codes.decode("fulfilment_mode_id", codes.FULFILMENT_MODE).alias("FulfilmentMode"),
        codes.decode("vertical_id", codes.VERTICAL).alias("Verticals"))


@query("order_status_text")
def q_order_status_text(t):
    return t["orders"].select("id", F.col("status").alias("order_status_code"),
                              codes.decode("status", codes.ORDER_STATUS_SHORT, default="").alias("order_status_text"))


@query("payment_mode_decode")
def q_payment_mode_decode(t):
    return t["order_payments"].select("order_id", "payment_types_id",
                                      codes.decode("payment_types_id", codes.PAYMENT_MODE, default=None)
                                      .alias("paymentmode"))


@query("flag_and_tri_state")
def q_flag_and_tri_state(t):
    cities = t["cities"].select(F.col("id").alias("_city_ref"), "is_exclusive")
    psd = t["product_sku_details"].select(F.col("sku_id").alias("_psd_sku"), F.col("user_id").alias("_psd_user"))
    sup = t["suppliers"].select(F.col("user_id").alias("_sup_user"), "is_internal")
    j = (_items_orders_stops(t).join(cities, F.col("city_id") == F.col("_city_ref"), "left")
         .join(psd, F.col("sku_id") == F.col("_psd_sku"), "left")
         .join(sup, F.col("_psd_user") == F.col("_sup_user"), "left"))
    return j.select("order_id", "sku_id",
                    codes.any_true(F.col("is_exclusive") == F.lit(True), F.col("_psd_user") == EXCLUSIVE_SELLER)
                    .alias("PanPakistan"),
                    codes.tri_state("is_internal", *codes.SUPPLIER_TYPE).alias("SupplierType"))


@query("order_channel_size_class")
def q_order_channel_size_class(t):
    gmv = _R.ds_ordered_gmv()
    return _items_orders_stops(t).select(
        "order_id", "sku_id", gmv.cast("double").alias("Ordered GMV"),
        codes.presence_flag("created_by", *codes.ORDER_CHANNEL).alias("Order Channel"),
        codes.size_class(gmv, SIZE_THRESHOLD).alias("RDS/BULK Classification"))


@query("retailer_completeness_score")
def q_retailer_completeness_score(t):
    return order_mart.retailer_scores(t["retailers"]).select("user_id", "copy_no", "score")


@query("local_time_shift")
def q_local_time_shift(t):
    return t["orders"].select("id", to_local("created_at").alias("OrderCreatedAt"),
                              to_local("delivered_at").alias("OrderDeliveredAt"),
                              local_date("delivered_at").alias("System Delivery Date"))


@query("item_quantity_rules")
def q_item_quantity_rules(t):
    return _items_orders_stops(t).select(
        "order_id", "sku_id", "fulfilment_mode_id", "status", "type", "stop_status",
        _R.qty_ordered().alias("QtyOrdered"), _R.picked_qty().alias("PickedQty"),
        _R.dispatched_qty().alias("DispatchedQty"), _R.spot_sold_qty().alias("SpotSoldQty"),
        _R.delivered_qty().alias("DeliveredQty"), _R.return_qty().alias("ReturnQty"),
        _R.cancelled_qty().alias("CancelledQty"), _R.pre_dispatch_cancelled_qty().alias("PreDispatchCancelledQty"),
        _R.total_pre_dispatch_cancelled_qty().alias("TotalPreDispatchCancelledQty"))


@query("item_gmv_measures")
def q_item_gmv_measures(t):
    cancelled = F.col("status") == 6
    return _items_orders_stops(t).select(
        "order_id", "sku_id",
        _R.punched_gmv().cast("double").alias("TotalPunchedGMV"),
        _R.delivered_gmv().cast("double").alias("TotalDeliveredGMV"),
        _R.cancelled_gmv().cast("double").alias("TotalCancelledGMV"),
        _R.pre_dispatch_cancelled_gmv().cast("double").alias("TotalPreDispatchCancelledGMV"),
        F.when(cancelled, F.col("price")).otherwise(0).cast("double").alias("TotalCancelledOrderSKUPrice"))


@query("actualized_commission")
def q_actualized_commission(t):
    return _items_orders_stops(t).select(
        "order_id", "sku_id", F.col("commission_value").cast("double").alias("CommissionPercentage"),
        _R.actualized_commission().alias("ActualizedCommissions"))


@query("filter_delivered_real")
def q_filter_delivered_real(t):
    return (t["orders"].where(F.col("delivered_at").isNotNull() & (F.col("is_fake") == F.lit(False))
                              & F.col("fulfilment_mode_id").isin(1, 2))
            .select("id", "user_id", "status", "fulfilment_mode_id", "delivered_at"))


@query("order_window_filter")
def q_order_window_filter(t):
    start, end = ORDER_WINDOW
    o = t["orders"].where((F.col("created_at") >= ntz(start)) & (F.col("created_at") < ntz(end)))
    s = t["stops"].select(F.col("id").alias("stop_ref"), "stop_status")
    return (o.join(s, F.col("stop_id") == F.col("stop_ref"), "left")
            .where(F.col("fulfilment_mode_id").isin(1, 2, 3) | (F.col("stop_status") == 5))
            .select("id", "created_at", "fulfilment_mode_id", "stop_status"))


@query("latest_transaction_per_stop")
def q_latest_transaction_per_stop(t):
    return order_mart.latest_transaction_per_stop(t["transaction_logs"]).select("id", "stop_id", "created_at")


@query("retailer_best_profile")
def q_retailer_best_profile(t):
    return order_mart.best_retailer_profile(t["retailers"]).drop("store_type")


@query("payment_pivot")
def q_payment_pivot(t):
    p = payment_pivot(t["order_payments"])
    return p.select("order_id", *[F.col(c).cast("double").alias(c) for c in p.columns if c != "order_id"])


def _sku_value(t):
    return order_mart.order_sku_value(order_mart.order_items_dedup(t["order_items"]), t["orders"], t["stops"])


@query("order_sku_value")
def q_order_sku_value(t):
    return _sku_value(t).select("order_id", "sku_id",
                                F.col("totalpriceperordersku").cast("double").alias("totalpriceperordersku"))


@query("order_value")
def q_order_value(t):
    return order_mart.order_value(_sku_value(t)).select(
        "order_id", F.col("totalpriceperorder").cast("double").alias("totalpriceperorder"),
        F.col("PunchedGMVForFakeFlag").cast("double").alias("PunchedGMVForFakeFlag"))


@query("payment_apportion")
def q_payment_apportion(t):
    sv = _sku_value(t)
    return order_mart.payment_apportion(sv, order_mart.order_value(sv), payment_pivot(t["order_payments"]))


@query("order_denormalized")
def q_order_denormalized(t):
    start, end = ORDER_WINDOW
    return order_mart.order_denormalized(t, start=start, end=end, exclusive_seller=EXCLUSIVE_SELLER)


# ---- catalogue --------------------------------------------------------------


@query("commission_rate_card")
def q_commission_rate_card(t):
    return catalogue.commission_rate_card(t)


@query("sku_catalogue")
def q_sku_catalogue(t):
    return catalogue.sku_catalogue(t)


@query("category_parent_lookup")
def q_category_parent_lookup(t):
    return category_parent(t["categories"])


@query("category_descend")
def q_category_descend(t):
    return category_descendants(t["categories"])


@query("category_closure")
def q_category_closure(t):
    return closure(t["categories"], "id", "parent_id")


@query("category_subtree_products")
def q_category_subtree_products(t):
    """Products of each category's whole subtree; a product in several of its categories counts once."""
    tree = closure(t["categories"], "id", "parent_id")
    held = subtree_values(tree, t["product_categories"], "category_id", F.count_distinct("product_id").alias("products"))
    return (t["categories"].select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
            .join(held, F.col("category_id") == F.col("ancestor_id"), "left")
            .select("category_id", "category_name", F.coalesce("products", F.lit(0)).alias("products")))


# ---- joins ------------------------------------------------------------------


@query("left_join_null_rejecting")
def q_left_join_null_rejecting(t):
    """Products' category paths kept only when the parent name names a category
    (a left join filtered on the joined side is an inner join)."""
    pc = t["product_categories"]
    tree = (category_parent(t["categories"]).select(
        F.col("category_id").alias("_cid"), F.col("category_name").alias("sub_category"),
        F.col("parent_name").alias("category")))
    by_name = t["categories"].select(F.col("id").alias("matched_category_id"), F.col("name").alias("_mname"))
    return (pc.join(tree, F.col("category_id") == F.col("_cid"), "left")
            .join(by_name, F.col("category") == F.col("_mname"), "inner")
            .select("product_id", "category_id", "sub_category", "category", "matched_category_id"))


@query("order_item_enriched")
def q_order_item_enriched(t):
    items = t["order_items"].select("order_id", "sku_id")
    e = (items.join(D.sku_catalogue_dim(t), F.col("sku_id") == F.col("sku_ref"), "left")
         .join(D.seller_dim(t), F.col("sku_id") == F.col("psd_sku_id"), "left"))
    return e.select("order_id", "sku_id", F.col("product_name").alias("SKU"), "sub_category_id", "sub_category",
                    "category_id", "category", "seller_id", "seller_name", "supplier_city")


@query("role_playing_dimension")
def q_role_playing_dimension(t):
    customers = role(t["users"], {"id": "_cu", "name": "customer_name", "refer_by": "_refer"})
    signup = role(t["users"], {"id": "signup_agent_id", "name": "signup_agent_name"})
    stops = t["stops"].select(F.col("id").alias("_stop"), F.col("route_id").alias("_route"))
    routes = t["routes"].select(F.col("id").alias("_rid"), F.col("user_id").alias("_ruser"))
    drivers = role(t["users"], {"id": "driver_id", "name": "driver_name"})
    return (t["orders"].join(customers, F.col("_cu") == F.col("user_id"), "left")
            .join(signup, F.col("signup_agent_id") == F.col("_refer"), "left")
            .join(stops, F.col("_stop") == F.col("stop_id"), "left")
            .join(routes, F.col("_rid") == F.col("_route"), "left")
            .join(drivers, F.col("driver_id") == F.col("_ruser"), "left")
            .select("id", "customer_name", "signup_agent_id", "signup_agent_name", "driver_id", "driver_name"))


@query("cast_key_join")
def q_cast_key_join(t):
    return (t["orders"].join(D.agent_dim(t), F.col("id") == F.col("agent_order_key"), "left")
            .select("id", "agent_id", "order_agent_id", "order_agent"))


# ---- audit log ----------------------------------------------------------------


@query("audit_message_filter")
def q_audit_message_filter(t):
    return audit_log.message_filter(t["activity_logs"]).select("event_id", "payload")


@query("audit_log_typed")
def q_audit_log_typed(t):
    return audit_log.audit_log_typed(t["activity_logs"], AUDIT_MONTH)


@query("audit_numeric_ids")
def q_audit_numeric_ids(t):
    return audit_log.audit_numeric_ids(t["activity_logs"])


@query("audit_log_text")
def q_audit_log_text(t):
    return audit_log.audit_log_text(t["activity_logs"])


@query("audit_log_since")
def q_audit_log_since(t):
    return audit_log.audit_log_since(t["activity_logs"], AUDIT_CUT_DATE)


def _audit_store(t):
    """The log written to a store of its own in the shared checkpoint folder."""
    logs = t["activity_logs"]
    path = f"{checkpoint_dir(logs.sparkSession)}/audit-store-{uuid.uuid4().hex}"
    audit_store.append(logs, path)
    return audit_store.read(logs.sparkSession, path)


@query("audit_store_typed")
def q_audit_store_typed(t):
    return audit_store.log_typed(_audit_store(t), AUDIT_MONTH)


@query("audit_store_since")
def q_audit_store_since(t):
    return audit_store.log_since(_audit_store(t), AUDIT_CUT_DATE)


@query("audit_store_numeric_ids")
def q_audit_store_numeric_ids(t):
    return audit_store.numeric_ids(_audit_store(t))


# ---- RFM ----------------------------------------------------------------------


@query("quarter_calendar")
def q_quarter_calendar(t):
    """The calendar quarters of the RFM spine (the calendar as the report joins it)."""
    return rfm.calendar(item_facts.gmv_mart(t), RFM_START, AS_OF)


@query("rfm_quarter_metrics")
def q_rfm_quarter_metrics(t):
    return rfm.quarter_metrics(item_facts.gmv_mart(t), RFM_START)


@query("quarter_user_spine")
def q_quarter_user_spine(t):
    return rfm.quarter_user_spine(item_facts.gmv_mart(t), RFM_START, AS_OF)


@query("rfm_cumulative")
def q_rfm_cumulative(t):
    return rfm.cumulative(item_facts.gmv_mart(t), RFM_START, AS_OF)


@query("rfm_report")
def q_rfm_report(t):
    return rfm.report(item_facts.gmv_mart(t), RFM_START, AS_OF)


# ---- retailer performance ---------------------------------------------------------


@query("last_two_order_dates")
def q_last_two_order_dates(t):
    return retailer_performance.last_two_order_dates(item_facts.gmv_mart(t))


@query("customer_metrics")
def q_customer_metrics(t):
    return retailer_performance.customer_metrics(item_facts.gmv_mart(t))


@query("latest_survey_answer")
def q_latest_survey_answer(t):
    return retailer_performance.latest_survey_answer(t["nps_results"], t["nps_surveys"], SURVEY_PATTERNS)


@query("retailer_last3m_totals")
def q_retailer_last3m_totals(t):
    return retailer_performance.last3m_totals(item_facts.gmv_mart(t), AS_OF)


@query("retailer_performance")
def q_retailer_performance(t):
    return retailer_performance.retailer_performance(t, item_facts.gmv_mart(t), as_of=AS_OF, patterns=SURVEY_PATTERNS)
