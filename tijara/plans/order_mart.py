"""Denormalised order mart: one row per order item with order, retailer, route,
payment and rule-based quantity / value columns (88 columns).

Plan shape
----------
* The order window is applied to ``orders`` first and its orders are written once, so that Spark plans with
  their real size: while it is small, no item, payment, stop or log is shuffled to be left out. The order ids of the window
  then semi-join the items and the payments, so value sums, payment pivot and
  de-duplication only touch the window's orders (exact: every item / payment of a
  kept order is kept).
* Order-grain dimensions join on user id, stop id, then order id; the SKU-level
  rows join last on order id, so DISTINCT runs on data already clustered by order.
* Order value is rolled up from order-SKU value (one scan, one aggregation tree).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tijara.functions import codes
from tijara.functions.rules import ItemCols, Rules
from tijara.functions.timeutil import LOCAL_OFFSET_HOURS, ntz, to_local
from tijara.operators.apportion import apportion
from tijara.operators.dims import category_parent, left_join_fact, left_join_spread
from tijara.operators.keyed import best_by_score, completeness_score, latest_per_key
from tijara.operators.pivot import payment_pivot
from tijara.plans import dimensions as D
from tijara.sources.io import stored

RULES = Rules(ItemCols())
PROFILE_FIELDS = ("phone", "store_name", "latlng", "area_id", "sub_area_id", "cnic_number", "address", "city_id")


# ---- parts ------------------------------------------------------------------


def order_items_dedup(items: DataFrame) -> DataFrame:
    """``SELECT DISTINCT * EXCEPT (id)``: duplicates that differ only in the surrogate id merge."""
    return items.drop("id").distinct()


def order_sku_value(items: DataFrame, orders: DataFrame, stops: DataFrame) -> DataFrame:
    """Per (order, SKU): value by the delivered rule (drop-ship nets picked qty) and punched value."""
    o = orders.select(F.col("id").alias("_oid"), "fulfilment_mode_id", "status", "stop_id")
    s = stops.select(F.col("id").alias("stop_ref"), "stop_status")
    # stops join the orders, at their grain; the items then meet one frame on the order id, which
    # also clusters the aggregation
    j = items.join(left_join_spread(o, s, "stop_id", "stop_ref", "_oid"), F.col("order_id") == F.col("_oid"), "left")
    return j.groupBy("order_id", "sku_id").agg(
        F.sum(RULES.value()).alias("totalpriceperordersku"),
        F.sum(F.col("price") * F.col("qty")).alias("punchedgmvperordersku"))


def order_value(sku_value: DataFrame) -> DataFrame:
    """Per order, rolled up from ``order_sku_value`` (equal to summing items directly)."""
    return sku_value.groupBy("order_id").agg(
        F.sum("totalpriceperordersku").alias("totalpriceperorder"),
        F.sum("punchedgmvperordersku").alias("PunchedGMVForFakeFlag"))


def retailer_scores(retailers: DataFrame) -> DataFrame:
    return retailers.withColumn("score", completeness_score(PROFILE_FIELDS))


def best_retailer_profile(retailers: DataFrame) -> DataFrame:
    """One retailer row per user: most complete profile, ties to the lowest ``copy_no``."""
    tiebreak = [F.col("copy_no").asc()] if "copy_no" in retailers.columns else []
    best = best_by_score(retailers, "user_id", completeness_score(PROFILE_FIELDS), tiebreak)
    return best.select("user_id", "phone", "store_name", "city_id", F.col("latlng.lat").alias("lat"),
                       F.col("latlng.lng").alias("lng"), "area_id", "sub_area_id", "cnic_number", "address",
                       *[c for c in ("store_type",) if c in best.columns], "score")


def latest_transaction_per_stop(logs: DataFrame) -> DataFrame:
    return latest_per_key(logs, "stop_id", "id")


PAY_MODES = tuple(codes.PAYMENT_MODE.values())


def payment_apportion(sku_value: DataFrame, value: DataFrame, pivot: DataFrame) -> DataFrame:
    """Order payment / return amounts split over the order's SKUs by value share."""
    v = value.select(F.col("order_id").alias("_vo"), "totalpriceperorder")
    p = pivot.withColumnRenamed("order_id", "_po")
    j = (sku_value.join(v, F.col("order_id") == F.col("_vo"), "left")
         .join(p, F.col("order_id") == F.col("_po"), "left"))
    part, whole = F.col("totalpriceperordersku"), F.col("totalpriceperorder")
    return j.select("order_id", "sku_id", *apportion_columns(part, whole))


def apportion_columns(part, whole) -> list:
    cols = [apportion(part, whole, F.col(f"amount_{m}")).alias(f"OrderPaymentAmount{m}") for m in PAY_MODES]
    cols += [apportion(part, whole, F.col(f"return_amount_{m}")).alias(f"ReturnAmount{m}") for m in PAY_MODES]
    return cols


# ---- the mart -----------------------------------------------------------------

MART_MONEY = ("Price", "TotalPunchedGMV", "TotalDeliveredGMV", "TotalCancelledGMV", "TotalPreDispatchCancelledGMV",
              "TotalPricePerOrderSKU", "TotalPricePerCancelledOrderSKU", "TotalCancelledOrderSKUPrice")


def order_denormalized(t, *, start: dt.datetime, end: dt.datetime, exclusive_seller: int,
                       offset_hours: int = LOCAL_OFFSET_HOURS, sort: bool = True) -> DataFrame:
    """The mart for orders created in ``[start, end)`` (UTC), fulfilled by any known
    mode or on a fully returned stop."""
    r = RULES
    orders = stored(t["orders"].where((F.col("created_at") >= ntz(start)) & (F.col("created_at") < ntz(end))), "window_orders")
    window_ids = orders.select(F.col("id").alias("_wid"))

    def in_window(df: DataFrame, key: str = "order_id") -> DataFrame:
        return df.join(window_ids, F.col(key) == F.col("_wid"), "left_semi")

    items = order_items_dedup(in_window(t["order_items"]))
    sku_value = order_sku_value(items, orders, t["stops"])
    value = order_value(sku_value).select(F.col("order_id").alias("_ov"), "totalpriceperorder")
    pivot = payment_pivot(in_window(t["order_payments"])).withColumnRenamed("order_id", "_pay")

    # SKU-level rows: item -> product (with its categories and their parents), variant,
    # SKU seller and supplier; product-keyed and SKU-keyed parts are pre-joined at their
    # own grain so the items meet each with one join
    products = t["products"].select(F.col("id").alias("product_ref"), F.col("name").alias("product_name"))
    bridge = t["product_categories"].select(F.col("product_id").alias("_pc_product"),
                                            F.col("category_id").alias("_pc_category"))
    tree = category_parent(t["categories"]).select(
        F.col("category_id").alias("_cat_ref"), F.col("category_name").alias("sub_category"),
        F.col("parent_name").alias("category"))
    product_dim = (products.join(bridge, F.col("product_ref") == F.col("_pc_product"), "left")
                   .join(tree, F.col("_pc_category") == F.col("_cat_ref"), "left")
                   .select("product_ref", "product_name", "sub_category", "category"))
    variants = t["product_variants"].select(F.col("id").alias("variant_ref"), F.col("name").alias("variant_name"))
    suppliers = t["suppliers"].select(F.col("user_id").alias("_sup_user"), "is_internal")
    sku_sellers = (D.seller_dim(t, with_supplier_city=False)  # keyed by SKU: met by the items with one join
                   .join(suppliers, F.col("psd_user_id") == F.col("_sup_user"), "left").drop("_sup_user"))
    skv = sku_value.select(F.col("order_id").alias("_sv_order"), F.col("sku_id").alias("_sv_sku"),
                           "totalpriceperordersku")
    lines = (items.join(product_dim, F.col("product_id") == F.col("product_ref"), "left")
             .join(variants, F.col("variant_id") == F.col("variant_ref"), "left")
             .join(sku_sellers, F.col("sku_id") == F.col("psd_sku_id"), "left")
             .join(skv, (F.col("order_id") == F.col("_sv_order")) & (F.col("sku_id") == F.col("_sv_sku")), "left"))

    cities = t["cities"].select(F.col("id").alias("_city_ref"), F.col("name").alias("city_name"),
                                           "is_exclusive")
    # per-key dimensions are computed for the window's keys only (exact: each key's
    # value depends on its own rows), so their cost follows the window, not the history
    window_users = orders.select(F.col("user_id").alias("_wu"))
    window_stops = orders.select(F.col("stop_id").alias("_ws"))
    retailers = D.retailer_dim(t, retailers=best_retailer_profile(
        t["retailers"].join(window_users, F.col("user_id") == F.col("_wu"), "left_semi")))
    route = D.route_dim(t, stops=t["stops"].join(window_stops, F.col("id") == F.col("_ws"), "left_semi"))
    logs = latest_transaction_per_stop(
        t["transaction_logs"].join(window_stops, F.col("stop_id") == F.col("_ws"), "left_semi")).select(
        F.col("id").alias("log_id"), F.col("stop_id").alias("_log_stop"), F.col("created_at").alias("log_created_at"))
    agents = D.agent_dim(t, order_ids=window_ids.select(F.col("_wid").alias("_oid")))

    j = (orders.join(cities, F.col("city_id") == F.col("_city_ref"), "left")
         .join(retailers, F.col("user_id") == F.col("r_user_id"), "left"))
    j = left_join_spread(j, route, "stop_id", "stop_ref", "id")
    j = left_join_spread(j, logs, "stop_id", "_log_stop", "id")
    j = (j.where(F.col("fulfilment_mode_id").isin(1, 2, 3) | (F.col("stop_status") == 5))
         .join(agents, F.col("id") == F.col("agent_order_key"), "left")
         .join(pivot, F.col("id") == F.col("_pay"), "left")
         .join(value, F.col("id") == F.col("_ov"), "left")
         .transform(lambda o: left_join_fact(o, lines, "id", "order_id", orders.select("id"), in_window(t["order_items"]))))

    part, whole = F.col("totalpriceperordersku"), F.col("totalpriceperorder")
    cancelled = F.col("status") == 6
    cols = [
        F.col("city_name").alias("city"),
        F.col("master_order_id").alias("MasterOrderID"),
        F.col("id").alias("OrderID"),
        F.col("is_fake"),
        codes.decode("fulfilment_mode_id", codes.FULFILMENT_MODE).alias("FulfilmentMode"),
        codes.decode("vertical_id", codes.VERTICAL).alias("Verticals"),
        to_local("created_at", offset_hours).alias("OrderCreatedAt"),
        to_local("delivered_at", offset_hours).alias("OrderDeliveredAt"),
        F.col("user_id").alias("UserID"),
        to_local("updated_at", offset_hours).alias("updated_at"),
        codes.decode("status", codes.ORDER_STATUS).alias("OrderStatus"),
        codes.decode("type", codes.ORDER_TYPE).alias("OrderType"),
        F.col("stop_id").alias("StopID_Orders"),
        codes.any_true(F.col("is_exclusive") == F.lit(True), F.col("psd_user_id") == exclusive_seller)
        .alias("PanPakistan"),
        F.col("product_name").alias("Product_Name"),
        F.col("product_ref").alias("PRODUCT_ID"),
        F.col("variant_ref").alias("Product Variant ID"),
        F.col("variant_name").alias("Product Variant Name"),
        F.col("sub_category").alias("SubCategory"),
        F.col("category").alias("Category"),
        F.col("price").alias("Price"),
        F.col("commission_value").cast("double").alias("CommissionPercentage"),
        r.actualized_commission().alias("ActualizedCommissions"),
        F.col("user_id").alias("CustomerUserID"),
        F.col("phone").alias("RetailerPhoneNumber"),
        F.col("store_name").alias("RetailerName"),
        F.col("lat").alias("RetailerLocationLat"),
        F.col("lng").alias("RetailerLocationLng"),
        F.col("r_area_id").alias("AreaID"),
        F.col("r_sub_area_id").alias("SubAreaID"),
        F.col("cnic_number").alias("RetailerCNIC_Number"),
        F.col("address").alias("RetailerAddress"),
        F.col("signup_agent").alias("SignupAgentName"),
        F.col("agent_id").alias("AgentID"),
        F.col("order_agent").alias("OrderAgentName"),
        F.col("driver_name").alias("DriverName"),
        F.col("driver_mobile").alias("DriverPhoneNumber"),
        F.col("psd_user_id").alias("SellerID"),
        F.col("seller_name").alias("SellerName"),
        F.col("seller_mobile").alias("SellerPhoneNumber"),
        F.col("area").alias("Area"),
        F.col("sub_area").alias("SubArea"),
        codes.tri_state("is_internal", *codes.SUPPLIER_TYPE).alias("SupplierType"),
        F.col("route_id").alias("RouteID"),
        F.col("route_name").alias("RouteName"),
        F.col("route_created_at").alias("RouteCreatedAt"),
        F.col("route_started_at").alias("RouteStartedAt"),
        F.col("route_end_at").alias("RouteEndTime"),
        F.col("route_status_name").alias("RouteStatus"),
        F.col("stop_ref").alias("StopID_Stops"),
        F.col("stop_status_name").alias("StopStatus"),
        to_local("log_created_at", offset_hours).alias("PaymentTime"),
        *apportion_columns(part, whole),
        r.qty_ordered().alias("QtyOrdered"),
        r.picked_qty().alias("PickedQty"),
        r.dispatched_qty().alias("DispatchedQty"),
        r.spot_sold_qty().alias("SpotSoldQty"),
        r.delivered_qty().alias("DeliveredQty"),
        r.return_qty().alias("ReturnQty"),
        r.cancelled_qty().alias("CancelledQty"),
        r.pre_dispatch_cancelled_qty().alias("PreDispatchCancelledQty"),
        F.col("qty").alias("OrderItemsQty"),
        r.punched_gmv().alias("TotalPunchedGMV"),
        r.delivered_gmv().alias("TotalDeliveredGMV"),
        r.cancelled_gmv().alias("TotalCancelledGMV"),
        r.pre_dispatch_cancelled_gmv().alias("TotalPreDispatchCancelledGMV"),
        r.delivered_qty().alias("TotalQty"),
        r.cancelled_qty().alias("TotalCancelledQty"),
        r.total_pre_dispatch_cancelled_qty().alias("TotalPreDispatchCancelledQty"),
        part.alias("TotalPricePerOrderSKU"),
        F.when(cancelled, part).otherwise(0).alias("TotalPricePerCancelledOrderSKU"),
        F.when(cancelled, F.col("price")).otherwise(0).alias("TotalCancelledOrderSKUPrice"),
        F.col("log_id").alias("TransactionID"),
        *[F.coalesce(F.col(f"amount_{m}"), F.lit(0)).cast("double").alias(f"TransactionAmount{m}") for m in PAY_MODES],
        *[F.coalesce(F.col(f"return_amount_{m}"), F.lit(0)).cast("double").alias(f"ReturnTransactionAmount{m}")
          for m in PAY_MODES],
    ]
    mart = j.select(*cols)
    mart = mart.select(*[F.col(c).cast("double").alias(c) if c in MART_MONEY else F.col(c)
                         for c in mart.columns]).distinct()
    if sort:
        mart = mart.orderBy("MasterOrderID", "OrderID", "OrderType", "OrderCreatedAt", "Product_Name",
                            "Product Variant Name")
    return mart
