"""Pre-joined dimensions shared by the item-level jobs.

A left-join chain ``fact ⟕ A ⟕ B ⟕ C`` whose later join conditions only touch A/B/C
equals ``fact ⟕ (A ⟕ B ⟕ C)``. So each chain hanging off the fact is built once
as a dimension keyed the way the fact meets it, and the fact meets each dimension
with one equi join. Dimensions are grouped by the fact key they use so consecutive
joins share one shuffle of the fact:

* SKU side (item ``sku_id``):   catalogue/category dim, seller/supplier dim
* order side (``user_id``):     retailer dim (retailer rows, user, areas, signup agent)
* order side (``stop_id``):     route dim (stop, route, driver, route end), transaction logs
* order side (order ``id``):    agent dim, invoice, then the items themselves

Primary-key columns named ``id`` (users, routes, stops, categories, products, SKUs,
code tables) are unique; bridge tables and retailers may hold several rows per key
and fan out exactly as the source joins do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tijara.operators.dims import canonical_int_key, category_parent, role


def sku_catalogue_dim(t) -> DataFrame:
    """SKU -> product -> product categories -> category -> parent category.

    Keyed by ``sku_ref`` (product_sku.id); fans out over product categories.
    """
    sku = t["product_sku"].select(F.col("id").alias("sku_ref"), F.col("product_id").alias("_sku_product"))
    products = t["products"].select(F.col("id").alias("_product_ref"), F.col("name").alias("product_name"))
    bridge = t["product_categories"].select(F.col("product_id").alias("_pc_product"),
                                            F.col("category_id").alias("_pc_category"))
    tree = category_parent(t["categories"]).select(
        F.col("category_id").alias("sub_category_id"), F.col("category_name").alias("sub_category"),
        F.col("parent_ref").alias("category_id"), F.col("parent_name").alias("category"))
    out = (sku.join(products, F.col("_sku_product") == F.col("_product_ref"), "left")
           .join(bridge, F.col("_product_ref") == F.col("_pc_product"), "left")
           .join(tree, F.col("_pc_category") == F.col("sub_category_id"), "left"))
    return out.select("sku_ref", F.col("_product_ref").alias("product_ref"), "product_name", "sub_category_id",
                      "sub_category", "category_id", "category")


def seller_dim(t, with_supplier_city: bool = True) -> DataFrame:
    """SKU -> SKU details -> seller user (-> supplier -> supplier city). Keyed by ``psd_sku_id``."""
    psd = t["product_sku_details"].select(F.col("sku_id").alias("psd_sku_id"), F.col("user_id").alias("psd_user_id"))
    sellers = role(t["users"], {"id": "seller_id", "name": "seller_name", "mobile": "seller_mobile"})
    out = psd.join(sellers, F.col("seller_id") == F.col("psd_user_id"), "left")
    if with_supplier_city:
        sup = t["suppliers"].select(F.col("user_id").alias("_sup_user"), F.col("city_id").alias("_sup_city"),
                                    F.col("is_internal").alias("supplier_is_internal"))
        cities = role(t["cities"], {"id": "_city_ref", "name": "supplier_city"})
        out = (out.join(sup, F.col("psd_user_id") == F.col("_sup_user"), "left")
               .join(cities, F.col("_sup_city") == F.col("_city_ref"), "left")
               .drop("_sup_user", "_sup_city", "_city_ref"))
    return out


def sku_item_dim(t, with_supplier_city: bool = True) -> DataFrame:
    """Everything an item meets by its SKU, keyed by ``item_sku``: catalogue and seller side by side.

    ``items ⟕ catalogue ⟕ seller`` on one key equals ``items ⟕ (catalogue FULL JOIN seller)``, so items
    need one join, whose hot SKUs adaptive execution can split.
    """
    both = sku_catalogue_dim(t).join(seller_dim(t, with_supplier_city), F.col("sku_ref") == F.col("psd_sku_id"), "full")
    return both.withColumn("item_sku", F.coalesce("sku_ref", "psd_sku_id")).where("item_sku is not null")


def retailer_dim(t, *, retailers: DataFrame | None = None, with_city: bool = False) -> DataFrame:
    """Retailer rows of a user with user, areas and signup agent. Keyed by ``r_user_id``.

    ``retailers`` defaults to the raw table (several rows per user fan out);
    pass a one-row-per-user selection to avoid that.
    """
    r = (retailers if retailers is not None else t["retailers"])
    r = r.select(F.col("user_id").alias("r_user_id"), "store_name", "address",
                 *(["latlng"] if "latlng" in r.columns else []),
                 *(["lat", "lng"] if "lat" in r.columns else []),
                 F.col("city_id").alias("r_city_id"), F.col("area_id").alias("r_area_id"),
                 F.col("sub_area_id").alias("r_sub_area_id"), *[c for c in ("phone", "cnic_number", "store_type")
                                                                 if c in r.columns])
    users = role(t["users"], {"id": "u_id", "name": "user_name", "mobile": "user_mobile", "refer_by": "u_refer_by"})
    areas = role(t["areas"], {"id": "_area_ref", "name": "area"})
    sub_areas = role(t["sub_areas"], {"id": "_sub_area_ref", "name": "sub_area"})
    signup = role(t["users"], {"id": "signup_agent_id", "name": "signup_agent"})
    out = (r.join(users, F.col("u_id") == F.col("r_user_id"), "left")
           .join(areas, F.col("_area_ref") == F.col("r_area_id"), "left")
           .join(sub_areas, F.col("_sub_area_ref") == F.col("r_sub_area_id"), "left")
           .join(signup, F.col("signup_agent_id") == F.col("u_refer_by"), "left")
           .drop("_area_ref", "_sub_area_ref"))
    if with_city:
        cities = role(t["cities"], {"id": "_rcity_ref", "name": "retailer_city"})
        out = out.join(cities, F.col("_rcity_ref") == F.col("r_city_id"), "left").drop("_rcity_ref")
    return out


def route_level_dim(t) -> DataFrame:
    """Route -> route status, driver user, route end (cash collection). Keyed by ``route_id``.

    Built at route grain so the stop-grain frame meets all of it with one join on route id.
    """
    routes = t["routes"].select(F.col("id").alias("route_id"), F.col("name").alias("route_name"),
                                F.col("status").alias("_route_status"), F.col("user_id").alias("_route_user"),
                                F.col("created_at").alias("route_created_at"),
                                F.col("started_at").alias("route_started_at"))
    route_status = role(t["route_status"], {"id": "_rs_ref", "name": "route_status_name"})
    drivers = role(t["users"], {"id": "driver_id", "name": "driver_name", "mobile": "driver_mobile"})
    cash = t["cash_collection"].select(F.col("route_id").alias("_cash_route"), F.col("created_at").alias("route_end_at"))
    return (routes.join(route_status, F.col("_rs_ref") == F.col("_route_status"), "left")
            .join(drivers, F.col("driver_id") == F.col("_route_user"), "left")
            .join(cash, F.col("_cash_route") == F.col("route_id"), "left")
            .drop("_rs_ref", "_route_status", "_route_user", "_cash_route"))


def route_dim(t, stops: DataFrame | None = None) -> DataFrame:
    """Stop -> stop status, then its route with route status, driver and route end.
    Keyed by ``stop_ref``; one join of the stops on route id. ``stops`` restricts the
    stops (default: all)."""
    stops = (stops if stops is not None else t["stops"]).select(
        F.col("id").alias("stop_ref"), F.col("stop_status"), F.col("route_id").alias("_stop_route"))
    stop_status = role(t["stop_status"], {"id": "_ss_ref", "name": "stop_status_name"})
    return (stops.join(stop_status, F.col("_ss_ref") == F.col("stop_status"), "left")
            .join(route_level_dim(t), F.col("route_id") == F.col("_stop_route"), "left")
            .drop("_ss_ref", "_stop_route"))


def agent_dim(t, order_ids: DataFrame | None = None) -> DataFrame:
    """Order -> order agent user, keyed by the integer order id (``agent_order_key``).

    The bridge stores ids as text and is matched as ``text = cast(id as text)``;
    ``canonical_int_key`` keeps exactly the rows that can match, keyed by integer.
    ``order_ids`` (one column ``_oid``) restricts it to those orders.
    """
    bridge = t["orders_agents"].select(canonical_int_key(F.col("order_id")).alias("agent_order_key"),
                                       F.col("agent_id"), canonical_int_key(F.col("agent_id")).alias("_agent_key"))
    agents = role(t["users"], {"id": "order_agent_id", "name": "order_agent"})
    matched = bridge.where(F.col("agent_order_key").isNotNull())
    if order_ids is not None:
        matched = matched.join(order_ids, F.col("agent_order_key") == F.col("_oid"), "left_semi")
    return (matched.join(agents, F.col("order_agent_id") == F.col("_agent_key"), "left").drop("_agent_key"))


def invoice_dim(t) -> DataFrame:
    return t["seller_invoice_orders"].select(F.col("order_id").alias("inv_order_id"), "invoice_id")
