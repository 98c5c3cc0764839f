"""Domain views over the bundled TPC-H-style test tables.

The marketplace schema (orders, order_items, stops, routes, retailers, audit logs,
surveys ...) is derived from the raw test tables by fixed key arithmetic, so
NULLs, unmapped codes, duplicates and fan-out appear at known places. Each view is a
plain projection/filter/union of a raw table and grows with it. The same
definitions, written as SQL, back the DuckDB oracle (``oracle/bindings.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.sources.io import Tables, load_raw


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _hours(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} HOURS")


def _days(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} DAYS")


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _when_else_null(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


class _Builder:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        # one scan node per raw table: file listing and footer reads happen once
        if name not in self._raw:
            self._raw[name] = load_raw(self.spark, self.dir, name)
        return self._raw[name]

    # ---- order side -------------------------------------------------------
    def orders(self) -> DataFrame:
        o = self.raw("orders")
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        delivered = (k % 11).isin(4, 5, 6, 7)
        return o.select(
            k.alias("id"),
            F.floor(k / 3).cast("bigint").alias("master_order_id"),
            c.alias("user_id"),
            (k % 11).cast("int").alias("status"),
            (1 + c % 3).cast("int").alias("type"),
            F.when(k % 17 == 0, F.lit(None)).otherwise(1 + k % 4).cast("int").alias("fulfilment_mode_id"),
            (1 + k % 5).cast("int").alias("vertical_id"),
            (k % 13 == 0).alias("is_fake"),
            F.when(k % 7 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("stop_id"),
            (c % 25).cast("int").alias("city_id"),
            (F.col("o_orderdate") + _hours(20)).alias("created_at"),
            _when_else_null(delivered, F.col("o_orderdate") + _days(3) + _hours(21)).alias("delivered_at"),
            _when_else_null(delivered, F.col("o_orderdate") + _days(3) + _hours(23)).alias("delivery_date_time"),
            _when_else_null(c % 2 == 0, c).alias("created_by"),
            _when_else_null(k % 11 == 6, (1 + k % 3).cast("int")).alias("cancel_reason_id"),
        )

    def order_items(self) -> DataFrame:
        li = self.raw("lineitem")
        qty = F.col("l_quantity").cast("bigint")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_partkey").alias("variant_id"),
            F.col("l_partkey").alias("sku_id"),
            _money("l_extendedprice").alias("price"),
            qty.alias("qty"),
            F.when(F.col("l_linenumber") == 7, F.lit(None).cast("bigint"))
            .otherwise(F.greatest(qty - F.col("l_linenumber") % 3, F.lit(0).cast("bigint"))).alias("picked_qty"),
            F.when(F.col("l_returnflag") == "R", F.lit(1).cast("bigint"))
            .when(F.col("l_returnflag") == "A", F.lit(0).cast("bigint")).alias("return_qty"),
            (_money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")).alias("discount"),
            (F.col("l_tax").cast("decimal(4,2)") * 100).alias("commission_value"),
            F.col("l_linestatus").alias("seller_status"),
            F.col("l_shipdate").alias("updated_at"),
        )

    def order_payments(self) -> DataFrame:
        li = self.raw("lineitem")
        price = _money("l_extendedprice")
        return li.select(
            F.col("l_orderkey").alias("order_id"),
            (1 + F.col("l_linenumber") % 5).cast("int").alias("payment_types_id"),
            F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(price).cast("decimal(18,2)").alias("amount"),
            (price * F.col("l_discount").cast("decimal(4,2)")).alias("total_discount"),
            _when_else_null(F.col("l_returnflag") == "R", price).alias("return_amount"),
        )

    def stops(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").where(k % 7 != 0).select(
            k.alias("id"), (1 + k % 6).cast("int").alias("stop_status"), (k % 97).alias("route_id"))

    def routes(self) -> DataFrame:
        s = self.raw("supplier")
        return s.select(
            F.col("s_suppkey").alias("id"),
            F.concat(F.lit("Route "), F.col("s_name")).alias("name"),
            (F.col("s_nationkey") % 3).cast("int").alias("status"),
            F.col("s_suppkey").alias("user_id"),
            _ntz("1995-01-01 20:00:00").alias("created_at"),
            _ntz("1995-01-02 04:00:00").alias("started_at"),
        )

    def transaction_logs(self) -> DataFrame:
        li = self.raw("lineitem")
        return (li.groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                           F.col("l_orderkey").alias("stop_id"))
                .agg(F.min("l_shipdate").alias("created_at")))

    def cash_collection(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("route_id"),
                                           _ntz("1995-01-02 21:00:00").alias("created_at"))

    def orders_agents(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").where(k % 3 == 0).select(
            k.cast("string").alias("order_id"), (F.col("o_custkey") % 50).cast("string").alias("agent_id"))

    def seller_invoice_orders(self) -> DataFrame:
        k = F.col("o_orderkey")
        return self.raw("orders").where(k % 5 != 0).select(k.alias("order_id"), (k + 900000).alias("invoice_id"))

    # ---- people -----------------------------------------------------------
    def users(self) -> DataFrame:
        c = F.col("c_custkey")
        return self.raw("customer").select(
            c.alias("id"), F.col("c_name").alias("name"),
            F.concat(F.lit("+"), c.cast("string")).alias("mobile"),
            F.when(c % 5 == 0, F.lit(None).cast("bigint")).otherwise(c % 100).alias("refer_by"),
            _ntz("1995-01-01 20:00:00").alias("created_at"),
            (F.col("c_acctbal") > 0).alias("is_active"),
        )

    def retailers(self) -> DataFrame:
        """Copy 0 of every customer plus copy 1 of even customers (two retailer rows per
        even user)."""
        c = F.col("c_custkey")
        cust = self.raw("customer")
        copies = cust.select("*", F.lit(0).alias("d")).unionByName(
            cust.where(c % 2 == 0).select("*", F.lit(1).alias("d")))
        d = F.col("d")
        lat = F.when(c % 7 == 0, F.lit(None)).otherwise(F.col("c_nationkey") * 1.5).cast("double")
        lng = F.when(c % 7 == 0, F.lit(None)).otherwise(F.col("c_nationkey") * 2.5).cast("double")
        return copies.select(
            c.alias("user_id"), d.cast("int").alias("copy_no"),
            F.when(c % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("+"), c.cast("string"))).alias("phone"),
            F.when((d == 1) & (c % 2 == 0), F.lit(None)).otherwise(F.concat(F.lit("Store "), F.col("c_name"))).alias("store_name"),
            F.when(lat.isNull(), F.lit(None)).otherwise(F.struct(lat.alias("lat"), lng.alias("lng"))).alias("latlng"),
            F.col("c_nationkey").cast("int").alias("city_id"),
            F.when(d == 1, F.lit(None)).otherwise(c % 25).cast("int").alias("area_id"),
            F.when(c % 4 == 0, F.lit(None)).otherwise(c % 5).cast("int").alias("sub_area_id"),
            F.when((d == 0) & (c % 2 == 1), F.lit(None)).otherwise((c * 7).cast("string")).alias("cnic_number"),
            F.when(c % 9 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("address"),
            (c % 5).cast("int").alias("store_type"),
        )

    def suppliers(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            s.alias("user_id"), F.col("s_name").alias("store_name"), F.col("s_nationkey").cast("int").alias("city_id"),
            F.when(s % 3 == 0, F.lit(True)).when(s % 3 == 1, F.lit(False)).alias("is_internal"))

    def drivers(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").where(s % 4 != 0).select(
            s.alias("user_id"), F.col("s_nationkey").cast("int").alias("city_id"))

    # ---- small code / place tables ---------------------------------------
    def cities(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").cast("int").alias("id"), F.col("n_name").alias("name"),
                                         (F.col("n_regionkey") == 0).alias("is_exclusive"))

    def areas(self) -> DataFrame:
        return self.raw("nation").select(F.col("n_nationkey").cast("int").alias("id"),
                                         F.concat(F.lit("Area "), F.col("n_name")).alias("name"))

    def named_codes(self) -> DataFrame:
        return self.raw("region").select(F.col("r_regionkey").cast("int").alias("id"), F.col("r_name").alias("name"))

    def cancellation_reasons(self) -> DataFrame:
        return self.named_codes().withColumnRenamed("name", "description")

    def reasons(self) -> DataFrame:
        r = F.col("r_regionkey")
        return self.raw("region").select(
            (1 + r).cast("int").alias("id"),
            F.when(r == 0, "Wastage").when(r == 1, "Lost/Stolen").when(r == 2, "Wrong data entry")
            .otherwise("Other").alias("reason"))

    # ---- catalogue ---------------------------------------------------------
    def categories(self) -> DataFrame:
        top = self.raw("region").select(F.col("r_regionkey").cast("int").alias("id"), F.col("r_name").alias("name"),
                                        F.lit(None).cast("int").alias("parent_id"))
        mid = self.raw("nation").select((100 + F.col("n_nationkey")).cast("int").alias("id"), F.col("n_name").alias("name"),
                                        F.col("n_regionkey").cast("int").alias("parent_id"))
        leaf = self.raw("supplier").select((1000 + F.col("s_suppkey")).cast("int").alias("id"), F.col("s_name").alias("name"),
                                           (100 + F.col("s_nationkey")).cast("int").alias("parent_id"))
        return top.unionByName(mid).unionByName(leaf)

    def product_categories(self) -> DataFrame:
        p = self.raw("part")
        k = F.col("p_partkey")
        first = p.where(k % 12 != 11).select(k.alias("product_id"), (100 + k % 25).cast("int").alias("category_id"))
        second = p.where(k % 10 == 0).select(k.alias("product_id"), (100 + (k + 1) % 25).cast("int").alias("category_id"))
        return first.unionByName(second)

    def products(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(k.alias("id"), F.col("p_name").alias("name"), (k % 5).cast("int").alias("vertical_id"))

    def product_variants(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(k.alias("id"),
                                       F.concat(F.col("p_name"), F.lit(" "), F.col("p_size").cast("string")).alias("name"),
                                       k.alias("product_sku_id"))

    def product_sku(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(
            k.alias("id"), F.concat(F.lit("SKU "), F.col("p_name")).alias("sku_name"),
            _money("p_retailprice").alias("price"), k.alias("product_id"),
            F.when(k % 6 == 0, F.lit(None).cast("bigint")).otherwise(k).alias("product_variant_id"))

    def product_sku_details(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(k.alias("sku_id"), (k % 100).alias("user_id"))

    def brands(self) -> DataFrame:
        return self.raw("part").select(F.substring("p_brand", 7, 100).cast("int").alias("id"),
                                       F.col("p_brand").alias("name")).distinct()

    def product_brands(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").where(k % 8 != 0).select(
            k.alias("product_id"), F.substring("p_brand", 7, 100).cast("int").alias("brand_id"))

    def product_manufacturing(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.raw("part").select(k.alias("product_id"), (k % 7).cast("int").alias("manufacturing_id"))

    # ---- returns, commission, logs, surveys --------------------------------
    def return_discrepancy(self) -> DataFrame:
        li = self.raw("lineitem")
        n = F.col("l_linenumber")
        return li.where(F.col("l_returnflag") == "R").select(
            (F.col("l_orderkey") * 10 + n).alias("id"), (F.col("l_orderkey") % 97).alias("route_id"),
            F.col("l_partkey").alias("sku_id"), F.col("l_quantity").cast("bigint").alias("qty"),
            F.when(n == 7, F.lit(None)).otherwise(n).cast("bigint").alias("discrepancy"),
            F.when(n == 6, F.lit(None)).otherwise(1 + n % 4).cast("int").alias("reason_id"),
            (F.col("l_shipdate") + _hours(20)).alias("created_at"))

    def categories_commission(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self.raw("supplier").select(
            s.alias("id"), (100 + s % 25).cast("int").alias("category_id"), F.col("s_nationkey").cast("int").alias("city_id"),
            (1 + s % 4).cast("int").alias("fulfilment_mode_id"), (s % 12).cast("int").alias("commission_value"),
            (F.col("s_acctbal") > 0).alias("is_active"), s.alias("created_by"),
            _when_else_null(s % 2 == 0, s + 1).alias("updated_by"),
            _ntz("1995-01-01 20:00:00").alias("created_at"),
            _when_else_null(s % 2 == 0, _ntz("1996-06-30 21:30:00")).alias("updated_at"),
            _when_else_null(s % 9 == 0, _ntz("1997-01-31 19:00:00")).alias("deleted_at"))

    def activity_logs(self) -> DataFrame:
        e = self.raw("events")
        eid, et = F.col("event_id"), F.col("event_type")
        payload = (F.when(et == "click", "SKU updated successfully").when(et == "view", "Item added successfully")
                   .when(et == "purchase", "Product updated successfully")
                   .when(et == "signup", "Out of stock marked manually").otherwise("Login failed"))
        id_text = (F.when(eid % 10 == 0, "n/a").when(eid % 10 == 1, "5.").when(eid % 10 == 2, "1e5")
                   .otherwise(eid.cast("string")))
        day = F.to_date("ts").cast("string")
        user = F.col("user_id").cast("string")
        changes = F.concat(
            F.lit('{"current":{"id":"'), id_text, F.lit('","price":'), user, F.lit(',"code":"'), et,
            F.lit('","is_hot":'), F.when(eid % 2 == 0, "true").otherwise("false"),
            F.lit(',"deleted_at":null,"updated_at":"2023-'), F.when(eid % 2 == 0, "06").otherwise("07"),
            F.lit("-"), (10 + eid % 19).cast("string"),
            F.lit('T19:12:41.593000Z","delivery_date":"'), day, F.lit('"},"sku":{"id":'), user,
            F.lit(',"sku_id":"S'), user, F.lit('","approved":'), F.when(eid % 3 == 0, "true").otherwise("false"),
            F.lit(',"seller_change_requests":{"expiry_date":"'), day, F.lit('"}}}'))
        return e.select(eid, payload.alias("payload"), changes.alias("changes"))

    def nps_results(self) -> DataFrame:
        eid = F.col("event_id")
        return self.raw("events").select(
            F.col("user_id"), eid.alias("result_id"), (1700000000 + eid * 60).alias("created_at"),
            (1 + eid % 2).cast("int").alias("survey_id"), (1 + eid % 3).cast("int").alias("question_id"),
            (1 + eid % 5).cast("int").alias("option_id"), (eid % 11).cast("int").alias("selected_option"))

    def nps_surveys(self) -> DataFrame:
        """Survey x question x option grid: each option row (one per region) expands
        into surveys 0-1 and questions 0-2 by generators; survey names by equi join."""
        r = self.raw("region")
        grid = r.select(F.col("r_regionkey").alias("c"), F.col("r_name").alias("c_name"),
                        F.explode(F.array(F.lit(0), F.lit(1))).alias("a"),
                        F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("b"))
        names = (r.where(F.col("r_regionkey") < 2)
                 .select(F.col("r_regionkey").alias("_a"), F.col("r_name").alias("a_name")))
        grid = grid.join(names, F.col("a") == F.col("_a"), "inner")
        text = (F.when(F.col("b") == 0, "how likely are you to recommend us")
                .when(F.col("b") == 1, "would you suggest us to other shops").otherwise("other question"))
        return grid.select(
            (1 + F.col("a")).cast("int").alias("survey_id"), (1 + F.col("b")).cast("int").alias("question_id"),
            (1 + F.col("c")).cast("int").alias("option_id"), F.concat(F.lit("Survey "), F.col("a_name")).alias("survey_name"),
            F.lit("scale").alias("question_type"), text.alias("question_text"), F.col("c_name").alias("option_text"))


# logical name -> builder method; the code tables all stand on the region table
_VIEWS = {
    "orders": "orders", "order_items": "order_items", "order_payments": "order_payments", "stops": "stops",
    "routes": "routes", "transaction_logs": "transaction_logs", "cash_collection": "cash_collection",
    "orders_agents": "orders_agents", "seller_invoice_orders": "seller_invoice_orders", "users": "users",
    "retailers": "retailers", "suppliers": "suppliers", "drivers": "drivers", "cities": "cities", "areas": "areas",
    "sub_areas": "named_codes", "verticals": "named_codes", "store_type": "named_codes", "manufacturing": "named_codes",
    "fulfilment_mode": "named_codes", "stop_status": "named_codes", "route_status": "named_codes",
    "cancellation_reasons": "cancellation_reasons", "reasons": "reasons", "categories": "categories",
    "product_categories": "product_categories", "products": "products", "product_variants": "product_variants",
    "product_sku": "product_sku", "product_sku_details": "product_sku_details", "brands": "brands",
    "product_brands": "product_brands", "product_manufacturing": "product_manufacturing",
    "return_discrepancy": "return_discrepancy", "categories_commission": "categories_commission",
    "activity_logs": "activity_logs", "nps_results": "nps_results", "nps_surveys": "nps_surveys",
}


def TestTables(spark: SparkSession, sf_dir: str) -> Tables:
    """Domain tables built from ``<sf_dir>/*.parquet``."""
    builder = _Builder(spark, sf_dir)

    def factory(name: str) -> DataFrame:
        if name not in _VIEWS:
            raise KeyError(name)
        return getattr(builder, _VIEWS[name])()

    return Tables(factory, list(_VIEWS))
