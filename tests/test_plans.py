"""Physical-plan properties of the registered jobs."""

from __future__ import annotations

import re

import pytest

from tests.conftest import SMALL

ALL = None


def _plan(spark, name):
    from tijara.registry import all_queries

    df = all_queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def _names():
    from tijara.registry import all_queries

    return sorted(all_queries())


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_no_python_no_nested_loop(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_top_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "fulfilment_top_n")


def test_rank_filters_use_group_limit(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("retailer_best_profile", "last_two_order_dates", "latest_survey_answer"):
            assert "WindowGroupLimit" in _plan(spark, name), name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_projection_reaches_scan(spark):
    from tijara.registry import all_queries

    df = all_queries()["stops_projection"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_order_window_filter_pushed(spark):
    plan = _plan(spark, "order_window_filter")
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan


def test_funnel_aggregates_without_extra_exchange_on_order_key(spark):
    """The 25-key aggregation reuses the order-id clustering of the last join (no exchange
    on the full key list when the items join is a shuffle join)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(spark, "fulfilment_funnel")
        assert "hashpartitioning(City" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# every partition of a few kB counts as large, and nothing is broadcast
SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _final_plan(df):
    df.collect()  # the frame itself, so that its adaptive plan is final
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan.split("== Initial Plan ==")[0]


def test_hot_fact_key_is_split_by_aqe(spark, skew_conf):
    """One order key holding most fact rows: ``left_join_fact`` is split by AQE at run time; a plain
    left join with the hot key on its right side is not."""
    from pyspark.sql import functions as F

    from tijara.operators.dims import left_join_fact

    orders = spark.range(0, 2000).select(F.col("id").alias("oid"), (F.col("id") % 7).alias("x"))
    items = spark.range(0, 60000).select(
        F.when(F.col("id") % 10 < 8, F.lit(1)).otherwise(F.col("id") % 2000).alias("order_id"),  # key 1: 80% of rows
        F.col("id").alias("item"))
    safe = left_join_fact(orders, items, "oid", "order_id", orders, items)
    plain = orders.join(items, F.col("oid") == F.col("order_id"), "left")
    assert "skew=true" in _final_plan(safe)
    assert "skew=true" not in _final_plan(plain)
    assert safe.count() == plain.count() == 60000 + 1599   # matched + orders without items


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """Written domain tables: one SKU on most items, most orders without a stop, one hot order."""
    from pyspark.sql import functions as F

    from tijara.registry import tables_for
    from tijara.sources.io import ParquetTables

    root = str(tmp_path_factory.mktemp("hot"))
    base = tables_for(spark, "/root/testdata/sf0.01")
    for name in base:
        df = base[name]
        if name == "order_items":
            hot_sku = df.agg(F.min("sku_id")).first()[0]
            df = df.withColumn("sku_id", F.when(F.col("id") % 10 < 8, F.lit(hot_sku)).otherwise(F.col("sku_id")))
        elif name == "orders":
            df = df.withColumn("stop_id", F.when(F.col("id") % 10 == 0, F.col("stop_id")))
        df.repartition(4).write.parquet(f"{root}/{name}")
    return ParquetTables(spark, root)


@pytest.mark.parametrize("job", ["fulfilment_funnel", "monthly_delivered_gmv", "order_denormalized"])
def test_whole_jobs_split_the_hot_sku(hot_tables, skew_conf, job):
    """The whole jobs, with a hot SKU and 90 % of the orders without a stop, run on split partitions."""
    from tijara.registry import QUERIES, all_queries

    all_queries()
    assert "skew=true" in _final_plan(QUERIES[job](hot_tables))


def test_null_stops_are_spread(spark):
    """Orders without a stop leave the stop join's shuffle evenly dealt."""
    from pyspark.sql import functions as F

    from tijara.operators.dims import left_join_spread

    orders = spark.range(0, 20000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("stop_id"))
    stops = spark.range(0, 20000, 10).select(F.col("id").alias("ref"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_join_spread(orders, stops, "stop_id", "ref", "id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20000 and max(sizes) < 2 * 20000 / 8
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("job, scans", [("rfm_report", 1), ("rfm_cumulative", 1), ("quarter_user_spine", 1),
                                        ("quarter_calendar", 1), ("retailer_performance", 1)])
def test_one_scan_of_the_fact_mart(spark, tmp_path, job, scans):
    """Jobs over the persisted item facts read them once."""
    from tijara.plans import item_facts
    from tijara.registry import QUERIES, all_queries, tables_for

    all_queries()
    t = tables_for(spark, SMALL)
    path = str(tmp_path / "all_gmv")
    item_facts.all_gmv(t).write.parquet(path)
    df = QUERIES[job](t.with_table("all_gmv", spark.read.parquet(path)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[order_id#\d+L?,user_id#\d+L?,sku_id#", plan)) == scans


def test_latest_log_is_one_scan(spark, tmp_path):
    from tijara.operators.keyed import latest_per_key

    path = str(tmp_path / "logs")
    spark.createDataFrame([(1, 7), (2, 7)], "id int, stop_id int").write.parquet(path)
    plan = latest_per_key(spark.read.parquet(path), "stop_id", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_sorted_outputs(spark):
    """The order mart and the rate card come sorted, NULLs where the report's engine puts them."""
    from tijara.registry import all_queries

    def first_last(names, nulls_first):
        def key(row):
            return [((row[c] is None) != nulls_first, row[c] if row[c] is not None else 0) for c in names]
        return key

    mart = all_queries()["order_denormalized"](spark, "/root/testdata/sf0.01").collect()
    by = ("MasterOrderID", "OrderID", "OrderType", "OrderCreatedAt", "Product_Name", "Product Variant Name")
    assert len(mart) > 100 and [first_last(by, True)(r) for r in mart] == sorted(first_last(by, True)(r) for r in mart)
    card = all_queries()["commission_rate_card"](spark, "/root/testdata/sf0.01").collect()
    by = ("City", "Category ID", "Category", "Sub-Category ID")
    assert len(card) > 5 and [first_last(by, False)(r) for r in card] == sorted(first_last(by, False)(r) for r in card)


def test_sort_keeps_nulls_in_place(spark):
    """NULLs in each sort key of the rate card stand last, of the mart first."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(None, 1), ("a", None), ("a", 1), (None, None)], "City string, k int")
    out = [tuple(r) for r in df.orderBy(F.col("City").asc_nulls_last(), F.col("k").asc_nulls_last()).collect()]
    assert out == [("a", 1), ("a", None), (None, 1), (None, None)]
    assert [tuple(r) for r in df.orderBy("City", "k").collect()] == [(None, None), (None, 1), ("a", None), ("a", 1)]


@pytest.mark.parametrize("name", ["rfm_quarter_metrics", "rfm_cumulative", "rfm_report", "customer_metrics", "retailer_performance"])
def test_distinct_counts_expand_nothing(spark, name):
    assert "Expand" not in _plan(spark, name)


def test_day_bits_count_like_distinct(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from tijara.functions.daybits import distinct_days, distinct_months_of_quarter

    first = dt.date(2024, 7, 1)  # a quarter of 92 days
    data = [(k, first + dt.timedelta(days=d)) for k in range(4) for d in ([0, 63, 64, 90] * k + [91 - k, 5 * k])] + [(9, None)]
    df = spark.createDataFrame(data, "k int, d date").repartition(5)
    got = df.groupBy("k").agg(distinct_days(F.col("d"), F.lit(first), 92).alias("n"), F.count_distinct("d").alias("n2"),
                              distinct_months_of_quarter(F.col("d")).alias("m"),
                              F.count_distinct(F.trunc("d", "month")).alias("m2")).collect()
    assert all((r.n, r.m) == (r.n2, r.m2) for r in got) and len(got) == 5


def test_top_n_ranks_a_narrow_pass_first(spark):
    """Two cuts: the four sort keys alone, without the measures' columns, and the rows of those keys."""
    plan = _plan(spark, "fulfilment_top_n")
    assert plan.count("TakeOrderedAndProject(limit=500") >= 2
    from tijara.plans.fulfilment import SORT_KEYS, top_sort_keys
    from tijara.registry import tables_for

    keys = top_sort_keys(tables_for(spark, SMALL), 500)
    assert tuple(keys.columns) == SORT_KEYS
    narrow = keys._jdf.queryExecution().optimizedPlan().toString()
    for column in ("l_extendedprice", "l_discount", "l_tax", "c_name"):
        assert column not in narrow.split("Relation")[0]
        assert not re.search(rf"Project \[[^\]]*{column}#", narrow), column


@pytest.mark.parametrize("n", [1, 7, 60, 100_000])
def test_top_n_equals_the_sorted_whole(spark, small_tables, n):
    """Also where the cut falls among rows that tie on the four sort keys."""
    from tijara.plans import fulfilment

    got = [tuple(r) for r in fulfilment.top_n(small_tables, n).collect()]
    whole = fulfilment.reconciled(small_tables)
    rest = [c for c in whole.columns if c not in fulfilment.SORT_KEYS]
    from pyspark.sql import functions as F

    want = [tuple(r) for r in whole.orderBy(*fulfilment._sort_order(), *[F.col(c).asc_nulls_last() for c in rest]).limit(n).collect()]
    assert got == want


def test_top_n_cut_among_ties(spark, small_tables):
    """Many orders of one city, day, route and SKU: the cut takes the first of them by the other columns."""
    from tijara.plans import fulfilment

    one = small_tables["orders"].where("delivered_at is not null and not is_fake and fulfilment_mode_id in (1, 2)").limit(1)
    item = small_tables["order_items"].limit(1)
    orders = one.drop("id").crossJoin(spark.range(10_000_000, 10_000_040))
    items = item.drop("order_id").crossJoin(spark.range(10_000_000, 10_000_040).withColumnRenamed("id", "order_id"))
    t = small_tables.with_table("orders", orders.select(*small_tables["orders"].columns)).with_table(
        "order_items", items.select(*small_tables["order_items"].columns))
    got = [r.order_id for r in fulfilment.top_n(t, 15).collect()]
    assert got == [10_000_000 + k for k in range(15)]


@pytest.mark.parametrize("name", ["item_gmv_measures", "item_quantity_rules", "actualized_commission", "order_channel_size_class"])
def test_items_meet_stops_through_their_orders(spark, name):
    """Items joined with stops themselves: those of all orders without a stop land in one task."""
    from tijara.registry import all_queries

    plan = all_queries()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in plan if "Join LeftOuter" in line]
    assert "l_orderkey" in joins[0] or "order_id" in joins[0]
    assert "_spread" in joins[1]


def test_mart_plans_with_the_size_of_its_window(spark):
    """A window far smaller than the orders is broadcast, so nothing outside of it is shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        plan = _plan(spark, "order_denormalized")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    semi = [line for line in plan.splitlines() if "LeftSemi" in line]
    assert semi and all("BroadcastHashJoin" in line for line in semi)
