"""Mart sink round trip and the streaming audit extract."""

from __future__ import annotations

from tijara.plans import audit_log
from tijara.sources.io import ParquetTables, write_mart


def test_write_mart_round_trip_with_symbol_names(spark, small_tables, tmp_path):
    from tijara.plans.monthly_gmv import dropship_distinct

    df = dropship_distinct(small_tables).select("order_id", "Commission Rate (%)", "RDS/BULK Classification")
    write_mart(df, "test_mart", "dropship", path=str(tmp_path / "dropship"))
    back = spark.table("test_mart.dropship")
    assert back.columns == df.columns
    assert back.count() == df.count()


def test_parquet_tables_by_logical_name(spark, small_tables, tmp_path):
    small_tables["stops"].write.parquet(str(tmp_path / "stops"))
    t = ParquetTables(spark, str(tmp_path))
    assert t["stops"].count() == small_tables["stops"].count()


def test_streaming_typed_extract_matches_batch(spark, small_tables, tmp_path):
    from tijara.streaming.audit_stream import start_typed_extract

    logs = small_tables["activity_logs"]
    src = str(tmp_path / "src")
    logs.repartition(3).write.parquet(src)
    sink = str(tmp_path / "sink")
    q = start_typed_extract(spark, src, logs.schema, sink, month=6, name="t_audit",
                            checkpoint=str(tmp_path / "stream_ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = audit_log.audit_log_typed(logs, 6)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0


def test_growth_marts_read_back_equal(spark, small_tables, tmp_path):
    import datetime as dt

    from tijara.plans import item_facts, rfm
    from tijara.plans.marts import build_growth_marts

    start, as_of = dt.date(1995, 1, 1), dt.date(2001, 8, 1)
    build_growth_marts(spark, small_tables, "test_growth", start=start, as_of=as_of,
                       survey_patterns=("recommend us",), root=str(tmp_path / "marts"))
    written = spark.table("test_growth.rfm_report")
    direct = rfm.report(item_facts.all_gmv(small_tables), start, as_of)
    assert written.count() == direct.count()
    assert written.exceptAll(direct.select(*written.columns)).count() == 0
    assert spark.table("test_growth.retailer_performance").count() == small_tables["retailers"].count()


def test_gmv_mart_reads_prune_partitions(spark, small_tables, tmp_path):
    import datetime as dt

    from tijara.plans.marts import build_gmv_mart
    from tijara.plans.retailer_performance import last3m_totals

    t = build_gmv_mart(spark, small_tables, "test_gmv", path=str(tmp_path / "all_gmv"))
    plan = last3m_totals(t["all_gmv"], dt.date(2001, 8, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(delivery_quarter" in plan and "delivery_quarter#" in plan


def test_bucketed_tables_join_without_shuffle(spark, small_tables, tmp_path):
    from pyspark.sql import functions as F

    write_mart(small_tables["orders"], "test_bucket", "orders", path=str(tmp_path / "o"), bucket_by=(8, ["id"]))
    write_mart(small_tables["order_items"].drop("id"), "test_bucket", "order_items", path=str(tmp_path / "i"),
               bucket_by=(8, ["order_id"]))
    o, i = spark.table("test_bucket.orders"), spark.table("test_bucket.order_items")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = o.join(i, F.col("id") == F.col("order_id"), "left")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == small_tables["orders"].join(small_tables["order_items"].drop("id"),
                                                        F.col("id") == F.col("order_id"), "left").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_membership_and_override(spark, small_tables, tmp_path):
    from tijara.plans.item_facts import gmv_mart
    from tijara.sources.io import CatalogTables

    small_tables["stops"].write.parquet(str(tmp_path / "stops"))
    pt = ParquetTables(spark, str(tmp_path))
    assert "stops" in pt and "all_gmv" not in pt
    marker = small_tables["stops"].limit(0)
    over = pt.with_table("all_gmv", marker)
    assert "all_gmv" in over and "stops" in over and "nope" not in over
    assert gmv_mart(over) is marker                       # a persisted mart is preferred over deriving
    write_mart(small_tables["cities"], "test_cat", "cities", path=str(tmp_path / "cities_tbl"))
    ct = CatalogTables(spark, "test_cat")
    assert "cities" in ct and "orders" not in ct and ct["cities"].count() == small_tables["cities"].count()


def test_cli_writes_mart(spark, small_tables, tmp_path):
    from tijara.__main__ import main

    root = tmp_path / "domain"
    for name in ("orders", "order_items", "product_sku", "products", "product_categories", "categories",
                 "retailers", "users", "cities", "areas", "sub_areas", "stops", "stop_status", "routes",
                 "route_status", "transaction_logs", "cash_collection", "orders_agents", "product_sku_details",
                 "cancellation_reasons"):
        small_tables[name].write.parquet(str(root / name))
    main(["monthly-gmv", "--parquet-root", str(root), "--schema", "test_cli", "--path-root", str(tmp_path / "out")])
    from tijara.plans.monthly_gmv import monthly_delivered_gmv

    written = spark.table("test_cli.monthly_delivered_gmv")
    assert sorted(written.collect()) == sorted(monthly_delivered_gmv(small_tables).collect())


def test_streaming_since_extract_matches_batch(spark, small_tables, tmp_path):
    import datetime as dt

    from tijara.streaming.audit_stream import start_since_extract

    logs = small_tables["activity_logs"]
    src = str(tmp_path / "src")
    logs.repartition(2).write.parquet(src)
    sink = str(tmp_path / "sink")
    cut = dt.date(2023, 6, 21)
    q = start_since_extract(spark, src, logs.schema, sink, cut=cut, name="t_since",
                            checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(sink)
    batch = audit_log.audit_log_since(logs, cut)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch).count() == 0


def test_configure_leaves_static_settings_alone(spark):
    from tijara.session import DEFAULTS, configure

    for key in DEFAULTS:
        if not spark.conf.isModifiable(key):
            assert key == "spark.python.sql.dataFrameDebugging.enabled"
    configure(spark)                      # must not try to set a static setting
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
