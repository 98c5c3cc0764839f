"""The shredded audit log gives the rows of the extracts from the raw log, reading less."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tijara.plans import audit_log, audit_store
from tijara.registry import AUDIT_CUT_DATE, AUDIT_MONTH

MSG = "SKU updated successfully"
ODD = ['{"current":{"id":1e5,"price":12.50,"updated_at":"2023-06-25T10:00:00.5Z"}}',
       '{"current":{"id":1,"id":-7,"updated_at":"2023-06-21T00:00:00.000000Z"}}',
       '{"current":{"id":123456789012345678901234567890.125,"is_hot":"maybe","updated_at":"garbage"}}',
       '{"current":{"id":"+12","updated_at":"2023-06-21"},"sku":{"sku_id":"S1","approved":true}}',
       "not json", "[]", "{}", "", None]


@pytest.fixture(scope="module")
def logs(spark, small_tables):
    odd = spark.createDataFrame([(-i, MSG, d) for i, d in enumerate(ODD)], "event_id bigint, payload string, changes string")
    return small_tables["activity_logs"].select("event_id", "payload", "changes").unionByName(odd)


@pytest.fixture(scope="module")
def store(spark, logs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("audit") / "store")
    audit_store.append(logs.where("event_id % 3 = 0"), path, files=4)
    audit_store.append(logs.where("event_id % 3 != 0"), path, files=4)
    return audit_store.read(spark, path)


def final_plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def scanned(df) -> tuple[int, list]:
    """How many rows the scan of a plan gave, and the result."""
    plan = df._jdf.queryExecution().executedPlan()
    got = plan.executeCollectPublic()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value(), list(got)


def test_extracts_equal_those_of_the_raw_log(store, logs):
    for kept, raw in ((audit_store.log_typed(store, AUDIT_MONTH), audit_log.audit_log_typed(logs, AUDIT_MONTH)),
                      (audit_store.log_text(store), audit_log.audit_log_text(logs)),
                      (audit_store.log_since(store, AUDIT_CUT_DATE), audit_log.audit_log_since(logs, AUDIT_CUT_DATE)),
                      (audit_store.numeric_ids(store), audit_log.audit_numeric_ids(logs))):
        assert kept.schema.simpleString() == raw.schema.simpleString()
        expected = rows(raw)
        assert expected and rows(kept) == expected


def test_raw_columns_stay(store, logs):
    assert rows(store.select(*logs.columns)) == rows(logs)
    got = {r.changes: r.text for r in store.where("event_id <= 0").select("changes", F.col("leaf_text.id").alias("text")).collect()}
    assert got[ODD[0]] == "1e5" and got[ODD[1]] == "-7" and got["not json"] is None


def test_scans_read_the_leaves_they_need(store):
    ids = final_plan(audit_store.numeric_ids(store))
    assert "from_json" not in ids and "ReadSchema: struct<leaf_text:struct<id:string>,leaf_value:struct<id:double>>" in ids
    since = final_plan(audit_store.log_since(store, AUDIT_CUT_DATE))
    assert "GreaterThanOrEqual(event_day,2023-06-21)" in since and "from_json" not in since
    schema = since.split("ReadSchema")[1].splitlines()[0]
    assert "changes" not in schema and "leaf_value" not in schema
    assert "EqualTo(event_month,6)" in final_plan(audit_store.log_typed(store, 6))


def test_files_are_clustered_by_time(spark, small_tables, tmp_path):
    """A cut leaves most files without a row: the ranges of their times do not overlap."""
    e = small_tables["activity_logs"].select("event_id", "payload", F.regexp_replace(
        "changes", "2023-0[67]", F.concat(F.lit("2023-"), F.lpad((1 + F.col("event_id") % 12).cast("string"), 2, "0"))).alias("changes"))
    path = str(tmp_path / "store")
    audit_store.append(e, path, files=6)
    ranges = sorted((r.low, r.high) for r in audit_store.read(spark, path).groupBy(F.input_file_name()).agg(
        F.min("event_stamp").alias("low"), F.max("event_stamp").alias("high")).collect())
    assert len(ranges) == 6 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert sum(high > dt.datetime(2023, 11, 1) for _, high in ranges) <= 2
    kept, n = audit_store.read(spark, path), e.count()
    read, got = scanned(audit_store.log_since(kept, dt.date(2023, 11, 1)))
    assert len(got) == audit_log.audit_log_since(e, dt.date(2023, 11, 1)).count() > 0 and read < 0.45 * n
    read, got = scanned(audit_store.log_typed(kept, 3))
    assert len(got) == audit_log.audit_log_typed(e, 3).count() > 0 and read < 0.45 * n


def test_events_of_one_moment_are_dealt_over_files(spark, tmp_path):
    hot = spark.range(3000).select(F.col("id").alias("event_id"), F.lit(MSG).alias("payload"), F.concat(
        F.lit('{"current":{"id":'), F.col("id").cast("string"), F.lit(',"updated_at":"2023-06-10T00:00:00Z"}}')).alias("changes"))
    path = str(tmp_path / "store")
    audit_store.append(hot, path, files=4)
    sizes = [r["count"] for r in audit_store.read(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1500 and sum(sizes) == 3000


def test_columns_of_the_store_may_not_clash(spark):
    clash = spark.createDataFrame([(1, MSG, "{}", 3)], "event_id bigint, payload string, changes string, Event_Month int")
    with pytest.raises(ValueError, match="event_month"):
        audit_store.shred(clash)


def test_empty_log(spark, tmp_path):
    empty = spark.createDataFrame([], "event_id bigint, payload string, changes string")
    path = str(tmp_path / "store")
    audit_store.append(empty, path, files=2)
    assert audit_store.log_text(audit_store.read(spark, path)).count() == 0
