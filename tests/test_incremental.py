"""Refresh of a mart by changed quarters, and the kept to-date state."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tijara.plans import item_facts, marts, rfm, rfm_state
from tijara.registry import AS_OF, RFM_START

PART = item_facts.GMV_PARTITION


@pytest.fixture(scope="module")
def gmv(spark, small_tables, tmp_path_factory):
    """The item facts, written once."""
    path = str(tmp_path_factory.mktemp("facts") / "all_gmv")
    item_facts.all_gmv(small_tables).withColumn(PART, rfm.quarter_start("System_Delivery_Date")).write.parquet(path)
    return spark.read.parquet(path)


def files(path) -> dict[str, float]:
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path)
            for f in names if f.endswith(".parquet")}


def test_only_changed_quarters_are_written(spark, gmv, tmp_path):
    path = str(tmp_path / "mart")
    first = marts.refresh_mart(gmv, "test_refresh", "all_gmv", PART, path=path)
    quarters = sorted(r[0] for r in gmv.select(PART).distinct().collect())
    assert first == {"written": quarters, "dropped": []}
    before = files(path)
    assert marts.refresh_mart(gmv, "test_refresh", "all_gmv", PART, path=path) == {"written": [], "dropped": []}
    assert files(path) == before
    # one value of one quarter changes, another quarter vanishes, a new one comes
    changed, gone, fresh = quarters[2], quarters[4], dt.date(2031, 1, 1)
    bumped = F.when(F.col(PART) == changed, F.col("Delivered_GMV") + 1).otherwise(F.col("Delivered_GMV"))
    new = gmv.withColumn("Delivered_GMV", bumped.cast(gmv.schema["Delivered_GMV"].dataType)).where(F.col(PART) != gone)
    new = new.unionByName(gmv.limit(3).withColumn(PART, F.lit(fresh)))
    done = marts.refresh_mart(new, "test_refresh", "all_gmv", PART, path=path)
    assert done == {"written": [changed, fresh], "dropped": [gone]}
    after = files(path)
    assert {f.split(PART + "=")[1][:10] for f in after if before.get(f) != after[f]} == {str(changed), str(fresh)}
    spark.catalog.refreshTable("test_refresh.all_gmv")
    assert rows(spark.table("test_refresh.all_gmv"), *gmv.columns) == rows(new, *gmv.columns)


def test_a_failed_write_leaves_the_mart(spark, gmv, tmp_path):
    path = str(tmp_path / "mart")
    marts.refresh_mart(gmv, "test_failing", "all_gmv", PART, path=path)
    before, there = files(path), rows(spark.table("test_failing.all_gmv"))
    quarter = gmv.select(F.max(PART)).first()[0]
    # digests can be taken, the write meets an error in some row
    bad = gmv.withColumn("Delivered_GMV", F.when(F.col(PART) == quarter, F.col("Delivered_GMV") + 1).otherwise(F.col("Delivered_GMV"))
                         .cast(gmv.schema["Delivered_GMV"].dataType))
    seen = []
    digests = marts.partition_digests

    def digests_then_fail(df, part):
        seen.append(1)
        return digests(bad, part) if len(seen) == 1 else digests(df, part)

    failing = bad.withColumn("sku_id", F.when(F.col("sku_id") % 5 == 0, F.raise_error(F.lit("broken"))).otherwise(F.col("sku_id")))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(marts, "partition_digests", digests_then_fail)
        with pytest.raises(Exception, match="broken"):
            marts.refresh_mart(failing, "test_failing", "all_gmv", PART, path=path)
    assert files(path) == before and rows(spark.table("test_failing.all_gmv")) == there


def test_refresh_from_tables(spark, small_tables, tmp_path):
    t = marts.refresh_gmv_mart(spark, small_tables, "test_refreshed", path=str(tmp_path / "m"))
    assert rows(t["all_gmv"].drop(PART)) == rows(item_facts.all_gmv(small_tables))


def batches(gmv):
    """Three parts of the facts: an early one, a later one, and late facts of the early days."""
    late = F.col("order_id") % 5 == 0
    day = F.col("System_Delivery_Date")
    cut = dt.date(1996, 6, 15)
    return [gmv.where((day < cut) & ~late), gmv.where((day >= cut) & ~late), gmv.where(late)]


def test_state_after_batches_equals_the_report(spark, gmv, tmp_path):
    path = str(tmp_path / "state")
    parts = batches(gmv)
    so_far = None
    for part in parts:
        rfm_state.merge(spark, path, rfm_state.change(RFM_START, part))
        so_far = part if so_far is None else so_far.unionByName(part)
        assert rows(rfm_state.report(spark, path, RFM_START, AS_OF)) == rows(rfm.report(so_far, RFM_START, AS_OF))
    assert rows(rfm_state.daily(spark, path)) == rows(rfm.daily_facts(gmv, RFM_START))


def test_corrected_facts(spark, gmv, tmp_path):
    """Other amounts, other days (and quarters), a user without facts afterwards, values that become NULL."""
    path = str(tmp_path / "state")
    rfm_state.merge(spark, path, rfm_state.change(RFM_START, gmv))
    before = files(path)
    user = gmv.where("user_id is not null").select(F.max("user_id")).first()[0]
    old = gmv.where((F.col("user_id") == user) | (F.col("order_id") % 97 == 0)).where(F.col("System_Delivery_Date") < dt.date(1997, 1, 1))
    right = old.where(F.col("user_id") != user).withColumn(
        "System_Delivery_Date", F.date_add("System_Delivery_Date", F.when(F.col("order_id") % 2 == 0, 100).otherwise(0))).withColumn(
        "Delivered_GMV", F.when(F.col("sku_id") % 3 == 0, F.lit(None)).otherwise(F.col("Delivered_GMV") * 2)
        .cast(gmv.schema["Delivered_GMV"].dataType))
    rfm_state.merge(spark, path, rfm_state.change(RFM_START, right, taken_back=old))
    now = gmv.exceptAll(old).unionByName(right)
    assert old.count() > 20
    assert rows(rfm_state.report(spark, path, RFM_START, AS_OF)) == rows(rfm.report(now, RFM_START, AS_OF))
    kept = {f for f, at in files(path).items() if before.get(f) == at}
    assert kept and len(kept) < len(before)  # untouched quarters keep their files


def test_a_failed_merge_leaves_the_state(spark, gmv, tmp_path):
    path = str(tmp_path / "state")
    rfm_state.merge(spark, path, rfm_state.change(RFM_START, batches(gmv)[0]))
    before = files(path)
    broken = rfm_state.change(RFM_START, batches(gmv)[2]).withColumn(
        "_rows", F.when(F.col("user_id") % 7 == 0, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("_rows")))
    with pytest.raises(Exception, match="broken"):
        rfm_state.merge(spark, path, broken)
    assert files(path) == before
