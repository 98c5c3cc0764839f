"""Edge cases of the reusable operators."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import functions as F

from tests.conftest import rows
from tijara.functions import codes
from tijara.functions.timeutil import epoch_seconds_to_ntz, local_date, months_back, quarter_end, quarter_label
from tijara.operators.apportion import apportion
from tijara.operators.dims import canonical_int_key, category_descendants, category_parent
from tijara.operators.keyed import best_by_score, latest_per_key, nth_latest_values, top_n_per_key
from tijara.operators.pivot import payment_pivot

D = decimal.Decimal


def test_payment_pivot_absent_vs_null(spark):
    pay = spark.createDataFrame(
        [(1, 1, D("10.00"), None, None), (1, 1, D("5.00"), None, None), (1, 2, None, None, None),
         (2, 5, D("7.00"), None, None)],
        "order_id bigint, payment_types_id int, amount decimal(18,2), total_discount decimal(18,2), "
        "return_amount decimal(18,2)")
    p = {r.order_id: r for r in payment_pivot(pay).collect()}
    assert p[1].amount_COD == D("15.00")       # summed
    assert p[1].amount_Finja == D("0.00")      # present with NULL -> 0
    assert p[1].amount_BNPL is None            # absent -> NULL
    assert p[2].amount_COD is None and p[2].amount_Wallet is None   # unmapped mode still yields the order row
    assert len(p) == 2


def test_apportion_zero_and_null_whole(spark):
    df = spark.createDataFrame([(D("5"), D("0"), D("9")), (D("5"), None, D("9")), (D("1"), D("4"), None),
                                (D("1"), D("4"), D("8"))], "part decimal(18,2), whole decimal(18,2), amt decimal(18,2)")
    got = [r[0] for r in df.select(apportion(F.col("part"), F.col("whole"), F.col("amt"))).collect()]
    assert got == [0.0, 0.0, 0.0, 2.0]


def test_apportioned_amounts_sum_to_order_amount(small_tables):
    from tijara.plans import order_mart

    t = small_tables
    sv = order_mart.order_sku_value(order_mart.order_items_dedup(t["order_items"]), t["orders"], t["stops"])
    ov = order_mart.order_value(sv)
    pv = payment_pivot(t["order_payments"])
    ap = order_mart.payment_apportion(sv, ov, pv)
    per_order = ap.groupBy("order_id").agg(F.sum("OrderPaymentAmountCOD").alias("s"))
    chk = (per_order.join(ov, "order_id").join(pv, "order_id")
           .where(F.col("totalpriceperorder") != 0)
           .select((F.abs(F.col("s") - F.coalesce(F.col("amount_COD"), F.lit(0)).cast("double")) < 1e-6).alias("ok")))
    assert chk.count() > 0 and chk.where(~F.col("ok")).count() == 0


def test_latest_per_key_one_of_a_tie_and_no_null_keys(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 5, "c"), (None, 99, "d"), (2, 1, "e")],
                               "k int, v int, tag string")
    assert rows(latest_per_key(df, "k", "v"), "tag") in ([("a",), ("e",)], [("b",), ("e",)])


def test_best_by_score_tiebreak(spark):
    df = spark.createDataFrame([(1, 0, None, "x"), (1, 1, "p", None), (2, 0, "p", "x"), (2, 1, "p", "x"),
                                (None, 0, "p", "x")], "user_id int, copy_no int, a string, b string")
    from tijara.operators.keyed import completeness_score

    best = best_by_score(df, "user_id", completeness_score(["a", "b"]), [F.col("copy_no")])
    assert rows(best, "user_id", "copy_no", "score") == [(1, 0, 1), (2, 0, 2)]


def test_nth_latest_values(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 3)), (1, dt.date(2020, 1, 3)), (1, dt.date(2020, 1, 1)),
                                (1, dt.date(2020, 1, 2)), (2, dt.date(2021, 5, 5))], "u int, d date")
    got = rows(nth_latest_values(df, "u", "d", 2, ["last", "second"]))
    assert got == [(1, dt.date(2020, 1, 3), dt.date(2020, 1, 2)), (2, dt.date(2021, 5, 5), None)]


def test_top_n_keeps_null_group_when_asked(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k int, v int")
    assert rows(top_n_per_key(df, ["k"], [F.col("v").desc()], 1, drop_null_keys=False)) == [(1, 3), (None, 2)]


def test_canonical_int_key(spark):
    df = spark.createDataFrame([("7",), ("007",), ("-3",), ("x",), (None,), ("1e3",)], "t string")
    got = [r[0] for r in df.select(canonical_int_key(F.col("t"))).collect()]
    assert got == [7, None, -3, None, None, None]


def test_decode_defaults(spark):
    df = spark.createDataFrame([(0,), (3,), (42,), (None,)], "s int")
    got = [tuple(r) for r in df.select(codes.decode("s", {0: "A", 3: "B"}), codes.decode("s", {0: "A"}, default=None),
                                       codes.decode("s", {0: "A"}, default="")).collect()]
    assert got == [("A", "A", "A"), ("B", None, ""), ("42", None, ""), (None, None, "")]


def test_tri_state_and_any_true(spark):
    df = spark.createDataFrame([(True, None), (False, 47), (None, None)], "f boolean, u int")
    got = [tuple(r) for r in df.select(codes.tri_state("f", "I", "M", "O"),
                                       codes.any_true(F.col("f") == F.lit(True), F.col("u") == 47)).collect()]
    assert got == [("I", True), ("M", True), ("O", False)]


def test_size_class_null_goes_to_else(spark):
    df = spark.createDataFrame([(10.0,), (50000.0,), (None,)], "g double")
    assert [r[0] for r in df.select(codes.size_class("g", 50000)).collect()] == ["RDS", "BULK", "BULK"]


def test_time_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 31, 20, 30), dt.date(2023, 5, 31), 1700000000)],
                               "ts timestamp_ntz, d date, e bigint")
    r = df.select(local_date("ts").alias("ld"), quarter_end("d").alias("qe"), quarter_label("d").alias("ql"),
                  months_back(F.col("d"), 3).alias("mb"), epoch_seconds_to_ntz("e").alias("es")).first()
    assert r.ld == dt.date(2023, 2, 1)           # +5 h crosses midnight
    assert r.qe == dt.date(2023, 6, 30)
    assert r.ql == "2023-Q2"
    assert r.mb == dt.date(2023, 2, 28)          # month arithmetic clamps to month end
    assert r.es == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_category_tree(spark):
    cats = spark.createDataFrame([(1, "root", None), (2, "mid", 1), (3, "leaf", 2), (4, "leaf2", 2), (5, "orphan", 77)],
                                 "id int, name string, parent_id int")
    up = {r.category_id: (r.parent_ref, r.parent_name) for r in category_parent(cats).collect()}
    assert up[2] == (1, "root") and up[5] == (None, None)
    down = rows(category_descendants(cats).where(F.col("category_id") == 1), "sub_id", "subsub_id")
    assert down == [(2, 3), (2, 4)]


def test_cumulative_matches_plain_python(spark):
    """To-date values per quarter, counted in plain Python (an order over several quarters included)."""
    from tijara.plans import rfm

    facts = [
        (1, dt.date(2022, 1, 5), D("10.00"), 100, 4), (1, dt.date(2022, 1, 5), D("5.00"), 100, 4),
        (1, dt.date(2022, 5, 1), D("7.00"), 101, 5), (1, dt.date(2022, 8, 9), D("1.00"), 100, 4),
        (2, dt.date(2022, 11, 30), None, None, 6), (2, dt.date(2021, 12, 31), D("3.00"), 200, 4),
        (3, dt.date(2023, 2, 1), None, None, 6), (None, dt.date(2022, 2, 2), D("9.00"), 300, 4),
    ]
    frame = spark.createDataFrame(facts, "user_id bigint, System_Delivery_Date date, Delivered_GMV decimal(18,2), "
                                         "delivered_orders bigint, order_status_code int")
    start, as_of = dt.date(2022, 1, 1), dt.date(2022, 12, 31)
    quarters = [(dt.date(2022, m, 1), dt.date(2022, m + 2, 31 if m in (1, 10) else 30)) for m in (1, 4, 7, 10)]
    want = []
    for user in (1, 2, 3):
        own = [f for f in facts if f[0] == user and f[1] >= start]
        for first, last in quarters:
            due = [f for f in own if f[1] <= last]
            values = [f[2] if f in due else D(0) for f in own]
            values = [v for v in values if v is not None]
            days = {f[1] for f in due}
            want.append((last, first, user, user, float(sum(values)) if values else None,
                         len({f[3] for f in due if f[3] is not None}), len(days), max(days, default=None), min(days, default=None)))
    assert rows(rfm.cumulative(frame, start, as_of)) == sorted(want, key=repr)


def test_left_join_fact_equals_left_join(spark):
    from tijara.operators.dims import left_join_fact

    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (1, "a2"), (4, "d"), (4, "d")], "id int, tag string")
    # key 1 is hot, 3 and 4 have no fact rows, NULL fact keys never match
    fact = spark.createDataFrame([(1, 10)] * 50 + [(2, 20), (None, 99)], "order_id int, v int")
    got = rows(left_join_fact(left, fact, "id", "order_id", left, fact))
    want = rows(left.join(fact, left["id"] == fact["order_id"], "left"))
    assert got == want and len(got) == 104


def test_left_join_spread_equals_left_join(spark):
    from tijara.operators.dims import left_join_spread

    left = spark.createDataFrame([(k, None if k % 10 else k // 10) for k in range(300)], "id int, stop int")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (0, "q"), (None, "n")], "ref int, name string")
    got = rows(left_join_spread(left, right, "stop", "ref", "id"))
    assert got == rows(left.join(right, left["stop"] == right["ref"], "left")) and len(got) == 301


def test_sku_item_dim_equals_two_joins(small_tables):
    """Items met with catalogue and seller in one join, also for SKUs that only one of them knows."""
    from tijara.plans import dimensions, item_facts

    t = small_tables
    items = item_facts.items_of(t)
    two = (items.join(dimensions.sku_catalogue_dim(t), F.col("sku_id") == F.col("sku_ref"), "left")
           .join(dimensions.seller_dim(t), F.col("sku_id") == F.col("psd_sku_id"), "left"))
    one = item_facts.enrich_items(items, t)
    assert sorted(one.columns) == sorted(two.columns)
    assert one.select(*two.columns).exceptAll(two).count() == two.exceptAll(one.select(*two.columns)).count() == 0


def test_latest_per_key_reads_once_and_keeps_one(spark):
    from tijara.operators.keyed import latest_per_key

    logs = spark.createDataFrame([(1, 7, "a"), (3, 7, "b"), (2, 7, "c"), (4, None, "d"), (None, 8, "e")],
                                 "id int, stop_id int, v string")
    assert rows(latest_per_key(logs, "stop_id", "id")) == [(3, 7, "b")]


def test_commission_rounds_exact_halves(spark):
    """25000.00 at 0.29 % is 72.5 exactly: it rounds to 73, which a product of doubles misses."""
    from tijara.plans.fulfilment import commission

    df = spark.createDataFrame([(D("25000.00"), D("0.29")), (D("10.00"), D("5.00")), (D("-25000.00"), D("0.29")), (None, D("1.00"))],
                               "g decimal(18,2), r decimal(5,2)")
    assert [r[0] for r in df.select(commission(F.col("g"), F.col("r"))).collect()] == [73.0, 1.0, -73.0, None]


def test_dedupe_logs_counts_each_stop_once(small_tables):
    """With ``dedupe_logs`` the facts and the funnel equal those over one log per stop."""
    from tijara.operators.keyed import latest_per_key
    from tijara.plans import fulfilment, item_facts

    t = small_tables
    single = t.with_table("transaction_logs", latest_per_key(t["transaction_logs"], "stop_id", "id"))
    for job in (item_facts.fulfilment_item_facts, item_facts.dropship_item_facts, fulfilment.funnel):
        assert rows(job(t, dedupe_logs=True)) == rows(job(single))
    assert item_facts.fulfilment_item_facts(t).count() > item_facts.fulfilment_item_facts(t, dedupe_logs=True).count()


def test_pivot_total_equals_input_total_over_known_modes(small_tables):
    t = small_tables
    pv = payment_pivot(t["order_payments"])
    total_pivot = pv.select(sum(F.coalesce(F.col(f"amount_{m}"), F.lit(0)) for m in ("COD", "Finja", "BNPL", "Wallet"))
                            .alias("s")).agg(F.sum("s")).first()[0]
    total_in = (t["order_payments"].where(F.col("payment_types_id").isin(1, 2, 3, 4))
                .agg(F.sum(F.coalesce("amount", F.lit(0)))).first()[0])
    assert total_pivot == total_in


def test_cumulative_last_quarter_equals_all_time(small_tables):
    from tijara.plans import item_facts, rfm

    start, as_of = dt.date(1995, 1, 1), dt.date(2003, 1, 1)   # calendar covers every fact
    gmv = item_facts.all_gmv(small_tables)
    last = (rfm.cumulative(gmv, start, as_of).where(F.col("first_day_of_quarter") == dt.date(2003, 1, 1))
            .select("rfm_user_id", "Cumulative_delivered_orders", "Cumulative_unique_user_orders"))
    all_time = (gmv.where(F.col("user_id").isNotNull())
                .groupBy(F.col("user_id").alias("rfm_user_id"))
                .agg(F.count_distinct("delivered_orders").alias("o"), F.count_distinct("System_Delivery_Date").alias("d")))
    assert rows(last) == rows(all_time)


def test_funnel_identities(small_tables):
    from tijara.plans import fulfilment

    f = fulfilment.fulfilment_funnel(small_tables)
    bad = f.where(F.abs(F.col("Pre-Dispatch Cancellation") - (F.col("Total Punched GMV") - F.col("Ordered GMV"))) > 1e-6)
    bad = bad.unionByName(f.where(F.abs(F.col("Unfulfilled") - (F.col("Ordered GMV") - F.col("Dispatched GMV"))) > 1e-6))
    assert f.count() > 0 and bad.count() == 0
