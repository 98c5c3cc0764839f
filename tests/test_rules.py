"""Truth tables of the quantity / GMV rules over the full code grid, against a plain
Python statement of the rules (first matching branch wins; NULL codes match nothing)."""

from __future__ import annotations

import decimal
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tijara.functions.rules import ItemCols, Rules

MODES = [1, 2, 3, 4, None]
STATUSES = list(range(11)) + [None]
TYPES = [1, 2, 3]
STOP_STATUSES = [None, 4, 5, 6]
QTYS = [(7, 5, 1), (None, None, None), (4, None, 2)]  # (qty, picked, returned)


def c(x):
    return 0 if x is None else x


def py_rules(m, st, t, ss, stop_key, order_stop, qty, picked, ret, price):
    own, ds = m in (1, 2), m == 3
    dlv = st in (4, 5)
    out = {}
    out["qty_ordered"] = c(qty) if t == 1 else 0
    out["picked_qty"] = c(picked) if own else None
    out["dispatched_qty"] = None if ds else (c(picked) if (t == 1 and own) else 0)
    out["spot_sold_qty"] = None if ds else (c(picked) if (t == 2 and own) else 0)
    if own and dlv:
        delivered = c(picked) - c(ret)
        value_qty = delivered
    elif own and ss == 5:
        delivered = value_qty = 0
    elif ds and dlv:
        delivered = c(qty) - c(ret)
        value_qty = c(picked) - c(ret)
    else:
        delivered = value_qty = 0
    out["delivered_qty"] = delivered
    if own and dlv:
        out["return_qty"] = c(ret)
    elif own and ss == 5:
        out["return_qty"] = c(picked)
    elif ds and dlv:
        out["return_qty"] = c(ret)
    else:
        out["return_qty"] = 0
    out["cancelled_qty"] = c(qty) if st == 6 else 0
    if own and st == 6 and stop_key is None:
        out["pre_dispatch_cancelled_qty"] = c(qty)
    elif ds:
        out["pre_dispatch_cancelled_qty"] = None
    else:
        out["pre_dispatch_cancelled_qty"] = 0
    out["total_pre_dispatch_cancelled_qty"] = c(qty) if (own and st == 6) else 0
    out["value"] = price * value_qty
    # order-mart money
    out["punched_gmv"] = out["qty_ordered"] * price
    out["delivered_gmv"] = delivered * price
    out["cancelled_gmv"] = None if ds else (c(qty) * price if own and st == 6 else 0)
    out["pre_dispatch_cancelled_gmv"] = out["cancelled_qty"] * price
    out["actualized_commission"] = 7.5 / 100 * delivered * float(price)
    # funnel and drop-ship money; a NULL quantity gives NULL where it is not read as 0
    times = None if qty is None else price * qty
    out["funnel_punched_gmv"] = times if t == 1 else 0
    out["funnel_ordered_gmv"] = times if order_stop is not None and t == 1 else 0
    out["funnel_dispatched_gmv"] = price * c(picked) if t == 1 else 0
    spot_value = (None if picked is None else picked * price) if t == 2 else 0
    stop_value = (c(ret) if ss == 4 else c(picked) if ss == 5 else 0) * price
    out["funnel_return_gmv"] = None if spot_value is None else stop_value - spot_value
    out["ds_ordered_gmv"] = times if t == 1 else 0
    out["ds_delivered_gmv"] = (c(qty) - c(ret)) * price if dlv else 0
    out["ds_commission_value"] = float(out["ds_delivered_gmv"]) * (7.5 / 100)
    # funnel
    out["funnel_qty_ordered"] = qty if (order_stop is not None and t == 1) else 0
    stop_ret = c(ret) if ss == 4 else (c(picked) if ss == 5 else 0)
    spot = (picked if t == 2 else 0)
    out["funnel_return_qty"] = None if spot is None else stop_ret - spot
    out["bulk_discount_applies"] = dlv
    return out


def test_rule_grid(spark):
    schema = T.StructType([
        T.StructField("fulfilment_mode_id", T.IntegerType()), T.StructField("status", T.IntegerType()),
        T.StructField("type", T.IntegerType()), T.StructField("stop_status", T.IntegerType()),
        T.StructField("stop_ref", T.LongType()), T.StructField("stop_id", T.LongType()),
        T.StructField("qty", T.LongType()), T.StructField("picked_qty", T.LongType()),
        T.StructField("return_qty", T.LongType()), T.StructField("price", T.DecimalType(18, 2)),
        T.StructField("commission_value", T.DecimalType(5, 2)),
    ])
    data = []
    for m, st, t, ss, (q, p, r) in itertools.product(MODES, STATUSES, TYPES, STOP_STATUSES, QTYS):
        # a stop and its row; no stop; a stop id that names no stop row
        for stop_key, order_stop in ((99, 99),) if ss is not None else ((None, None), (None, 99)):
            data.append((m, st, t, ss, stop_key, order_stop, q, p, r, decimal.Decimal("2.50"), decimal.Decimal("7.50")))
    df = spark.createDataFrame(data, schema)
    R = Rules(ItemCols())
    money = ("punched_gmv", "delivered_gmv", "cancelled_gmv", "pre_dispatch_cancelled_gmv", "actualized_commission",
             "funnel_punched_gmv", "funnel_ordered_gmv", "funnel_dispatched_gmv", "funnel_return_gmv", "ds_ordered_gmv",
             "ds_delivered_gmv", "ds_commission_value")
    out = df.select("*", *[getattr(R, m)().alias(m) for m in money],
                    R.qty_ordered().alias("qty_ordered"), R.picked_qty().alias("picked_qty_r"),
                    R.dispatched_qty().alias("dispatched_qty"), R.spot_sold_qty().alias("spot_sold_qty"),
                    R.delivered_qty().alias("delivered_qty"), R.return_qty().alias("return_qty_r"),
                    R.cancelled_qty().alias("cancelled_qty"),
                    R.pre_dispatch_cancelled_qty().alias("pre_dispatch_cancelled_qty"),
                    R.total_pre_dispatch_cancelled_qty().alias("total_pre_dispatch_cancelled_qty"),
                    R.value().alias("value"), R.funnel_qty_ordered().alias("funnel_qty_ordered"),
                    R.funnel_return_qty().alias("funnel_return_qty")).collect()
    assert len(out) == len(data)
    for row in out:
        exp = py_rules(row.fulfilment_mode_id, row.status, row.type, row.stop_status, row.stop_ref, row.stop_id,
                       row.qty, row.picked_qty, row.return_qty, decimal.Decimal("2.50"))
        got = {
            "qty_ordered": row.qty_ordered, "picked_qty": row.picked_qty_r, "dispatched_qty": row.dispatched_qty,
            "spot_sold_qty": row.spot_sold_qty, "delivered_qty": row.delivered_qty, "return_qty": row.return_qty_r,
            "cancelled_qty": row.cancelled_qty, "pre_dispatch_cancelled_qty": row.pre_dispatch_cancelled_qty,
            "total_pre_dispatch_cancelled_qty": row.total_pre_dispatch_cancelled_qty, "value": row.value,
            "funnel_qty_ordered": row.funnel_qty_ordered, "funnel_return_qty": row.funnel_return_qty,
        }
        for k, v in got.items():
            assert v == exp[k], (k, row, v, exp[k])
        for k in money:
            assert row[k] == (pytest.approx(exp[k]) if isinstance(row[k], float) else exp[k]), (k, row, exp[k])


def test_not_applicable_is_null_not_zero(spark):
    df = spark.createDataFrame([(3, 6, 1, None, None, None, 5, 5, 0)],
                               "fulfilment_mode_id int, status int, type int, stop_status int, stop_ref bigint, "
                               "stop_id bigint, qty bigint, picked_qty bigint, return_qty bigint")
    R = Rules(ItemCols())
    r = df.select(R.picked_qty().alias("p"), R.dispatched_qty().alias("d"),
                  R.pre_dispatch_cancelled_qty().alias("pd"), R.cancelled_qty().alias("cq")).first()
    assert (r.p, r.d, r.pd, r.cq) == (None, None, None, 5)


def test_ratios(spark):
    from tijara.functions.rules import guarded_ratio, safe_ratio

    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    got = [tuple(r) for r in df.select(guarded_ratio(F.col("a"), F.col("b")),
                                       safe_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [(0.0, None), (0.0, None), (1.5, 1.5)]
