"""Payment pivot: one row per order, (measure x payment mode) columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tijara.functions.codes import PAYMENT_MODE, decode

PAYMENT_MEASURES = ("total_discount", "amount", "return_amount")


def payment_pivot(payments: DataFrame, *, key: str = "order_id", mode_col: str = "payment_types_id",
                  modes: Mapping[int, str] = PAYMENT_MODE, measures: Sequence[str] = PAYMENT_MEASURES) -> DataFrame:
    """``PIVOT(sum(coalesce(m, 0)) AS m ... FOR mode IN (...))`` grouped by ``key``.

    Output columns ``<measure>_<mode>`` (e.g. ``amount_COD``). A mode the order never
    used is NULL; a used mode whose amounts are all NULL is 0. Rows with an unmapped
    mode still create the order's row (all NULL). The explicit value list lets Spark
    plan a two-phase pivot aggregation (partial per map task, no value discovery job).
    """
    labels = list(modes.values())
    shaped = payments.select(
        key, decode(mode_col, modes, default=None).alias("_mode"),
        *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in measures])
    pivoted = shaped.groupBy(key).pivot("_mode", labels).agg(*[F.sum(m).alias(m) for m in measures])
    # Spark names pivot cells <value>_<alias>; expose <measure>_<mode>
    return pivoted.select(key, *[F.col(f"{mode}_{m}").alias(f"{m}_{mode}") for m in measures for mode in labels])
