"""Apportion order-level amounts to order lines by value share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, whole: Column) -> Column:
    """part / whole in floating point (NULL when either side is NULL)."""
    return part.cast("double") / whole.cast("double")


def apportion(part: Column, whole: Column, amount: Column) -> Column:
    """``CASE WHEN whole != 0 THEN part / whole * coalesce(amount, 0) ELSE 0 END``.

    A zero or NULL whole gives 0: nothing to split by.
    """
    return (F.when(whole != 0, share(part, whole) * F.coalesce(amount, F.lit(0)).cast("double"))
            .otherwise(F.lit(0.0)))
