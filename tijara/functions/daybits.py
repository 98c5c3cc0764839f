"""Distinct days as bits: a mergeable count for days of a bounded span.

A day's place in its span is one bit of a few 64-bit words that ``bit_or`` combines, before the shuffle and after
it. So any number of such counts (days, months, with or without a condition) fit one hash aggregation, where
Spark's own distinct counts of several columns would expand every row. (The built-in bitmap aggregate serves dense
numbers of any size, but takes 4 KB for each group; a quarter's days take two words.)
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def count_of(words: list[Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for w in words:
        total = total + F.coalesce(F.bit_count(w), F.lit(0))
    return total


def distinct_places(place: Column, span: int) -> Column:
    """Aggregate: how many different values ``place`` has; all must lie in 0 .. span - 1, NULLs don't count."""
    return count_of([F.bit_or(F.when((place >= 64 * k) & (place < 64 * (k + 1)), _bit(place - 64 * k)))
                     for k in range(-(-span // 64))])


def distinct_days(day: Column, first: Column, span: int) -> Column:
    """Aggregate: how many different days, of the ``span`` days from ``first`` on."""
    return distinct_places(F.datediff(day, first), span)


def distinct_months_of_quarter(day: Column) -> Column:
    """Aggregate: how many different months, of days that lie in one quarter."""
    return distinct_places(F.pmod(F.month(day) - 1, F.lit(3)), 3)
