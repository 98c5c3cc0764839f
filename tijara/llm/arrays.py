"""Running totals and searches within a row's arrays, with DataFrame functions only.

``aggregate`` over an array that grows by ``concat`` copies it for every element. Here a scan doubles its reach in each
of log2(n) passes over the array, and a search halves its range, so long arrays take n log n steps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def powers_of_two(size: Column) -> Column:
    """1, 2, 4, ... below ``size``, and 1 at least."""
    last = F.ceil(F.log2(F.greatest(size, F.lit(2)))).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.call_function("shiftleft", F.lit(1), k))


def running(array: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """At each place what ``combine`` (associative) makes of the elements up to there."""
    return F.aggregate(powers_of_two(F.size(array)), array, lambda acc, step: F.transform(
        acc, lambda x, i: F.when(i >= step, combine(F.get(acc, i - step), x)).otherwise(x)))


def count_at_most(ascending: Column, limit: Column) -> Column:
    """How many elements of an ascending array are at most ``limit``."""
    return F.aggregate(F.reverse(powers_of_two(F.size(ascending) + 1)), F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(ascending)) & (F.get(ascending, at + step - 1) <= limit), at + step).otherwise(at))
