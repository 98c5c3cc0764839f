"""Time helpers: local-time shift, quarter calendar pieces, rolling bounds.

Timestamps are stored in UTC as TIMESTAMP_NTZ; reports show local wall clock
(UTC+5 by default). All of it is interval arithmetic, so nothing depends on the
session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_OFFSET_HOURS = 5


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_local(ts, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """UTC timestamp -> local wall clock (``ts + interval N hours``)."""
    return _c(ts) + F.expr(f"INTERVAL {int(offset_hours)} HOURS")


def local_date(ts, offset_hours: int = LOCAL_OFFSET_HOURS) -> Column:
    """Calendar date of the local wall clock."""
    return F.to_date(to_local(ts, offset_hours))



def ntz(value) -> Column:
    """Literal TIMESTAMP_NTZ (zone-free) from a datetime/date/text."""
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value) -> Column:
    """A DATE from a date/datetime/ISO text (or a Column, cast)."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat()[:10]
    return F.lit(value).cast("date")


def quarter_start(d) -> Column:
    """DATE_TRUNC(d, QUARTER) as DATE."""
    return F.trunc(_c(d), "quarter")


def quarter_end(d) -> Column:
    """Last day of d's quarter: first day + 1 quarter - 1 day."""
    return F.date_sub(F.add_months(quarter_start(d), 3), 1)


def quarter_label(d) -> Column:
    """'2022-Q1' style label."""
    return F.concat(F.year(_c(d)).cast("string"), F.lit("-Q"), F.quarter(_c(d)).cast("string"))


def months_back(as_of, months: int) -> Column:
    """DATE_SUB(as_of, INTERVAL n MONTH): month arithmetic clamps to month end."""
    return F.add_months(_c(as_of) if not isinstance(as_of, (dt.date, str)) else date_lit(as_of), -months)


def epoch_seconds_to_ntz(seconds) -> Column:
    """TIMESTAMP_SECONDS(n) as a zone-free timestamp."""
    return F.timestamp_add("SECOND", _c(seconds), ntz("1970-01-01 00:00:00"))
