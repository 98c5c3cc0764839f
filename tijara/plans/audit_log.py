"""Audit-log extracts: typed / text flattening of the JSON ``changes`` document.

All stateless row operations (filter, parse, cast), so they run unchanged on a
streaming DataFrame as well (see ``tijara.streaming``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tijara.functions import auditjson as J
from tijara.functions.codes import AUDIT_MESSAGES
from tijara.functions.timeutil import date_lit


def message_filter(logs: DataFrame, messages: Sequence[str] = AUDIT_MESSAGES) -> DataFrame:
    """Keep log rows whose payload is one of ``messages`` (an ``InSet`` pushed to the scan)."""
    return logs.where(F.col("payload").isin(*messages))


def _flatten(logs: DataFrame, typed: bool, keep: Sequence[str] = ()) -> DataFrame:
    parsed = logs.select(*keep, J.parse_changes("changes").alias("_doc"))
    cols: list[Column] = [F.col(k) for k in keep]
    for name, text, sql_type in J.leaf_columns("_doc"):
        cols.append((J.typed(text, sql_type) if typed else text).alias(name))
    return parsed.select(*cols)


def _updated_at_text() -> Column:
    """``changes -> 'current' ->> 'updated_at'`` read alone (a streaming path lookup, no full parse)."""
    return F.get_json_object(F.col("changes"), "$.current.updated_at")


def audit_log_typed(logs: DataFrame, month: int, messages: Sequence[str] = AUDIT_MESSAGES) -> DataFrame:
    """45 typed columns of product/SKU change events; rows whose ``updated_at`` falls in
    calendar month ``month`` of any year.

    The month test reads the one path it needs, so the full document is parsed only
    for rows that are kept (filtering on the flattened column would make Catalyst
    evaluate the full parse twice: once in the pushed-down filter, once in the projection).
    """
    kept = message_filter(logs, messages).where(
        F.month(J.typed(_updated_at_text(), "timestamp_ntz")) == month)
    return _flatten(kept, typed=True)


def audit_log_text(logs: DataFrame, messages: Sequence[str] = AUDIT_MESSAGES) -> DataFrame:
    """The same 45 paths as text."""
    return _flatten(message_filter(logs, messages), typed=False)


def audit_log_since(logs: DataFrame, cut: dt.date, messages: Sequence[str] = AUDIT_MESSAGES) -> DataFrame:
    """Text extract of events whose ``updated_at`` text parses to a time after midnight of ``cut``.

    The parse yields a session-zone timestamp; taking it back to zone-free wall clock
    makes the comparison independent of the session zone.
    """
    parsed = F.try_to_timestamp(_updated_at_text(), F.lit(J.UPDATED_AT_PATTERN)).cast("timestamp_ntz")
    kept = message_filter(logs, messages).where(parsed > date_lit(cut).cast("timestamp_ntz"))
    return _flatten(kept, typed=False)


def audit_numeric_ids(logs: DataFrame) -> DataFrame:
    """Raw ``current.id`` text and its numeric value, where the text, as the document spells it, is a plain decimal number."""
    doc = J.parse_changes("changes", "current struct<id: string>")
    return (logs.select(doc.alias("_doc")).select(F.col("_doc.current.id").alias("id_text"))
            .where(F.col("id_text").isNotNull() & F.col("id_text").rlike(J.NUMERIC_TEXT))
            .select("id_text", F.col("id_text").try_cast("double").alias("id_a")))
