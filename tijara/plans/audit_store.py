"""The audit log kept shredded: its documents' paths as columns, parsed once when a batch arrives.

Beside the log's own columns (the raw ``changes`` too) a row holds

* ``leaf_text``: every path as the document spells it, so the text extract and the numeric-id check lose no digit;
* ``leaf_value``: the paths that have a type, cast from that text;
* ``event_time``: ``updated_at`` as the typed extract casts it, and ``event_month``, its calendar month;
* ``event_stamp``: ``updated_at`` as the since-extract parses it, and ``event_day``, its date.

The extracts read single leaves of the two structs and none parses a document again. Rows are written in ranges of
``event_stamp``, sorted within each file, so the least and greatest day and month of a row group let the scan pass over
groups that a cut or a month can't meet (days and months, as Parquet files keep no usable bounds of zone-free times). A hash of the document is the ranges' second key: events of one and the same moment, or
without one, are dealt over several files. A batch is appended as files of its own; earlier files are not touched.
Documents that are no JSON keep their row with all leaves NULL, as the extracts from the raw log give them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.functions import auditjson as J
from tijara.functions.codes import AUDIT_MESSAGES
from tijara.functions.timeutil import date_lit
from tijara.plans.audit_log import message_filter

ADDED = ("leaf_text", "leaf_value", "event_time", "event_month", "event_stamp", "event_day")


def shred(logs: DataFrame) -> DataFrame:
    """The log with its documents' leaves as columns."""
    if clash := sorted(set(ADDED) & {c.lower() for c in logs.columns}):
        raise ValueError(f"the log already has columns of the store: {clash}")
    leaves = J.leaf_columns("_doc")
    shredded = logs.withColumn("_doc", J.parse_changes("changes")).select(
        *logs.columns, F.struct(*[text.alias(name) for name, text, _ in leaves]).alias("leaf_text"))
    typed = [J.typed(F.col(f"leaf_text.{name}"), t).alias(name) for name, _, t in leaves if t != "string"]
    stamp = F.try_to_timestamp("leaf_text.updated_at", F.lit(J.UPDATED_AT_PATTERN)).cast("timestamp_ntz")
    return shredded.select("*", F.struct(*typed).alias("leaf_value"), stamp.alias("event_stamp")).select(
        *logs.columns, "leaf_text", "leaf_value", F.col("leaf_value.updated_at").alias("event_time"),
        F.month("leaf_value.updated_at").alias("event_month"), "event_stamp", F.to_date("event_stamp").alias("event_day"))


def append(logs: DataFrame, path: str, files: int | None = None) -> None:
    """Shred a batch and add it to the store, clustered by time; each batch once."""
    keys = [F.col("event_stamp"), F.xxhash64("changes")]
    ranges = shred(logs).repartitionByRange(files, *keys) if files else shred(logs).repartitionByRange(*keys)
    ranges.sortWithinPartitions("event_stamp").write.mode("append").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _texts(store: DataFrame) -> DataFrame:
    return store.select(*[F.col(f"leaf_text.{name}").alias(name) for name, _, _ in J.leaf_columns()])


def log_typed(store: DataFrame, month: int, messages: Sequence[str] = AUDIT_MESSAGES) -> DataFrame:
    """Rows of ``audit_log.audit_log_typed``."""
    return message_filter(store, messages).where(F.col("event_month") == month).select(*[
        F.col(f"{'leaf_text' if t == 'string' else 'leaf_value'}.{name}").alias(name) for name, _, t in J.leaf_columns()])


def log_text(store: DataFrame, messages: Sequence[str] = AUDIT_MESSAGES) -> DataFrame:
    """Rows of ``audit_log.audit_log_text``."""
    return _texts(message_filter(store, messages))


def log_since(store: DataFrame, cut: dt.date, messages: Sequence[str] = AUDIT_MESSAGES) -> DataFrame:
    """Rows of ``audit_log.audit_log_since``."""
    later = (F.col("event_day") >= date_lit(cut)) & (F.col("event_stamp") > date_lit(cut).cast("timestamp_ntz"))
    return _texts(message_filter(store, messages).where(later))


def numeric_ids(store: DataFrame) -> DataFrame:
    """Rows of ``audit_log.audit_numeric_ids``."""
    text = F.col("leaf_text.id")
    return store.where(text.isNotNull() & text.rlike(J.NUMERIC_TEXT)).select(
        text.alias("id_text"), F.col("leaf_value.id").alias("id_a"))
