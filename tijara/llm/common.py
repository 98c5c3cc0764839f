"""Helpers shared by the document operators: whole texts, the shared work folder, Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tijara.session import ship_package
from tijara.sources.io import stored, work_path  # noqa: F401  (for the operators)

SLICE_BYTES = 1 << 20  # text bytes handled at once by a Python task
SLICE_ROWS = 2000
BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
BROADCAST_IDS = 1 << 20


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def prepare(spark: SparkSession) -> None:
    """Package to the workers; fewer rows per Arrow batch where the session leaves that open, as rows hold whole texts."""
    ship_package(spark)
    if spark.conf.get(BATCH_ROWS[0], None) is None:
        spark.conf.set(*BATCH_ROWS)


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every row; a null text counts as empty."""
    prepare(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def release_memory() -> None:
    """Give freed memory back to the system: a worker is used again by later jobs, and would hold its peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of about ``size`` bytes of ``column``; one row is never cut."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and (total + n > size or i - start >= SLICE_ROWS):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < len(sizes):
            yield batch.slice(start)
    release_memory()


def utf8(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts as UTF-8 bytes (Arrow holds them so already)."""
    a = batch.column(column)
    return a.cast(pa.large_binary() if pa.types.is_large_string(a.type) else pa.binary()).to_pylist()


def among(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``ids`` (a stored table of that one column).

    Up to BROADCAST_IDS ids (8 MB, below Spark's usual threshold) are counted and broadcast, so that
    ``df`` with its texts stays where it is; more are joined by a shuffle.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, key, "left_semi")


def count_for(counts: DataFrame, n: int) -> int | None:
    """The least value of column ``n`` such that at most ``n`` rows have it or more; None if none fits.

    From the histogram of values, so that rows of one count are taken all or not at all and what is
    collected for them is bounded, whatever the number of partitions.
    """
    w = Window.orderBy(F.desc("n"))
    steps = counts.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).withColumn("above", F.sum("rows").over(w))
    return steps.where(F.col("above") <= n).agg(F.min("n")).first()[0]


def crc_remainder(doc_id, divisor: int):
    """crc32(doc_id as text) mod ``divisor``, as the held-out rules define it."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(divisor))
