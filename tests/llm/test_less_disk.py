"""What lies on the executors' disks: shares of the product of cells, shuffle files of writes that have ended."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from tijara.llm import decontaminate
from tijara.sources.io import stored


def test_tasks_hand_on_their_own_rows(spark):
    """The shares of A'A q are about as large as q, not as q times the tasks, and add up to the product."""
    n = 10 * decontaminate.HEIGHT - 7
    rng = np.random.default_rng(3)
    full = np.triu(np.where(rng.random((n, n)) < 0.05, rng.random((n, n)), 0))
    full[0] = rng.random(n)  # a word that stands with all others
    q = rng.standard_normal((n, 4)).astype(np.float32)
    cells = spark.createDataFrame([(int(i), int(j), float(full[i, j])) for i, j in zip(*np.nonzero(full), strict=True)],
                                  "first int, second int, weight double").repartition(16)
    dealt = decontaminate.by_rows(cells)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        parts = decontaminate.row_parts(dealt, q).collect()
        tasks = dealt.select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set(key, "true")
    assert tasks > 1 and sum(len(r.part) for r in parts) == q.nbytes
    both = full + np.triu(full, 1).T
    for x in (dealt, stored(dealt, "cells")):
        assert np.allclose(decontaminate._cells_product(x, q), both @ q, atol=1e-3)


def test_product_of_no_cells(spark):
    cells = decontaminate.by_rows(spark.createDataFrame([], "first int, second int, weight double"))
    assert not decontaminate._cells_product(cells, np.ones((5, 2), np.float32)).any()


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(k).getName() for k in range(files.size())}
    return {x for x in names if x.startswith("shuffle_")}


def test_stored_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    counts = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):  # they are removed in the background
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    assert sorted(map(tuple, counts.collect()))[0] == (0, 143)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_stored_keeps_the_sessions_own_setting(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(key, "false")
    try:
        stored(spark.range(3), "few")
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.unset(key)
