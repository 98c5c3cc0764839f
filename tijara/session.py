"""Spark session defaults for the jobs.

A submitted job takes the session as the cluster set it up; ``configure`` only fills settings
that are unset. Only ``local_session`` (tests, bench) sizes anything to the machine.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings the jobs rely on. AQE re-plans joins from runtime sizes (sort-merge ->
# broadcast when a side turns out small, skew splitting for hot keys) and
# coalesces small shuffle partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # split a hot key also where the next operator then needs another shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # all timestamps are TIMESTAMP_NTZ; UTC keeps any LTZ literal stable
    "spark.sql.session.timeZone": "UTC",
    # the jobs build plans of hundreds of Column expressions; per-call Python stack
    # capture (error-context only) costs several JVM round trips per expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session has no value of its own.

    Static settings (fixed when the application started) are left alone.
    """
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, "") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    This is a static setting: it is read, never overridden. Where the session names none, a
    single-machine ``local[...]`` run gets a scratch folder; on a cluster that is an error,
    because a machine-local folder would be invisible to the other machines.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tijara-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once (they need not have it installed)."""
    sc = spark.sparkContext
    if getattr(sc, "_tijara_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tijara-package-"), "tijara-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._tijara_shipped = True


def job_session(name: str = "tijara") -> SparkSession:
    """Session of a submitted job: every setting of the submit stays, DEFAULTS fill what is unset."""
    return configure(SparkSession.builder.appName(name).getOrCreate())


def local_session(master: str = "local[*]", shuffle_partitions: int | None = None) -> SparkSession:
    """Single-machine session for tests and the bench, sized to its cores."""
    builder = (
        SparkSession.builder.appName("tijara").master(master)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or os.cpu_count() or 8))
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
