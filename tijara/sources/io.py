"""Scans by logical name and the mart sink.

A job never hard-codes where a table lives: it receives a ``Tables`` mapping from
logical names (``orders``, ``order_items`` ...) to DataFrames. Three ways to build one:

* ``CatalogTables(spark, database)``  -> ``spark.table("db.name")`` (warehouse / metastore)
* ``ParquetTables(spark, root)``      -> ``spark.read.parquet(root/name)``
* ``sources.testdata.TestTables``     -> domain views derived from the bundled test tables
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tijara.session import checkpoint_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables(Mapping):
    """Lazy, memoised name -> DataFrame mapping (each name is planned once).

    ``names`` lists the tables when known up front; otherwise ``exists(name)`` answers
    ``name in tables`` (catalog lookup, path check).
    """

    def __init__(self, factory: Callable[[str], DataFrame], names: list[str] | None = None,
                 exists: Callable[[str], bool] | None = None):
        self._factory = factory
        self._names = names
        self._exists = exists
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._factory(name)
        return self._cache[name]

    def __contains__(self, name: object) -> bool:
        if name in self._cache:
            return True
        if self._names is not None:
            return name in self._names
        return bool(self._exists and self._exists(name))

    def __iter__(self):
        return iter(self._names if self._names is not None else list(self._cache))

    def __len__(self) -> int:
        return len(self._names if self._names is not None else self._cache)

    def with_table(self, name: str, df: DataFrame) -> "Tables":
        """Same mapping with one name bound to a given DataFrame (e.g. a derived mart)."""
        base = self
        names = None if self._names is None else sorted(set(self._names) | {name})
        return Tables(lambda n: df if n == name else base[n], names, lambda n: n == name or n in base)


def CatalogTables(spark: SparkSession, database: str | None = None) -> Tables:
    def load(name: str) -> DataFrame:
        return spark.table(f"{database}.{name}" if database else name)

    def exists(name: str) -> bool:
        return spark.catalog.tableExists(f"{database}.{name}" if database else name)

    return Tables(load, exists=exists)


def ParquetTables(spark: SparkSession, root: str) -> Tables:
    def path(name: str) -> str:
        return f"{root.rstrip('/')}/{name}"

    def load(name: str) -> DataFrame:
        return spark.read.parquet(path(name))

    def exists(name: str) -> bool:
        try:
            load(name)
            return True
        except AnalysisException:
            return False

    return Tables(load, exists=exists)


def load_raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One bundled test table (``<dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tijara-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage: an executor lost later costs a re-read, not a re-computation. Joins are planned by
    the written size, not the size of the table it was filtered from. The write's shuffle files go when it ends
    (where the session leaves that open): nothing reads them again, and they would stay on the executors' disks
    until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    ours = spark.conf.get(SHUFFLE_CLEANUP, None) is None
    if ours:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if ours:
            spark.conf.unset(SHUFFLE_CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def write_mart(df: DataFrame, schema: str, name: str, *, path: str | None = None,
               partition_by: list[str] | None = None, bucket_by: tuple[int, list[str]] | None = None,
               mode: str = "overwrite") -> None:
    """Sink a mart into a named schema (``config(schema=...)`` of the source models).

    Column names with spaces or symbols are kept: parquet stores them as-is.
    ``path`` makes it an external table (the form used in tests without a metastore).
    ``partition_by`` lets date filters prune directories; ``bucket_by=(n, cols)`` stores
    the table hash-bucketed so joins / aggregations on ``cols`` with another table
    bucketed the same way read co-located buckets without a shuffle.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(f"`{schema}`.`{name}`")
