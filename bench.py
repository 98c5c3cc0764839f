"""Benchmark the headline jobs.

The jobs read domain tables by logical name (orders, order_items, stops, ...).
In production those are warehouse tables; here they are derived from the TPC-H
style test data in ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1). The bench

1. times each job end-to-end from the raw test tables, deriving the domain views
   inside the same plan (``queries`` / ``value``), and
2. writes every domain table once as parquet into a fresh scratch folder (untimed
   setup, like loading a warehouse) and times each job over those tables
   (``queries_on_domain_tables`` / ``value_on_domain_tables``).

Each run executes the whole plan into Spark's ``noop`` sink (all rows and
columns, nothing collected). One warm-up run, then the median of ``$BENCH_RUNS``
(default 3). ``local[$BENCH_CPUS]``. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tijara.registry import QUERIES, all_queries, tables_for  # noqa: E402
from tijara.session import local_session  # noqa: E402
from tijara.sources.io import ParquetTables  # noqa: E402

HEADLINE = ("monthly_delivered_gmv", "order_denormalized", "fulfilment_reconciled", "rfm_report",
            "audit_log_typed", "retailer_performance")


def timed(make_df) -> float:
    t0 = time.perf_counter()
    make_df().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def median_time(make_df, runs: int) -> float:
    timed(make_df)  # warm-up: JIT, file listing, codegen caches
    return round(statistics.median(timed(make_df) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(sys.argv[1:]) or list(HEADLINE)
    spark = local_session(f"local[{cpus}]", shuffle_partitions=cpus * 2)
    qs = all_queries()

    # setup: domain tables as parquet (a new scratch folder per run)
    raw_tables = tables_for(spark, sf_dir)
    warehouse = tempfile.mkdtemp(prefix="tijara-bench-")
    t0 = time.perf_counter()
    for name in raw_tables:
        raw_tables[name].write.parquet(f"{warehouse}/{name}")
    setup = round(time.perf_counter() - t0, 3)
    tables = ParquetTables(spark, warehouse)

    from_raw = {n: median_time(lambda n=n: qs[n](spark, sf_dir), runs) for n in names}
    on_tables = {n: median_time(lambda n=n: QUERIES[n](tables), runs) for n in names}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec", "value": round(sum(from_raw.values()), 3), "unit": "sec",
        "queries": from_raw, "sf": sf, "cpus": cpus, "runs": runs,
        "value_on_domain_tables": round(sum(on_tables.values()), 3), "queries_on_domain_tables": on_tables,
        "setup_materialize_sec": setup}))
    spark.stop()


if __name__ == "__main__":
    main()
