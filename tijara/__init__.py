"""tijara: marketplace analytics jobs expressed as Spark DataFrame plans.

Layout
------
sources/    logical-name table access (catalog or parquet), mart sink, test-data bindings
functions/  Column builders: code tables, time helpers, quantity/GMV rules, audit JSON schema
operators/  DataFrame -> DataFrame building blocks: keyed selection, pivot, apportion, dims, running-to-date
plans/      the composite data jobs (order mart, fulfilment funnel, monthly GMV, RFM, ...)
streaming/  incremental (Structured Streaming) runner for the stateless audit-log extract
"""

from tijara.session import local_session

__all__ = ["local_session"]
