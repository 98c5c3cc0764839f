from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows, extra: dict | None = None):
    """documents-like frame of (doc_id, text) rows, with extra columns of clashing names if wanted."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    for name, value in (extra or {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


# columns that the operators use inside, as columns of the input
CLASHING = {c: "x" for c in ("sha", "digest", "snapshot", "n", "sig", "prefix", "group", "score", "n_tokens", "ids", "row",
                             "trains", "component", "id", "leak_id", "kept_id", "seed", "bits", "held_out")}


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()


@pytest.fixture(scope="session")
def small_texts(small_docs):
    return {r.doc_id: r.text or "" for r in small_docs.collect()}
