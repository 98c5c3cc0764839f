"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, DOCS, frame
from tijara.llm import (bpe_codec, context_mixing, decontaminate, exact_dedup, jaccard_join, license_scan, quality_knn,
                        secret_scan, substring_dedup, token_counts)
from tijara.llm.common import work_path

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = "alpha beta gamma delta token = \"0123456789abcdef0123456789abcdef\" under the MIT license. " * 4000
ROWS = [(1, "Some words, released under the MIT License."), (1, "Some words, released under the MIT License."),
        (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "x"), (7, "\U0001F600 é ñ"), (None, "no id"), (None, None),
        (8, "some words, released under the mit license.")]


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def labels(spark):
    return spark.createDataFrame([(1, 1), (5, 0), (6, None), (None, 1), (6, 0), (6, 1)], "doc_id bigint, quality int")


ITEM = "alpha beta gamma delta token 0123456789abcdef0123456789abcdef under the MIT license"
OPERATORS = {
    "quality": lambda spark, d: quality_knn.score(d, quality_knn.fit(d, labels(spark), F.lit(True))),
    "licenses": lambda spark, d: license_scan.license_scan(d),
    "tokens": lambda spark, d: token_counts.count_tokens(d, WORD_BPE, work_path(spark, "cache")),
    "near": lambda spark, d: jaccard_join.jaccard_components(d),
    "model": lambda spark, d: context_mixing.lm_scores(d, F.col("doc_id") != 3),
    "secrets": lambda spark, d: secret_scan.secret_scan(d),
    "codec": lambda spark, d: bpe_codec.round_trip(d, BYTE_BPE),
    "exact": lambda spark, d: exact_dedup.exact_dedup(d, exact_dedup.snapshot_of(F.col("doc_id"))),
}


@pytest.fixture(scope="module")
def results(spark):
    df = frame(spark, ROWS, CLASHING)
    return {name: sorted(op(spark, df).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, repr(r)))
            for name, op in OPERATORS.items()}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(results, name):
    assert len(results[name]) == len(ROWS)
    assert [r.doc_id for r in results[name]] == [1, 1, 2, 3, 4, 5, 6, 7, 8, None, None]
    one, two = results[name][:2]
    assert one == two  # repeated rows repeat their result


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], DOCS)).collect() == []


def at(rows, doc_id):
    return next(r for r in rows if r.doc_id == doc_id)


def test_defined_values(results):
    for empty in (2, 3):
        assert at(results["quality"], empty).score == 0.5 and at(results["quality"], empty).predicted == 1
        r = at(results["licenses"], empty)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (0, 0, None, None, "", "", 0)
        r = at(results["tokens"], empty)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (0, 0, False)
        r = at(results["near"], empty)
        assert (r.n_shingles, r.component_id) == (0, empty)
        assert at(results["model"], empty).n_tokens == 1
        r = at(results["secrets"], empty)
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) == (0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
        r = at(results["codec"], empty)
        assert r.n_tokens == 0 and r.ids_sha256 == r.decoded_sha256 == hashlib.sha256(b"").hexdigest()
        r = at(results["exact"], empty)
        assert r.group_size == 3 and r.keep_id == 3 and r.kept is (empty == 3)
    assert [r.component_id for r in results["near"] if r.doc_id in (1, 8)] == [1, 1, 1]
    r = at(results["exact"], 1)
    assert (r.keep_id, r.group_size, r.kept) == (8, 3, False)
    assert at(results["exact"], None).doc_id is None
    long = at(results["licenses"], 5)
    assert long.n_base == 4000 and long.first_word == 6 and long.labels == "mit"
    long = at(results["secrets"], 5)
    assert long.n_assign == long.n_hex == 4000
    assert at(results["codec"], 5).decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()


def test_search_operators(spark):
    df = frame(spark, ROWS, CLASHING)
    found = decontaminate.leaks(df, benchmark(spark, [(1, ITEM), (1, ITEM), (2, None), (3, ""), (None, "too short")])).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(5, 1)}
    assert decontaminate.leaks(df, benchmark(spark, [])).collect() == []
    assert decontaminate.leaks(spark.createDataFrame([], DOCS), benchmark(spark, [(1, ITEM)])).collect() == []
    assert substring_dedup.repeated_passages(spark.createDataFrame([], DOCS)).collect() == []
    again = frame(spark, [*ROWS, (9, LONG)], CLASHING)
    found = substring_dedup.repeated_passages(again).collect()
    assert [(r.doc_id, r.start_word, r.other_id, r.other_start) for r in found] == [(9, 0, 5, 0)]


def test_no_labels(spark):
    df = frame(spark, ROWS)
    nothing = spark.createDataFrame([], "doc_id bigint, quality int")
    scored = quality_knn.score(df, quality_knn.fit(df, nothing, F.lit(True))).collect()
    assert {(r.score, r.predicted) for r in scored} == {(0.5, 1)}


@pytest.mark.parametrize("bound", [1, 100])
def test_ids_beyond_the_broadcast_bound(spark, monkeypatch, bound):
    """Few ids are broadcast, many are joined by a shuffle; the rows are the same."""
    from tijara.llm import common

    monkeypatch.setattr(common, "BROADCAST_IDS", bound)
    df = frame(spark, [(k, "t") for k in range(20)])
    ids = spark.createDataFrame([(3,), (5,), (99,)], "doc_id bigint")
    assert sorted(r.doc_id for r in common.among(df, ids, "doc_id").collect()) == [3, 5]


def test_count_threshold_takes_counts_whole(spark):
    from tijara.llm.common import count_for

    counts = spark.createDataFrame([(5,), (4,), (4,), (2,)], "n bigint")
    assert [count_for(counts, k) for k in (0, 1, 2, 3, 4, 9)] == [None, 5, 5, 4, 2, 2]
