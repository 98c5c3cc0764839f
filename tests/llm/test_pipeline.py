"""The pipeline's stages against plain versions of what they decide."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from tests.llm.conftest import CLASHING, SMALL, frame
from tests.llm.test_brute_force import A_TO_Z, brute_components
from tijara.llm import decontaminate


def test_stages_follow_each_other(spark, small_docs, small_texts):
    """Each stage over what its predecessor kept; the last returns one row per remaining document."""
    docs, kept = small_docs, dict(small_texts)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "bpe":
            assert out.columns == small_docs.columns
            out = out.cache()
        ids = sorted(r.doc_id for r in out.collect())
        if name == "quality":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            good = [i for i in kept if labels.get(i) == 1]
            assert set(ids) <= set(kept) and len(set(good) & set(ids)) >= 0.95 * len(good)
        elif name == "exact_dedup":
            best = {}
            for i, t in kept.items():
                best[t.translate(A_TO_Z)] = max(i, best.get(t.translate(A_TO_Z), i))
            assert ids == sorted(best.values())
        elif name == "near_dedup":
            assert ids == sorted(i for i, (_, c) in brute_components(kept, 5, 80).items() if i == c)
        elif name == "decontaminate":
            leaking = set()
            for p in decontaminate.passages_of(items):
                for i, t in kept.items():
                    w = decontaminate.words_of(t.encode())
                    share, answer, _, _ = p.check(w, 0, len(w), set())
                    if share >= decontaminate.VERBATIM or (share >= decontaminate.PARAPHRASE and answer):
                        leaking.add(i)
            assert leaking and set(ids) >= set(kept) - leaking and len(set(ids) & leaking) <= 0.1 * len(leaking)
        else:
            assert ids == sorted(kept)
        kept = {i: kept[i] for i in ids}
        docs = out
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)


def test_stages_keep_odd_rows(spark):
    """Nulls, empty texts and extra columns pass every filtering stage."""
    rows = [(None, None), (1, None), (2, ""), (3, "some words here"), (4, "Some Words here"), (None, "no id")]
    df = frame(spark, rows, CLASHING)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SMALL)
        assert out.columns == df.columns
        got = sorted(map(repr, ((r.doc_id, r.text) for r in out.collect())))
        if name == "exact_dedup":  # of equal texts the largest id stays; rows without an id stay together
            assert got == sorted(map(repr, [(2, ""), (4, "Some Words here"), (None, "no id"), (None, None)]))
        elif name == "near_dedup":
            assert got == sorted(map(repr, [r for r in rows if r[0] != 4]))
        else:
            assert got == sorted(map(repr, rows))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_an_empty_table(spark, small_docs, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, small_docs.limit(0), SMALL)
    assert out.count() == 0


def test_words_of_the_two_operators_differ_on_purpose():
    """Decontamination drops punctuation, the Jaccard join keeps it with its word."""
    assert decontaminate.words_of(b"A-b, c") == [b"a", b"b", b"c"]
    assert re.findall(r"[^\x20\x09-\x0D]+", "a-b, c") == ["a-b,", "c"]
