"""The decontamination's latent space and the language model's mixer are fitted on all rows, not on a sample."""

from __future__ import annotations

import numpy as np

from tests.llm.conftest import frame
from tijara.llm import context_mixing, decontaminate
from tijara.llm.common import texts_of


def test_latent_space_takes_the_passages_of_all_documents(spark):
    docs = texts_of(frame(spark, [(i, "alpha " * 70 + "rare" if i % 2 else "none of them") for i in range(5000)] + [(1, None)]))
    vocabulary = decontaminate.Vocabulary({b"alpha": 0, b"rare": 1, b"never": 2})
    rows = decontaminate.passage_rows(docs, vocabulary, np.array([1, 2, 0], np.float32)).collect()
    assert len(rows) == 2 * 2500 and not any(r.own for r in rows)
    assert sorted({tuple(r.terms) for r in rows}) == [(0,) * 64, (0,) * 6 + (1,)]


def test_product_equals_dense_product(spark):
    rng = np.random.default_rng(1)
    rows = [(rng.integers(0, 9, rng.integers(1, 6)).tolist(), bool(i % 3 == 0)) for i in range(2500)] + [([], False)]
    idf, q = np.array([1, 2, 0, 3, 1, 1, 2, 1, 0], np.float32), rng.standard_normal((9, 4)).astype(np.float32)
    a = np.zeros((len(rows), 9))
    for i, (terms, _) in enumerate(rows):
        np.add.at(a[i], terms, idf[terms])
        # a repeated term is a component of its own in the norm
        a[i] /= max(np.sqrt((idf[terms] ** 2).sum()), 1e-9)
    weight = np.array([2.5 if own else 1 for _, own in rows])
    df = spark.createDataFrame(rows, "terms array<int>, own boolean")
    assert np.allclose(decontaminate._product(df, idf, 2.5, q), a.T @ (weight[:, None] * (a @ q)), atol=0.01)


def test_every_training_word_is_learned_from(spark, monkeypatch):
    words = [(f"w{i:03d}".encode(), i + 1) for i in range(300)]
    df = spark.createDataFrame(words, "word binary, n bigint")
    one = context_mixing.fit(df)
    monkeypatch.setattr(context_mixing, "MIXER_WORDS", 20)
    many = context_mixing.fit(df)
    ones, totals = context_mixing.context_tables(df)
    parts = context_mixing.learners(df, ones, totals).collect()
    assert len({r.learner for r in parts}) > 5
    learned = {}
    for r in sorted(parts, key=lambda r: r.block):
        learned.setdefault(r.learner, []).append(np.frombuffer(r.part))
    size = one.weights.size
    visits = sum(np.concatenate(p)[size:size + context_mixing.GATES].sum() for p in learned.values())
    assert visits == 300 * 5 * 8  # each bit of each word and its blank
    assert np.abs(many.weights - one.weights).max() < 0.3
    assert not np.array_equal(many.weights, np.full(one.weights.shape, 0.3))


def test_cells_are_handed_on_and_summed(spark, monkeypatch):
    """The cells of A'A, also when tasks hand them on early: one row per pair of terms, however many documents."""
    rng = np.random.default_rng(8)
    rows = [(rng.integers(0, 12, int(rng.integers(0, 20))).tolist(), bool(k % 5 == 0)) for k in range(300)]
    df = spark.createDataFrame(rows, "terms array<int>, own boolean").repartition(3)
    idf = np.where(np.arange(12) == 4, 0, rng.random(12) + 0.1).astype(np.float32)
    dense = np.zeros((12, 12))
    for terms, own in rows:
        a = np.bincount(terms, idf[terms], 12) if terms else np.zeros(12)
        norm = np.sqrt((idf[terms].astype(float) ** 2).sum()) if terms else 0
        dense += np.outer(a, a) * (2.5 if own else 1) / (norm**2 or 1)
    for pairs in (64, 1 << 20):
        monkeypatch.setattr(decontaminate, "PAIRS", pairs)
        found = decontaminate.gram(df, idf, 2.5).collect()
        assert len({(r.first, r.second) for r in found}) == len(found) <= 11 * 12 // 2
        assert all(r.first <= r.second and np.isclose(r.weight, dense[r.first, r.second], rtol=1e-5) for r in found)
        assert np.count_nonzero(np.triu(dense)) == len(found)


def test_row_sums():
    rng = np.random.default_rng(9)
    space, term = rng.random((7, 3)).astype(np.float32), rng.integers(0, 7, 40)
    starts = np.array([0, 1, 5, 6, 30, 39])
    assert np.allclose(decontaminate.row_sums(space, term, starts), np.add.reduceat(space[term], starts, axis=0))
