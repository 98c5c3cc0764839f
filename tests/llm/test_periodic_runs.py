"""Periodic runs against a search of every period; wavelet matrix; edge cases."""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import CLASHING, DOCS, SMALL, frame
from tijara.llm.periodic_runs import WaveletMatrix, find_runs, op11_periodic_runs, periodic_runs


def every_run(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: every period's maximal stretches, the smallest period of a stretch."""
    number: dict = {}
    w = np.array([number.setdefault(x, len(number)) for x in words], np.int64)
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // 4 + 1):
        same = np.concatenate([[0], (w[:-q] == w[q:]).astype(np.int8), [0]])
        step = np.diff(same)
        for s, e in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True):
            if e - s + q >= max(6, 4 * q):
                found.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@st.composite
def texts(draw):
    base = draw(st.lists(st.integers(0, draw(st.sampled_from([0, 1, 3, 40]))), max_size=12))
    around = st.lists(st.integers(0, 50), max_size=9)
    text = draw(around) + base * draw(st.integers(1, 9)) + base[:draw(st.integers(0, 12))] + draw(around)
    text = text * draw(st.integers(1, 2))
    for i in draw(st.lists(st.integers(0, 200), max_size=3)):
        text[i:i + 1] = [7]
    return text


@given(st.lists(texts(), min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_finds_every_run(many):
    sizes = np.array([len(t) for t in many], np.int64)
    got = find_runs(np.array([x for t in many for x in t], np.int64), sizes)
    first = np.cumsum(sizes) - sizes
    want = [(int(f) + s, n, q) for f, t in zip(first, many, strict=True) for s, n, q in every_run(t)]
    assert list(zip(*(v.tolist() for v in got), strict=True)) == want


@given(st.lists(st.integers(0, 60), min_size=1, max_size=50), st.data())
@settings(max_examples=100, deadline=None)
def test_wavelet_matrix(values, data):
    matrix = WaveletMatrix(np.array(values))
    a = data.draw(st.integers(0, len(values) - 1))
    b = data.draw(st.integers(a + 1, len(values)))
    x, rank = data.draw(st.integers(0, max(values))), data.draw(st.integers(0, b - a - 1))
    low, high = np.array([a]), np.array([b])
    assert matrix.below(low, high, np.array([x]))[0] == sum(v < x for v in values[a:b])
    assert matrix.at_rank(low, high, np.array([rank]))[0] == sorted(values[a:b])[rank]


def test_query_equals_brute_force(spark, small_texts):
    got = {r.doc_id: tuple(r) for r in op11_periodic_runs(spark, SMALL).collect()}
    assert len(got) == len(small_texts)
    for doc_id, text in small_texts.items():
        words, h = text.encode().split(), zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = every_run(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        assert got[doc_id] == (
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(collapsed(words, runs)).hexdigest())


def test_edge_cases(spark):
    long = "tic tac " * 300_000 + "toe"
    rows = [(1, "a a a a a a b"), (1, "a a a a a a b"), (2, None), (3, ""), (4, " \n "), (5, long), (None, "x y x y x y x y"),
            (6, "a a a a a a a a a")]
    got = {(r.doc_id, i): r for i, r in enumerate(sorted(
        periodic_runs(frame(spark, rows, CLASHING | {"runs": "x", "start": 1})).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0)))}
    by = {k[0]: r for k, r in got.items()}
    assert len(got) == len(rows)
    assert [tuple(x) for x in by[1].runs] == [(0, 6, 1)] and by[1].collapsed == "a b"
    for empty in (2, 3, 4):
        assert (by[empty].n_words, by[empty].runs, by[empty].collapsed) == (0, [], "")
    assert [tuple(x) for x in by[5].runs] == [(0, 600_000, 2)] and by[5].collapsed == "tic tac toe"
    assert [tuple(x) for x in by[None].runs] == [(0, 8, 2)] and by[None].collapsed == "x y"
    assert by[6].runs == []  # only ASCII white space parts words: five equal ones are too few
    assert periodic_runs(spark.createDataFrame([], DOCS)).collect() == []
