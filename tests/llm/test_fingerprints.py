"""Fingerprints: estimates, merging of parts, the next document over ranges, edge cases (the query itself has SQL)."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import CLASHING, DOCS, frame
from tijara.llm import fingerprints as fp


def plain_hashes(text: str) -> set[str]:
    w = "".join(c.lower() if c.isascii() else c for c in text).encode().split()
    return {hashlib.md5(b" ".join(w[i:i + 5])).hexdigest()[:16] for i in range(max(len(w) - 4, min(len(w), 1)))}


def test_sketches_and_estimates(spark, small_texts):
    rows = sorted(small_texts.items())
    pairs = [(t, rows[i - 1][1] if i % 2 else t[:len(t) // 2]) for i, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(pairs, "x string, y string").select("x", "y", fp.sketch(F.col("x")).alias("a"), fp.sketch(F.col("y")).alias("b"))
    for r in df.select("*", fp.resemblance(F.col("a"), F.col("b")).alias("r"), fp.containment(F.col("b"), F.col("a")).alias("c"),
                       fp.distinct_shingles(F.col("a")).alias("n")).collect():
        x, y = plain_hashes(r.x), plain_hashes(r.y)
        assert r.a == sorted(x)[:fp.K] and r.b == sorted(y)[:fp.K]
        exact = len(x & y) / len(x | y) if x | y else 1.0
        inside = len(x & y) / len(y) if y else 1.0
        if len(x | y) < fp.K:
            assert (r.r, r.c, r.n) == (exact, inside, len(x))
        assert abs(r.r - exact) < 0.2 and abs(r.c - inside) < 0.3 and abs(r.n - len(x)) <= 0.35 * len(x)


def test_parts_merge_to_the_whole(spark, small_docs):
    whole = small_docs.select("doc_id", fp.sketch(F.col("text")).alias("sketch"))
    parts = small_docs.select("doc_id", F.explode(fp.parts_of(F.col("text"), 40)).alias("part")).select(
        "doc_id", fp.sketch(F.col("part")).alias("sketch"))
    assert parts.count() > 2 * whole.count()
    assert dict(fp.merged(parts, ["doc_id"], "sketch").collect()) == dict(whole.collect())
    # of a whole corpus, and two by two
    every = set().union(*(plain_hashes(r.text or "") for r in small_docs.collect()))
    one = fp.merged(whole.withColumn("all", F.lit(1)), ["all"], "sketch").first().sketch
    assert one == sorted(every)[:fp.K]
    a, b = (r.sketch for r in whole.orderBy("doc_id").take(2))
    two = spark.createDataFrame([(a, b)], "a array<string>, b array<string>").select(fp.merge(F.col("a"), F.col("b"))).first()[0]
    assert two == sorted({*a, *b})[:fp.K]


def following(rows):
    """Texts of the next rows by falling doc_id, then rising text."""
    order = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (-r[0], r[1]))
    return sorted((i, t, order[(k + 1) % len(order)][1]) for k, (i, t) in enumerate(order))


@pytest.mark.parametrize("rows", [
    [(1, "alone")],
    [(5, "a"), (5, "a"), (5, "b"), (9, None), (-3, "z")],
    [(7 ** k, f"t{k}") for k in range(20)] + [(k, f"u{k}") for k in range(2, 400)],
    [(3, "x")] * 40 + [(4, "y"), (2, "w")],
], ids=["one", "ties", "uneven", "hot"])
def test_next_document(spark, rows):
    got = fp.with_next(fp.fingerprints(frame(spark, rows, CLASHING)), ["text"])
    assert sorted((r.doc_id, r.text, r.next_text) for r in got.collect()) == following(rows)


def test_edge_cases(spark):
    long = "one two three four five six " * 50_000
    rows = [(1, "Some words, and some more of them."), (1, "Some words, and some more of them."), (2, None), (3, ""), (4, " \n"),
            (5, long), (6, "\U0001F600 é ñ"), (None, "no id")]
    got = {r.doc_id: r for r in fp.fingerprints(frame(spark, rows, CLASHING)).collect()}
    for empty in (2, 3, 4):
        assert (got[empty].fingerprint, got[empty].n_shingles) == ("", 0)
    assert got[5].n_shingles == 6 and got[6].n_shingles == 1
    assert got[6].fingerprint == hashlib.md5("\U0001F600 é ñ".encode()).hexdigest()[:16]
    led = fp.with_next(fp.fingerprints(frame(spark, rows)), ["text", "fingerprint"]).collect()
    assert len(led) == len(rows)
    assert [(r.next_text, r.next_fingerprint) for r in led if r.doc_id is None] == [(None, None)]
    empty = spark.createDataFrame([], DOCS)
    assert fp.with_next(fp.fingerprints(empty), ["text"]).collect() == []
    both = spark.createDataFrame([([], ["a"])], "e array<string>, s array<string>")
    e, s = F.col("e"), F.col("s")
    assert tuple(both.select(fp.resemblance(e, e), fp.resemblance(e, s), fp.containment(e, s), fp.containment(s, e)).first()) == (1, 0, 1, 0)
