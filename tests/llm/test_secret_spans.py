"""Spans of texts with very many matches, arrays' scans, and the battery's p-values against reference formulas."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import frame
from tijara.llm import secret_scan as ss
from tijara.llm.arrays import count_at_most, running


def test_scans_and_searches(spark):
    rng = random.Random(1)
    arrays = [[rng.randrange(50) for _ in range(n)] for n in (0, 1, 2, 3, 7, 8, 9, 64, 65, 1000)]
    df = spark.createDataFrame([(i, a, sorted(a)) for i, a in enumerate(arrays)], "i int, a array<int>, s array<int>")
    for r in df.select("a", "s", running(F.col("a"), lambda x, y: x + y).alias("sums"), running(F.col("a"), F.greatest).alias("tops"),
                       *[count_at_most(F.col("s"), F.lit(k)).alias(f"c{k}") for k in (-1, 0, 20, 49, 99)]).collect():
        assert r.sums == [sum(r.a[:i + 1]) for i in range(len(r.a))]
        assert r.tops == [max(r.a[:i + 1]) for i in range(len(r.a))]
        assert [r[f"c{k}"] for k in (-1, 0, 20, 49, 99)] == [sum(x <= k for x in r.a) for k in (-1, 0, 20, 49, 99)]


def test_spans_equal_a_regular_expression(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["AKIA", "token=", "abcdef0123", "é\U0001F600", " ", "Z9-", "0f" * 14, "\n"]) for _ in range(n))
             for n in (0, 1, 5, 50, 400)]
    df = frame(spark, list(enumerate(texts)))
    for pattern in (ss.ASSIGN, ss.ACCESS, ss.HEX, ss.TOKEN):
        got = {r.doc_id: [tuple(x) for x in r.m] for r in df.select("doc_id", ss.matches(F.col("text"), pattern).alias("m")).collect()}
        assert got == {i: [(m.start(), m.end(), m.group()) for m in re.finditer(pattern, t)] for i, t in enumerate(texts)}


def test_tokens_outside_spans(spark):
    rng = random.Random(3)
    spans = [[(a, a + rng.randrange(1, 30)) for a in (rng.randrange(300) for _ in range(n))] for n in (0, 1, 4, 40)]
    tokens = [[(a, a + rng.randrange(1, 12)) for a in sorted(rng.randrange(300) for _ in range(60))] for _ in spans]
    kind = "array<struct<start:int,end:int>>"
    df = spark.createDataFrame(list(zip(tokens, spans, strict=True)), f"t {kind}, b {kind}")
    for r in df.select("t", "b", ss.outside(F.col("t"), F.col("b")).alias("o")).collect():
        assert r.o == [t for t in r.t if not any(b.start <= t.start and b.end >= t.end for b in r.b)]


def test_very_many_matches_in_one_text(spark):
    """32000 long hex strings and as many tokens in one text of 2 MB: no step per pair of matches."""
    rng = random.Random(4)
    words = [w for _ in range(32_000) for w in (f"{rng.getrandbits(112):028x}", f"Zx{rng.getrandbits(80):020X}q")]
    start = time.time()
    r = ss.secret_scan(frame(spark, [(1, " ".join(words))])).first()
    assert time.time() - start < 60
    assert r.n_hex == 32_000 and r.spans.count("hex:") == 32_000 and r.spans.startswith("hex:0:28,")


def phi(z: float) -> float:
    return math.erfc(z / math.sqrt(2)) / 2


def reference(token: str, alphabet: str) -> tuple[float, float, float]:
    """Chi-squared by Wilson and Hilferty, Wald and Wolfowitz's runs, lag-one correlation: as the textbooks have them."""
    n, a = len(token), len(alphabet)
    x = sum((c - n / a) ** 2 / (n / a) for c in Counter(token).values()) + (a - len(set(token))) * n / a
    k = a - 1
    chi = phi(((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))
    v = [alphabet.index(c) for c in token]
    high = [2 * y > a for y in v]
    n1, n2 = sum(high), n - sum(high)
    runs = 1 + sum(p != q for p, q in zip(high, high[1:], strict=False))
    mu = 2 * n1 * n2 / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    run_p = min(1.0, 2 * phi(abs(runs - mu) / math.sqrt(var))) if var > 0 else 0.0
    m = sum(v) / n
    total = sum((y - m) ** 2 for y in v)
    r = sum((p - m) * (q - m) for p, q in zip(v, v[1:], strict=False)) / total if total else 0.0
    return chi, run_p, min(1.0, 2 * phi(abs((r + 1 / n) * math.sqrt(n)))) if total else 0.0


@pytest.mark.parametrize("alphabet", [a for _, _, a in ss.ENCODINGS])
def test_p_values_equal_the_formulas(spark, alphabet):
    rng = random.Random(5)
    tokens = ["".join(rng.choice(alphabet) for _ in range(n)) for n in (20, 33, 64, 200)]
    tokens += ["".join(sorted(t)) for t in tokens] + [alphabet[0] * 25, (alphabet[1] + alphabet[-1]) * 20]
    size, values = F.lit(len(alphabet)), F.transform(F.split("t", ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    df = spark.createDataFrame([(t,) for t in tokens], "t string").withColumn("v", values)
    for r in df.select("t", ss.chi_squared_p(F.col("t"), size).alias("c"), ss.runs_p(F.col("v"), size).alias("r"),
                       ss.serial_p(F.col("v")).alias("s")).collect():
        assert (r.c, r.r, r.s) == pytest.approx(reference(r.t, alphabet), abs=1e-6)
