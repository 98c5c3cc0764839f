"""Secret scans with a battery of randomness tests; DataFrame functions only.

Base spans come from three patterns (assignments, access keys, long hex). The method adds spans:
tokens of at least 20 characters whose encoding can be inferred (hex, base32, base36, base64 and its
URL form) and that pass a battery under the hypothesis "drawn uniformly from that alphabet":

* chi-squared uniformity of the symbols, (A / n) * sum(count^2) - n on A - 1 degrees of freedom,
  as a normal deviate by Wilson and Hilferty's cube root;
* Wald and Wolfowitz's runs above and below the alphabet's middle;
* lag-one serial correlation.

The smallest of the three p-values, tripled (Bonferroni: the tests depend on each other), is the
token's p. Benjamini and Hochberg's step-up procedure at rate ``FDR`` runs over all tokens of the
table, apart for each class of length (tokens of 64 to 128 bits, of 128 to 256, and so on: short
tokens give the tests little power, so they must not share a threshold with long ones). Rejected
tokens are structured (identifiers, paths); the others are reported. So of all tokens thrown out, a
share of at most ``FDR`` was random. The procedure runs on a histogram of log p in steps of 0.01,
which is bounded; it rejects at the upper edge of a step, never beyond the exact procedure.

The text is read once; spans and p-values per row are stored, and the thresholds (one per class,
16 at most) come back as literals. No shuffle carries text.

Defined results: null or empty text: no spans. Repeated rows give repeated results and count as
tokens of their own. An empty table gives an empty result. Positions are code points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tijara.llm.arrays import count_at_most, let, running
from tijara.llm.common import read_documents, stored, texts_of

# fixed values: the base patterns
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # equals AKIA[A-Z0-9]+ of 20 or more characters
HEX = r"[0-9a-f]{24,}"  # equals [0-9a-f]+ of 24 or more
TOKEN = r"[A-Za-z0-9+/_-]{20,}"

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: encoding, pattern of its tokens, alphabet; the first that fits is inferred
ENCODINGS = [
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", DIGITS + LOWER),
    ("BASE36", "^[A-Z0-9]+$", DIGITS + UPPER),
    ("base64", "^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
]
FDR = 0.01
MIN_BITS = 64  # below, no test can tell random from not
STEP = 100  # histogram steps per power of ten


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array of (start, end, found), in code points.

    A text splits into the pieces between its matches, so ends are running sums of lengths.
    """
    def spans(found: Column) -> Column:
        pieces = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        lengths = F.zip_with(pieces, found, lambda p, m: F.length(p) + F.length(m))
        return let(running(lengths, lambda a, b: a + b), lambda ends: F.transform(found, lambda m, i: F.struct(
            (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("found"))))

    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(empty))


def outside(tokens: Column, base: Column) -> Column:
    """The ``tokens`` that lie in no span of ``base``: the spans that start no later are looked up, and how far they reach."""
    def kept(starts: Column, reach: Column) -> Column:
        return F.filter(tokens, lambda t: F.coalesce(F.get(reach, count_at_most(starts, t.start) - 1) < t.end, F.lit(True)))

    several = let(F.array_sort(F.transform(base, lambda b: F.struct(b.start.alias("start"), b.end.alias("end")))), lambda by: let(
        F.transform(by, lambda b: b.start), lambda starts: let(
            running(F.transform(by, lambda b: b.end), F.greatest), lambda reach: kept(starts, reach))))
    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), several).otherwise(tokens)


def upper_tail(z: Column) -> Column:
    """P(standard normal > z), by Abramowitz and Stegun's 26.2.17 (error below 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _sum(array: Column, f) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + f(x))


def chi_squared_p(token: Column, size: Column) -> Column:
    """Upper tail of the uniformity statistic over an alphabet of ``size`` symbols."""
    n = F.length(token)
    squares = _sum(F.array_distinct(F.split(token, "")), lambda c: F.pow(n - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
    df = size - 1
    x = F.greatest(size / n * squares - n, F.lit(0.0))
    spread = F.lit(2.0) / (9.0 * df)
    return upper_tail((F.pow(x / df, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread))


def runs_p(values: Column, size: Column) -> Column:
    """Two-sided p of the number of runs above and below the alphabet's middle."""
    n = F.size(values)
    high = F.transform(values, lambda v: (v * 2 > size).cast("int"))
    n1 = _sum(high, lambda h: h)
    n2 = n - n1
    changes = _sum(F.zip_with(F.slice(high, 1, n - 1), F.slice(high, 2, n - 1), lambda a, b: (a != b).cast("int")), lambda c: c)
    mean = 2 * n1 * n2 / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    return F.when(var > 0, F.least(F.lit(1.0), 2 * upper_tail(F.abs(changes + 1 - mean) / F.sqrt(var)))).otherwise(F.lit(0.0))


def serial_p(values: Column) -> Column:
    """Two-sided p of the lag-one serial correlation (mean -1/n, variance about 1/n)."""
    n = F.size(values)
    mean = _sum(values, lambda v: v) / n
    total = _sum(values, lambda v: (v - mean) * (v - mean))
    lagged = _sum(F.zip_with(F.slice(values, 1, n - 1), F.slice(values, 2, n - 1), lambda a, b: (a - mean) * (b - mean)), lambda x: x)
    z = (lagged / total + F.lit(1.0) / n) * F.sqrt(n)
    return F.when(total > 0, F.least(F.lit(1.0), 2 * upper_tail(F.abs(z)))).otherwise(F.lit(0.0))


def battery(tokens: Column) -> Column:
    """Array of (start, end, class, step) of the tokens that can be tested: step is -log10 p * STEP,
    rounded down; tokens without a fitting encoding or with too few bits are left out."""
    def alphabet(token: Column) -> Column:
        out = F.lit(None).cast("string")
        for _, pattern, symbols in reversed(ENCODINGS):
            out = F.when(token.rlike(pattern), F.lit(symbols)).otherwise(out)
        return F.when(token.rlike("[0-9]") & token.rlike("[A-Za-z]"), out)

    known = F.transform(tokens, lambda t: F.struct(t.start.alias("start"), t.end.alias("end"), t.found.alias("found"),
                                                   alphabet(t.found).alias("alphabet")))
    known = F.filter(known, lambda t: F.length(t.found) * F.log2(F.length(t.alphabet)) >= MIN_BITS)
    valued = F.transform(known, lambda t: F.struct(
        t.start.alias("start"), t.end.alias("end"), t.found.alias("found"), F.length(t.alphabet).alias("size"),
        F.transform(F.split(t.found, ""), lambda c: F.instr(t.alphabet, c) - 1).alias("values")))
    tested = F.transform(valued, lambda t: F.struct(
        t.start.alias("start"), t.end.alias("end"),
        F.least(F.floor(F.log2(F.length(t.found) * F.log2(t.size))).cast("int"), F.lit(21)).alias("class"),
        F.least(F.lit(1.0), 3 * F.least(chi_squared_p(t.found, t.size), runs_p(t.values, t.size),
                                        serial_p(t.values))).alias("p")))
    return F.transform(tested, lambda t: F.struct(
        t.start.alias("start"), t.end.alias("end"), t["class"].alias("class"),
        F.floor(-F.log10(F.greatest(t.p, F.lit(1e-16))) * STEP).cast("int").alias("step")))


def thresholds(tested: DataFrame, rate: float) -> dict[int, int]:
    """Class -> step from which its tokens are rejected; ``tested`` has a row (class, step) per token.

    A class is at most 21 and a step at most 16 * STEP, which bounds the histogram that the window
    ranks and the rows that come back (one per class).
    """
    bins = tested.groupBy("class", "step").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("class")
    ranked = bins.withColumn("k", F.sum("n").over(w.orderBy(F.desc("step")))).withColumn("m", F.sum("n").over(w))
    edge = F.pow(F.lit(10.0), -F.col("step") / STEP)  # the largest p of the step
    cut = ranked.where(edge <= rate * F.col("k") / F.col("m")).groupBy("class").agg(F.min("step").alias("step"))
    return {r["class"]: r["step"] for r in cut.collect()}


def _kind(spans: Column, kind: str, rank: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s.start.alias("start"), F.lit(rank).alias("rank"), s.end.alias("end"),
                                                 F.lit(kind).alias("kind")))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def secret_scan(docs: DataFrame, rate: float = FDR) -> DataFrame:
    """Per row: counts of the base spans, the digest of their list, and the list of all spans."""
    text = F.col("text")
    rows = texts_of(docs).select("doc_id", matches(text, ASSIGN).alias("assign"), matches(text, ACCESS).alias("access"),
                                 matches(text, HEX).alias("hex"), matches(text, TOKEN).alias("tokens"))
    rows = rows.withColumn("assign", F.filter("assign", lambda s: F.length(F.regexp_extract(s.found, ASSIGN, 2)) >= 6))
    rows = rows.withColumn("base", F.concat(_kind(F.col("assign"), "assign", 0), _kind(F.col("access"), "access", 1),
                                            _kind(F.col("hex"), "hex", 2)))
    # a token inside a base span would add nothing
    fresh = outside(F.col("tokens"), F.col("base"))
    rows = stored(rows.select(
        "doc_id", F.size("assign").cast("bigint").alias("n_assign"), F.size("access").cast("bigint").alias("n_access"),
        F.size("hex").cast("bigint").alias("n_hex"), "base", battery(fresh).alias("tested")), "spans")

    limits = thresholds(rows.select(F.explode("tested").alias("t")).select("t.class", "t.step"), rate)

    def passes(t: Column) -> Column:
        limit = F.lit(None).cast("int")
        for c, step in sorted(limits.items()):
            limit = F.when(t["class"] == c, F.lit(step)).otherwise(limit)
        return limit.isNull() | (t.step < limit)

    random = _kind(F.filter("tested", passes), "random", 3)
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                       _listed(F.concat("base", random)).alias("spans"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(read_documents(spark, sf_dir))
