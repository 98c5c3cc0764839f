"""Document fingerprints: bottom-k sketches of word shingles, with DataFrame functions only.

A text's shingles are its runs of five words (ASCII white space between them, A-Z lower-cased; all words as
one shingle if they are fewer). Each shingle is hashed to 64 bits of its MD5, written as 16 hexadecimal
digits, so hashes order alike as numbers and as text and any engine can make them. The fingerprint is the ``k``
smallest distinct hashes. Fingerprints merge: the k smallest of two fingerprints' union is the fingerprint of
the union of their shingles, so a text cut into parts (``parts_of``) is fingerprinted part by part, with a
partial merge before the shuffle. Two fingerprints estimate

* resemblance: of the k smallest hashes of the union, the share that both hold;
* containment: of the hashes of one up to the other's largest, the share that the other holds;
* distinct shingles: (k - 1) / the k-th smallest hash as a fraction of the hash range.

Fingerprints of fewer than k hashes hold all shingles, and their estimates are exact.

Defined results: a null text is empty; texts without words have the empty fingerprint. Two empty fingerprints
resemble and contain each other wholly, an empty one is contained in any and resembles none that isn't empty.
Repeated rows are rows of their own. Rows without a doc_id follow no other and are followed by none. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tijara.llm.common import read_documents

K = 128
SHINGLE = 5
DIGITS = 16
RANGES = 8  # ranges of doc_id for each shuffle partition
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz     "


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, UPPER, LOWER), " "), "")


def hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """The shingles' hashes, in order and with repeats."""
    def of(w: Column) -> Column:
        runs = F.transform(w, lambda _, i: F.substring(F.md5(F.concat_ws(" ", *(F.get(w, i + j) for j in range(shingle)))), 1, DIGITS))
        # the last words begin no whole shingle; a text of fewer words is one
        return F.slice(runs, 1, F.greatest(F.size(w) - (shingle - 1), F.least(F.size(w), F.lit(1))))

    return _let(words(text), of)


def smallest(found: Column, k: int = K) -> Column:
    """The sketch of a set of hashes: its ``k`` smallest."""
    return F.slice(F.array_sort(F.array_distinct(found)), 1, k)


def sketch(text: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    return smallest(hashes(text, shingle), k)


def written(hashes_: Column) -> Column:
    """A sketch as one string."""
    return F.array_join(hashes_, "")


def read(fingerprint: Column) -> Column:
    """The sketch of such a string."""
    return F.regexp_extract_all(fingerprint, F.lit(f".{{{DIGITS}}}"), 0)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both sketches' shingles together."""
    return smallest(F.concat(a, b), k)


def merged(sketches: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch for each of ``keys``: of all shingles of its rows' sketches. Each task hands on at most ``k``
    hashes of a key, so a key with a third of all rows is no burden. Keys without any hash get the empty sketch."""
    one = sketches.select(*keys, F.explode_outer(column).alias("hash")).distinct()
    first = Window.partitionBy(*keys).orderBy(F.asc_nulls_last("hash"))
    kept = one.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
    return kept.groupBy(*keys).agg(F.array_sort(F.collect_list("hash")).alias(column))


def parts_of(text: Column, part_words: int, shingle: int = SHINGLE) -> Column:
    """Parts of at most ``part_words`` shingles each, that have every shingle of the text between them."""
    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0)), F.lit(part_words))
        return F.transform(starts, lambda at: F.array_join(F.slice(w, at + 1, part_words + shingle - 1), " "))

    return _let(words(text), cut)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both."""
    def share(both: Column) -> Column:
        common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
        return F.when(F.size(both) == 0, 1.0).otherwise(common / F.greatest(F.size(both), F.lit(1)))

    return _let(merge(a, b, k), share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds too."""
    def share(known: Column) -> Column:
        held = F.size(F.array_intersect(known, b)) / F.greatest(F.size(known), F.lit(1))
        return F.when(F.size(a) == 0, 1.0).otherwise(held)

    # a full sketch of b says nothing of hashes beyond its largest
    return _let(F.when(F.size(b) < k, a).otherwise(F.filter(a, lambda h: h <= F.get(b, F.size(b) - 1))), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    digits = 13  # as many as a double holds exactly
    part = F.conv(F.substring(F.get(a, F.lit(k - 1)), 1, digits), 16, 10).cast("double") / float(16 ** digits)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / part)


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text, fingerprint, n_shingles (estimated) of every row."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    made = texts.withColumn("sketch", sketch(F.col("text"), k, shingle))
    return made.select("doc_id", "text", written(F.col("sketch")).alias("fingerprint"),
                       distinct_shingles(F.col("sketch"), k).alias("n_shingles"))


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` (doc_id, text and ``columns``), each with next_<column> of the row that follows it by falling
    doc_id (rows of one doc_id by rising text); the first row follows the last. Without a doc_id: null.

    The rows are cut into ranges of doc_id, a few for each shuffle partition, and every range also gets the
    first row of the one that follows it, so each text is shuffled once. Only the ranges' limits and first ids
    reach the driver: no more than Spark's own range partitioning collects.
    """
    spark = rows.sparkSession
    named = rows.where("doc_id is not null")
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = named.select("doc_id")
    limits = ids.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
    limits = sorted(set(limits or []))
    steps = F.lit([1 << b for b in reversed(range(len(limits).bit_length()))] or [1])

    def range_of(doc_id: Column) -> Column:
        """How many limits are at most ``doc_id``: a search by halves."""
        if not limits:
            return F.lit(0)
        cuts = _numbers(limits)
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
            (at + step <= len(limits)) & (F.get(cuts, at + step - 1) <= doc_id), at + step).otherwise(at))

    ranged = named.withColumn("range", range_of(F.col("doc_id")))
    heads = {r.range: r.head for r in ids.withColumn("range", range_of(F.col("doc_id"))).groupBy("range").agg(
        F.max("doc_id").alias("head")).collect()}
    falling = sorted(heads, reverse=True)
    before = {b: a for a, b in zip(falling, falling[1:] + falling[:1])}
    size = len(limits) + 1
    is_head = F.col("doc_id") == F.get(_numbers([heads.get(i, 0) for i in range(size)]), F.col("range"))
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(_numbers([before.get(i, 0) for i in range(size)]), F.col("range")).cast("int").alias("range"),
                     F.lit(True).alias("guest"))
    places = F.when(is_head, F.array(own, guest)).otherwise(F.array(own))
    placed = ranged.withColumn("place", F.explode(places)).drop("range").select("*", "place.range", "place.guest").drop("place")
    order = Window.partitionBy("range").orderBy("guest", F.desc("doc_id"), "text")
    led = placed.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns)).where("not guest").drop("range", "guest")
    alone = rows.where("doc_id is null").select("*", *(F.lit(None).cast("string").alias(f"next_{c}") for c in columns))
    return led.unionByName(alone)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(fingerprints(read_documents(spark, sf_dir)), ["text", "fingerprint"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.coalesce(F.substring("next_text", F.lit(1), half), F.lit("")))
    made = rows.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"))).withColumn(
        "own", read(F.col("fingerprint"))).withColumn("following", read(F.col("next_fingerprint")))
    return made.select("doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                       written(F.col("edited_sketch")).alias("edited_fingerprint"),
                       resemblance(F.col("own"), F.col("edited_sketch")).alias("near_edited"),
                       resemblance(F.col("own"), F.col("following")).alias("near_next"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
following AS (
  SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC, t), first_value(t) OVER (ORDER BY doc_id DESC, t)) AS next_t
  FROM docs),
edited AS (
  SELECT doc_id, t, next_t, substr(t, 1, CAST(length(t) - length(t) // 2 AS BIGINT)) || substr(next_t, 1, CAST(length(t) // 2 AS BIGINT)) AS e
  FROM following),
split AS (
  SELECT *, list_transform([t, e, next_t], lambda x: list_filter(regexp_split_to_array(
    translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda y: y <> '')) AS w
  FROM edited),
sketched AS (
  SELECT *, list_transform(w, lambda v: list_sort(list_distinct(list_transform(
    range(1, greatest(len(v) - 3, least(len(v) + 1, 2))), lambda i: substr(md5(array_to_string(v[i:i + 4], ' ')), 1, 16))))[1:128]) AS s
  FROM split),
joined AS (
  SELECT *, list_sort(list_distinct(s[1] || s[2]))[1:128] AS u2, list_sort(list_distinct(s[1] || s[3]))[1:128] AS u3 FROM sketched)
SELECT doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(e) AS edited_sha256, array_to_string(s[1], '') AS fingerprint,
  array_to_string(s[2], '') AS edited_fingerprint,
  CASE WHEN len(u2) = 0 THEN 1.0::DOUBLE
    ELSE len(list_intersect(u2, list_intersect(s[1], s[2])))::DOUBLE / len(u2) END AS near_edited,
  CASE WHEN len(u3) = 0 THEN 1.0::DOUBLE
    ELSE len(list_intersect(u3, list_intersect(s[1], s[3])))::DOUBLE / len(u3) END AS near_next
FROM joined
"""
