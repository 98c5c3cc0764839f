"""Exact dedup: static binary-fuse filters per immutable snapshot, exact buckets, byte checks.

Documents that were taken in before lie in immutable snapshots. Each snapshot's digests are
dealt to shards, and each shard gets a static binary-fuse filter. The incoming batch's
distinct digests meet the filters of their shard:

* a digest that no filter knows is new for sure; duplicates among new ones are grouped within
  the batch;
* a positive is joined with the snapshots' exact buckets (full SHA-256), which drops the
  filter's false positives.

Rows of digests that occur more than once are then grouped by their whole bytes. Two different
texts under one SHA-256 would make the job fail rather than merge them.

Digests are pre-aggregated map-side everywhere, so a text that holds a third of all rows is one
row per task in every shuffle; only the last join (row -> group) meets its rows, and adaptive
execution splits that join.

Defined results: a null text is empty; empty texts are equal; a null doc_id never stays while its
group has another id (``kept`` compares null-safe); rows that repeat a doc_id share the decision.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.llm.common import read_documents, slices, stored, texts_of, utf8

SHARD_KEYS = 1 << 18  # digests per shard, on average


# ---- binary fuse filter (3 segments, 16-bit fingerprints), arrays only ------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser of MurmurHash3 over key + seed."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        h ^= h >> np.uint64(33)
    return h


def _slots(h: np.ndarray, seg_len: int, seg_count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Three slots of each hash, in three neighbouring segments."""
    first = ((h >> np.uint64(32)) * np.uint64(seg_count * seg_len) >> np.uint64(32)).astype(np.int64)
    mask = np.int64(seg_len - 1)
    b = first + seg_len
    c = b + seg_len
    return first, b ^ ((h >> np.uint64(18)).astype(np.int64) & mask), c ^ (h.astype(np.int64) & mask)


def _fingerprints(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)


def fuse_filter(keys: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """(seed, segment length, segment count, table) of a filter that holds every key.

    Peeled in rounds: all slots that hold one key are taken at once, which is sound because
    such a slot belongs to no other key of the round.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    seg_len = 1 << min(18, max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 3)))
    seg_count = max(1, math.ceil(n * factor / seg_len) - 2)
    size = (seg_count + 2) * seg_len
    for seed in range(1, 200):
        h = _mix(keys, seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        slots = np.stack(_slots(h, seg_len, seg_count))
        degree = np.zeros(size, np.int32)
        owner = np.zeros(size, np.int64)  # XOR of the keys' numbers in a slot
        number = np.arange(n, dtype=np.int64)
        for s in slots:
            np.add.at(degree, s, 1)
            np.bitwise_xor.at(owner, s, number)
        rounds, left = [], n
        single = np.flatnonzero(degree == 1)
        while len(single):
            who, at = np.unique(owner[single], return_index=True)
            rounds.append((who, single[at]))
            left -= len(who)
            for s in slots[:, who]:
                np.subtract.at(degree, s, 1)
                np.bitwise_xor.at(owner, s, who)
            near = np.unique(slots[:, who])
            single = near[degree[near] == 1]
        if left:
            seg_count += 1
            size += seg_len
            continue
        table = np.zeros(size, np.uint16)
        prints = _fingerprints(h)
        for who, slot in reversed(rounds):
            a, b, c = slots[:, who]
            table[slot] = prints[who] ^ table[a] ^ table[b] ^ table[c]  # table[slot] is still 0
        return seed, seg_len, seg_count, table
    raise RuntimeError("no binary fuse filter found")


def filter_holds(keys: np.ndarray, seed: int, seg_len: int, seg_count: int, table: np.ndarray) -> np.ndarray:
    h = _mix(keys.astype(np.uint64), seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    a, b, c = _slots(h, seg_len, seg_count)
    return _fingerprints(h) == table[a] ^ table[b] ^ table[c]


# ---- Spark side --------------------------------------------------------------------------------

def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        digests = [hashlib.sha256(t.lower()).digest() for t in utf8(batch)]  # bytes.lower() touches A-Z only
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "sha": pa.array(digests, pa.binary()),
                                          "snapshot": batch.column("snapshot")})


def _digest_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sha, bytes, keep_id, size): equal texts of a slice leave the task as one row."""
    for batch in slices(batches):
        groups: dict[bytes, list] = {}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch), strict=True):
            groups.setdefault(text.lower(), []).append(doc_id)
        known = [[i for i in ids if i is not None] for ids in groups.values()]
        yield pa.RecordBatch.from_pydict({
            "sha": pa.array([hashlib.sha256(t).digest() for t in groups], pa.binary()), "bytes": pa.array(list(groups), pa.binary()),
            "keep_id": pa.array([max(ids, default=None) for ids in known], pa.int64()),
            "size": pa.array(map(len, groups.values()), pa.int64())})


def _key(sha: Column) -> Column:
    """The digest's first 8 bytes as a number: the filter's key."""
    return F.conv(F.hex(F.substring(sha, 1, 8)), 16, -10).cast("bigint")


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    seed, seg_len, seg_count, table = fuse_filter(pdf["key"].to_numpy().view(np.uint64))
    return pd.DataFrame({"snapshot": pdf["snapshot"].iloc[:1].to_numpy(), "shard": pdf["shard"].iloc[:1].to_numpy(),
                         "seed": [seed], "seg_len": [seg_len], "seg_count": [seg_count], "table": [table.tobytes()]})


def _screen(incoming: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    keys = incoming["key"].to_numpy().view(np.uint64)
    hit = np.zeros(len(keys), bool)
    for f in filters.itertuples():
        hit |= filter_holds(keys, f.seed, f.seg_len, f.seg_count, np.frombuffer(f.table, np.uint16))
    return incoming[["sha", "keep_id", "size"]].assign(hit=hit)


def snapshot_filters(rows: DataFrame, shards: int) -> DataFrame:
    """One filter per (snapshot, shard) over the distinct digests of ``rows`` (snapshot, sha)."""
    keys = rows.select("snapshot", "sha").distinct().select("snapshot", _key(F.col("sha")).alias("key"))
    keys = keys.withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    return keys.groupBy("snapshot", "shard").applyInPandas(
        _build, "snapshot int, shard int, seed int, seg_len int, seg_count int, table binary")


def exact_groups(docs: DataFrame, snapshot: Column) -> tuple[DataFrame, DataFrame]:
    """Digest rows (doc_id, sha) and groups (sha, keep_id, size) of equal texts.

    ``snapshot`` (an expression over doc_id and text) numbers the immutable snapshot a row belongs to;
    null marks the incoming batch.
    """
    numbered = texts_of(docs).withColumn("snapshot", snapshot.cast("int"))
    rows = stored(numbered.mapInArrow(_digest_rows, "doc_id bigint, sha binary, snapshot int"), "digests")
    totals = (F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size"))
    known = rows.where("snapshot is not null").groupBy("sha").agg(*totals)
    incoming = stored(rows.where("snapshot is null").groupBy("sha").agg(*totals), "incoming")

    shards = max(1, math.ceil(rows.count() / SHARD_KEYS))
    filters = snapshot_filters(rows.where("snapshot is not null"), shards)
    keyed = incoming.withColumn("key", _key(F.col("sha"))).withColumn("shard", F.pmod("key", F.lit(shards)).cast("int"))
    screened = stored(keyed.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(
        _screen, "sha binary, keep_id bigint, size bigint, hit boolean"), "screened")

    # positives meet the exact buckets; what the filters passed wrongly finds no bucket and stays new
    positives = screened.where("hit").drop("hit")
    merged = known.unionByName(positives).groupBy("sha").agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"))
    groups = stored(merged.unionByName(screened.where("not hit").drop("hit")), "groups")

    # byte check: rows of repeated digests are grouped by their whole bytes
    repeated = texts_of(docs).mapInArrow(_digest_texts, "sha binary, bytes binary, keep_id bigint, size bigint").join(
        groups.where("size > 1").select("sha"), "sha", "left_semi")
    by_bytes = repeated.groupBy("sha", "bytes").agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"))
    checked = by_bytes.groupBy("sha").agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"),
                                          F.count(F.lit(1)).alias("n_texts"))
    checked = checked.select("sha", "keep_id", F.when(F.col("n_texts") > 1, F.raise_error(
        F.lit("two texts under one SHA-256"))).otherwise(F.col("size")).cast("bigint").alias("size"))
    return rows.select("doc_id", "sha"), groups.where("size = 1").unionByName(checked)


def exact_dedup(docs: DataFrame, snapshot: Column) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row (see the module's text)."""
    rows, groups = exact_groups(docs, snapshot)
    return rows.join(groups, "sha").select(
        "doc_id", "keep_id", F.col("size").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def snapshot_of(doc_id: Column) -> Column:
    """The registered query's split: two snapshots of a quarter of the ids each, the rest comes in."""
    part = F.pmod(F.xxhash64(doc_id), F.lit(4))
    return F.when(part < 2, part)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_documents(spark, sf_dir), snapshot_of(F.col("doc_id")))


def stage_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that stay, with all their columns. Rows without a doc_id can't be told
    apart: they all stay if one of them does."""
    kept = exact_dedup(docs, snapshot_of(F.col("doc_id"))).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
      FROM documents)
WINDOW w AS (PARTITION BY norm)
"""
