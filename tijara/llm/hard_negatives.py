"""Hard negatives: for each anchor and each of its nearest same-label rows, the best rows of other labels
whose score lies in a window below the positive's.

Scores are integer inner products of quantised vectors. Anchors are dealt into groups of bounded size, and
each group gets its minimum spanning tree. A tree's root is scored against every candidate row; from there

    score(parent, c) - |parent - child| |c|  <=  score(child, c)  <=  score(parent, c) + |parent - child| |c|

(Cauchy-Schwarz) bounds every child's scores, and only candidates whose interval overlaps what is looked for
are scored again: first the positives (from the fifth best score so far upwards), then the negatives
(each positive's window, from its third best score so far upwards). An interval that was not scored again
is handed down, widened by the next edge. Nothing is approximate: a bound never excludes a possible result.

Candidates stay where they are, in blocks; a pass broadcasts at most ``GROUPS`` groups of about ``GROUP``
anchors, so memory is bounded and the number of passes grows with the anchors. Tasks hand on a few rows per
anchor, which Spark merges, so a label or a vector with a third of all rows adds no more than another.

Defined results: rows without an id, label or vector, or with a null or non-finite component, take no part.
Of rows that share an id, the one with the smallest label, then vector, takes part. A shorter vector is
filled up with zeros. Equal scores go by the smaller id. Anchors without positives or without negatives in
the window give no rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tijara.llm.common import prepare, stored

GROUP = 1024  # anchors of a tree, on average
GROUPS = 8  # trees of a pass
BLOCK = 4096  # candidate rows scored at once
EXACT = 1 << 53  # whole numbers below this are exact in float64


def quantised(df: DataFrame, vec_id: str, label: Column, vector: str, scale: int) -> DataFrame:
    """(vec_id, label, q): one row per id, components floor(scale * x), rows that can't be scored left out."""
    x = F.col(vector)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(math.inf)))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    rows = df.where(F.col(vec_id).isNotNull() & label.isNotNull() & x.isNotNull() & whole).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.struct(label.cast("int").alias("label"), q.alias("q")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q")


def _matrix(vectors: list, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers; float64 as long as every inner product with it stays exact."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _exact(m: np.ndarray, largest: int) -> np.ndarray:
    return m.astype(np.float64) if m.shape[1] * largest * largest < EXACT else m


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge) of the minimum spanning tree of ``points`` from its first one.

    ``order`` visits a parent before its children and large subtrees last, so that few parents are open at once.
    """
    n = len(points)
    x = points.astype(np.float64)
    parent, edge = np.full(n, -1), np.zeros(n)
    best, source, out = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    at, taken = 0, [0]
    out[0] = False
    for _ in range(n - 1):
        near = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = out & (near < best)
        best[closer], source[closer] = near[closer], at
        at = int(np.argmin(np.where(out, best, np.inf)))
        parent[at], edge[at], out[at] = source[at], best[at], False
        taken.append(at)
    size = np.ones(n, np.int64)
    children: list[list[int]] = [[] for _ in range(n)]
    for i in reversed(taken[1:]):
        size[parent[i]] += size[i]
        children[parent[i]].append(i)
    order, stack = [], [0] if n else []
    while stack:
        i = stack.pop()
        order.append(i)
        stack.extend(sorted(children[i], key=lambda c: -size[c]))
    return np.array(order, np.int64), parent, edge


class Tree:
    """A group of anchors, and what is scored of a block of candidates along their spanning tree."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, largest: int):
        self.ids, self.labels, self.vectors = ids, labels, _exact(vectors, largest)
        self.order, self.parent, self.edge = spanning_tree(vectors)
        self.last = np.full(len(ids), -1)  # the child after which a parent's bounds are not needed
        for i in self.order[1:]:
            self.last[self.parent[i]] = i

    def walk(self, block: np.ndarray, norms: np.ndarray,
             wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, scores) of the block's rows whose bounds ``wanted`` asks for, for each anchor."""
        open_: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i in self.order.tolist():
            up = int(self.parent[i])
            if up < 0:
                rows = np.arange(len(block))
                low = high = (block @ self.vectors[i]).astype(np.float64)
            else:
                slack = norms * self.edge[i] * (1 + 1e-9) + 0.5
                low, high = open_[up][0] - slack, open_[up][1] + slack
                rows = np.flatnonzero(wanted(i, low, high))
                low[rows] = high[rows] = (block[rows] if len(rows) < len(block) else block) @ self.vectors[i]
                if self.last[up] == i:
                    del open_[up]
            if self.last[i] >= 0:
                open_[i] = low, high
            yield i, rows, low[rows]


def _best(ids: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` first by falling score, then rising id."""
    if len(ids) > 64:
        kept = np.flatnonzero(scores >= -np.partition(-scores, n - 1)[n - 1])
        return kept[np.lexsort((ids[kept], -scores[kept]))[:n]]
    return np.lexsort((ids, -scores))[:n]


class _Kept:
    """The best (score, id) so far for each of several slots of every anchor."""

    def __init__(self, slots: int, n: int):
        self.n, self.found = n, [(np.empty(0, np.int64), np.empty(0)) for _ in range(slots)]
        self.least = np.full(slots, -np.inf)  # what a further row must reach

    def add(self, slot: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids):
            ids = np.concatenate([self.found[slot][0], ids])
            scores = np.concatenate([self.found[slot][1], scores])
            at = _best(ids, scores, self.n)
            self.found[slot] = ids[at], scores[at]
            if len(at) == self.n:
                self.least[slot] = scores[at[-1]]


def _blocks(batches: Iterator[pa.RecordBatch], width: int, largest: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            block = _exact(_matrix(part.column("q").to_pylist(), width), largest)
            yield (part.column("vec_id").to_numpy(), part.column("label").to_numpy(), block,
                   np.sqrt((block.astype(np.float64) ** 2).sum(axis=1)))


def _positives(batches: Iterator[pa.RecordBatch], trees: list[Tree], width: int, largest: int, n: int) -> Iterator[pa.RecordBatch]:
    kept = [_Kept(len(t.ids), n) for t in trees]
    for ids, labels, block, norms in _blocks(batches, width, largest):
        of_label = {x: labels == x for x in np.unique(labels).tolist()}
        none = np.zeros(len(ids), bool)
        for tree, best in zip(trees, kept, strict=True):
            same = [of_label.get(x, none) for x in tree.labels.tolist()]
            for i, rows, scores in tree.walk(block, norms, lambda i, low, high: same[i] & (high >= best.least[i])):
                at = rows[same[i][rows] & (scores >= best.least[i]) & (ids[rows] != tree.ids[i])]
                if len(at):
                    best.add(i, ids[at], scores[np.searchsorted(rows, at)])
    found = [(a, i, int(s)) for tree, best in zip(trees, kept, strict=True)
             for a, (x, y) in zip(tree.ids.tolist(), best.found, strict=True) for i, s in zip(x.tolist(), y.tolist(), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(3)],
                                     ["anchor_id", "positive_id", "positive_score"])


def _negatives(batches: Iterator[pa.RecordBatch], trees: list[Tree], positives: dict[int, list[tuple[int, int]]], width: int,
               largest: int, n: int, low_percent: int, high_percent: int) -> Iterator[pa.RecordBatch]:
    # the slots of each anchor: its positives' windows, as (low, high)
    plan = []
    for tree in trees:
        slots = [positives.get(a, []) for a in tree.ids.tolist()]
        first = np.concatenate([[0], np.cumsum([len(s) for s in slots])]).astype(np.int64)
        scores = np.array([s for x in slots for _, s in x], np.float64)
        lows, highs = np.ceil(low_percent * scores / 100 - 1e-6), np.floor(high_percent * scores / 100 + 1e-6)
        plan.append((slots, first, lows, highs, _Kept(len(scores), n)))
    for ids, labels, block, norms in _blocks(batches, width, largest):
        of_label = {x: labels != x for x in np.unique(labels).tolist()}
        every = np.ones(len(ids), bool)
        for tree, (slots, first, lows, highs, best) in zip(trees, plan, strict=True):
            other = [of_label.get(x, every) for x in tree.labels.tolist()]

            def wanted(i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                hit = np.zeros(len(ids), bool)
                for s in range(first[i], first[i + 1]):
                    hit |= (high >= max(lows[s], best.least[s])) & (low <= highs[s])
                return hit & other[i]

            for i, rows, scores in tree.walk(block, norms, wanted):
                keep = other[i][rows]
                rows, scores = rows[keep], scores[keep]
                for s, (_, positive) in zip(range(first[i], first[i + 1]), slots[i], strict=True):
                    near = np.flatnonzero((scores >= max(lows[s], best.least[s])) & (scores <= highs[s]))
                    whole = scores[near].astype(np.int64)
                    near = near[(100 * whole >= low_percent * positive) & (100 * whole <= high_percent * positive)]
                    best.add(s, ids[rows[near]], scores[near])
    found = []
    for tree, (slots, first, _, _, best) in zip(trees, plan, strict=True):
        for i, a in enumerate(tree.ids.tolist()):
            for s, (p, positive) in zip(range(first[i], first[i + 1]), slots[i], strict=True):
                found += [(a, p, positive, x, int(y)) for x, y in zip(*(v.tolist() for v in best.found[s]), strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(5)],
                                     ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
                   low_percent: int = 50, high_percent: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: (vec_id, label, q) as ``quantised`` gives them; ``is_anchor``: which of them are anchors. A negative's
    score lies between ``low_percent`` and ``high_percent`` of the positive's. Scores must fit 64 bits.
    """
    spark = rows.sparkSession
    prepare(spark)
    rows = stored(rows, "vectors")
    anchors = rows.where(is_anchor)
    shape = rows.agg(F.max(F.size("q")).alias("width"), F.max(F.array_max(F.transform("q", F.abs))).alias("largest")).first()
    width, largest = shape.width or 0, shape.largest or 0
    groups = -(-anchors.count() // GROUP)
    anchors = stored(anchors.withColumn("tree", F.pmod(F.xxhash64("vec_id"), F.lit(max(1, groups)))), "anchors")

    def trees(first: int) -> list[Tree]:
        """The trees of a pass; their anchors are what it collects and broadcasts."""
        own: dict[int, list] = {}
        for r in anchors.where(F.col("tree").between(first, first + GROUPS - 1)).orderBy("tree", "vec_id").collect():
            own.setdefault(r.tree, []).append(r)
        return [Tree(np.array([r.vec_id for r in g], np.int64), np.array([r.label for r in g], np.int64),
                     _matrix([r.q for r in g], width), largest) for g in own.values()]

    def top(found: DataFrame, keys: list[str], by: str, n: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc(f"{by}_score"), f"{by}_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    schema = "anchor_id bigint, positive_id bigint, positive_score bigint"
    parts = []
    for first in range(0, groups, GROUPS):
        sent = spark.sparkContext.broadcast(trees(first))
        best = stored(top(rows.mapInArrow(lambda it, sent=sent: _positives(it, sent.value, width, largest, positives), schema),
                          ["anchor_id"], "positive", positives), "positives")
        own: dict[int, list[tuple[int, int]]] = {}
        for r in best.collect():  # a few for each anchor of this pass
            own.setdefault(r.anchor_id, []).append((r.positive_id, r.positive_score))
        own_sent = spark.sparkContext.broadcast(own)
        found = rows.mapInArrow(
            lambda it, sent=sent, own_sent=own_sent: _negatives(it, sent.value, own_sent.value, width, largest, negatives,
                                                                low_percent, high_percent),
            f"{schema}, negative_id bigint, negative_score bigint")
        parts.append(stored(top(found, ["anchor_id", "positive_id"], "negative", negatives), "negatives"))
        own_sent.unpersist()
        sent.unpersist()
    if not parts:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, "
                                         "positive_score bigint, negative_score bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(quantised(vectors, "vec_id", label, "embedding", 256), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH usable AS (
  SELECT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT id, label, q FROM usable QUALIFY row_number() OVER (PARTITION BY id ORDER BY label, q) = 1),
scored AS (
  SELECT a.id AS anchor_id, b.id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a, v b WHERE a.id % 50 = 0 AND a.id <> b.id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS r
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE r <= 3
"""
