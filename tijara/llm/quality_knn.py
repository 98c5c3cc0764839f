"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text's terms are the three-grams of its *shape*: bytes fall into character classes, runs of
letters count once, so that ``THE!!`` and ``thnd***`` differ in terms while languages hardly do.
Added terms say how much of the text repeats (lines, word pairs) and how long its words are. Labelled
documents give a TF-IDF matrix; its right singular vectors are the latent space. Every document
of the table is projected, and exact cosine products with all labelled vectors are computed in
blocks; the nearest ``NEIGHBOURS`` vote with their similarity as weight, each class's votes
balanced by its share of the training rows so that a rare class is not outvoted by its rarity.

Labels are learned from at most ``MAX_TRAIN`` labelled documents, those whose ids have the smallest
hash: the bound on what is collected for the fit and broadcast (vectors of at most
MAX_TRAIN x DIMENSIONS floats and a projection of TERMS x DIMENSIONS, under 2 MB). Each document is
scored by one map over whole texts; nothing is shuffled but the chosen labelled rows.

Defined results: null or empty text: no terms, so the score is a half (nothing speaks for either
class), predicted 1. Without any labelled row every score is a half. A document labelled
more than once counts with the mean of its labels; null labels are ignored. Repeated rows repeat their
score; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.llm.common import crc_remainder, read_documents, release_memory, slices, texts_of, utf8

MAX_TRAIN = 4000
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 8  # votes weigh similarity to this power

# character classes of a byte; letters (a-z, and all bytes of non-ASCII characters) are class 0
_SETS = [b"", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",;:", b"!?", b"|", b"#$%&*@^~",
         b"\"'`()[]{}", b"-_", b"=+<>/\\", b"\t\r\x0b\x0c"]
CLASSES = len(_SETS) + 1  # the last class: other control characters
_CLASS_OF = np.full(256, 0, np.uint8)
_CLASS_OF[:32] = CLASSES - 1
for _k, _set in enumerate(_SETS):
    _CLASS_OF[list(_set)] = _k
GRAMS = CLASSES ** 3
BINS = 10
TERMS = GRAMS + 4 * BINS


def shape_terms(text: bytes) -> np.ndarray:
    """Log-scaled term counts of one text (float32, TERMS long)."""
    out = np.zeros(TERMS, np.float32)
    if not text.strip():
        return out
    cls = _CLASS_OF[np.frombuffer(text, np.uint8)]
    keep = np.ones(len(cls), bool)
    keep[1:] = (cls[1:] != cls[:-1]) | (cls[1:] > 1)  # runs of lower- or upper-case letters count once
    cls = cls[keep].astype(np.int32)
    if len(cls) > 2:
        grams = (cls[:-2] * CLASSES + cls[1:-1]) * CLASSES + cls[2:]
        out[:GRAMS] = np.bincount(grams, minlength=GRAMS)
        np.log1p(out, out=out)
    words = text.split()
    lines = [x for x in text.split(b"\n") if len(x) > 20]
    pairs = len(words) - 1
    shares = (1 - len(set(zip(words, words[1:], strict=False))) / pairs if pairs > 0 else 0.0,
              1 - len(set(lines)) / len(lines) if lines else 0.0,
              1 - len(set(words)) / len(words),
              min(1.0, len(text) / len(words) / 20))
    level = float(np.sqrt((out[:GRAMS] ** 2).sum())) / 2 or 1.0
    for k, share in enumerate(shares):
        out[GRAMS + k * BINS + min(BINS - 1, int(share * BINS))] = level
    return out


def sparse_terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The terms that a text has, and their values."""
    terms = shape_terms(text)
    has = np.flatnonzero(terms).astype(np.uint16)
    return has, terms[has]


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def right_vectors(rows: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """The k leading right singular vectors (columns), by subspace iteration from a fixed start."""
    q = np.random.default_rng(7).standard_normal((rows.shape[1], k + 16)).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(rows.T @ (rows @ q))
    _, _, vt = np.linalg.svd(rows @ q, full_matrices=False)
    return (q @ vt.T)[:, :k].astype(np.float32)


class Model:
    """Latent space, labelled vectors and their votes."""

    def __init__(self, terms: list[tuple[np.ndarray, np.ndarray]], labels: list[float]):
        """``terms``: of each labelled text the terms it has and their values (``sparse_terms``)."""
        full = [k for k, (term, _) in enumerate(terms) if len(term)]
        y = np.asarray(labels, np.float64)[full]
        self.empty = not full
        if self.empty:
            return
        rows = np.zeros((len(full), TERMS), np.float32)  # the one large array; weighted in place
        seen = np.zeros(TERMS, np.int64)
        for row, k in zip(rows, full, strict=True):
            term, value = terms[k]
            row[term] = value
            seen[term] += 1
        self.idf = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
        for row in rows:
            row *= self.idf
            row /= np.linalg.norm(row) or 1.0
        self.space = right_vectors(rows, DIMENSIONS)
        self.vectors = _unit(rows @ self.space)
        # balanced votes: each class weighs a half in all
        ones = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.good = (y * 0.5 / ones).astype(np.float32)
        self.bad = ((1 - y) * 0.5 / (1 - ones)).astype(np.float32)

    def scores(self, texts: list[bytes], block: int = 256) -> np.ndarray:
        out = np.full(len(texts), 0.5)
        if self.empty:
            return out
        for at in range(0, len(texts), block):
            terms = np.stack([shape_terms(t) for t in texts[at:at + block]])
            vectors = _unit(_unit(terms * self.idf) @ self.space)
            cosines = vectors @ self.vectors.T
            k = min(NEIGHBOURS, cosines.shape[1])
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 0) ** SHARPNESS
            good, bad = (weight * self.good[near]).sum(axis=1), (weight * self.bad[near]).sum(axis=1)
            total = good + bad
            known = terms.any(axis=1) & (total > 0)
            out[at:at + block][known] = (good[known] / total[known]).clip(0, 1)
        return out


def fit(docs: DataFrame, labels: DataFrame, learn: Column, max_train: int = MAX_TRAIN) -> Model:
    """Model from labelled documents for which ``learn`` (over doc_id) holds."""
    chosen = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & learn)
              .groupBy("doc_id").agg(F.avg("quality").alias("quality")))
    texts = texts_of(docs)
    # one row per document, then the bound (documents without a label are not counted in it)
    ids = chosen.join(texts.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    one = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(  # max_train ids
        F.min("text").alias("text"), F.first("quality").alias("quality"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [sparse_terms(t) for t in utf8(batch)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "quality": batch.column("quality"),
                "term": pa.array([x.tobytes() for x, _ in found], pa.binary()),
                "value": pa.array([v.tobytes() for _, v in found], pa.binary())})

    # no texts reach the driver: at most max_train x TERMS term counts, however long the texts are
    rows = one.mapInArrow(count, "doc_id bigint, quality double, term binary, value binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    model = Model([(np.frombuffer(r.term, np.uint16), np.frombuffer(r.value, np.float32)) for r in rows], [r.quality for r in rows])
    release_memory()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            s = shared.value.scores(utf8(batch))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(s, pa.float64()),
                                              "predicted": pa.array((s >= 0.5).astype(np.int32), pa.int32())})

    return texts_of(docs).mapInArrow(run, "doc_id bigint, score double, predicted int")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_remainder(doc_id, 3) == 1, F.lit(False))


def _model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out(F.col("doc_id")))


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    return score(docs, _model(spark, docs, sf_dir)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows whose text is predicted 1, with all their columns."""
    shared = spark.sparkContext.broadcast(_model(spark, docs, sf_dir))
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or b"" for t in utf8(batch)]
            yield batch.filter(pa.array(shared.value.scores(texts) >= 0.5))

    return docs.mapInArrow(keep, schema)
