"""Benchmark decontamination by latent semantic retrieval.

The benchmark's items are cut into passages of at most ``PASSAGE`` words; their words are the
vocabulary. Document frequencies of those words are counted over all documents, words in more
than ``MAX_SHARE`` of them are left out (each passage keeps its rarest ``MIN_KEPT`` whatever they are).
A distributed randomised SVD of the TF-IDF rows (all benchmark passages and the passages of all
documents, either weighing a half) gives the latent space: every task sums its rows' share of the cells of
A'A that are not 0, Spark adds the shares, and subspace iteration multiplies the stored cells, which the block's
vocabulary bounds. They are stored by rows, so that a task's share of the product is its own rows alone.

Then every document's overlapping windows (of ``PASSAGE`` words, half overlapping, over the whole text)
are projected, and exact cosines with all benchmark passages are computed in blocks. Windows at
``COSINE`` or more are candidates. A candidate is checked on the words themselves: the longest common
subsequence with the passage inside a stretch of about the passage's length, and whether the item's
answer (its last words) stands there. A document leaks an item if the subsequence covers ``VERBATIM`` of a
passage, or ``PARAPHRASE`` of it and the answer stands in the stretch, or if ``EXCERPT`` words of it stand within
a quarter more words of the document. Any 50 words in a row of an item hold that many words of one passage.

Benchmarks are taken in blocks of about ``BLOCK`` items, which bounds vocabulary, projection and
vectors of a broadcast (about 50 MB at most); documents are never shuffled, and nothing of theirs but counts
of the vocabulary reaches the driver.

Defined results: null or empty texts and items match nothing; an item of fewer than ``SHORTEST`` words
matches nothing (its words say too little). Equal items give a row each; repeated rows give repeated
rows. Empty tables give an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.llm.common import read_documents, slices, stored, texts_of, utf8
from tijara.llm.license_scan import WORD_BYTES

PASSAGE = 64
MAX_SHARE = 0.05
MIN_KEPT = 6
DIMENSIONS = 256
BLOCK = 1000
COSINE = 0.4
VERBATIM, PARAPHRASE = 0.8, 0.55
EXCERPT = 40  # words of a passage that leak when they stand close together, whatever its length
SHORTEST = 8
PAIRS = 1 << 20  # products of terms held at once, besides their sums
HEIGHT = 64  # terms whose cells lie together
ANSWER_WORDS = 5

SCHEMA = ("doc_id bigint, item_id bigint, cosine double, lcs_share double, answer_found boolean, "
          "first_word bigint, end_word bigint")


def words_of(text: bytes) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z lower-cased."""
    return text.translate(WORD_BYTES).split()


def longest_common(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence with a passage of ``size`` words, whose word
    positions ``masks`` holds as bits: one addition per word."""
    full = (1 << size) - 1
    row = full
    for w in words:
        m = masks.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return size - row.bit_count()


class Passage:
    """A stretch of a benchmark item with what its check needs."""

    def __init__(self, item_id: int, words: list[bytes], answer: list[bytes]):
        self.item_id, self.words = item_id, words
        self.answer = b" " + b" ".join(answer) + b" "
        self.masks: dict[bytes, int] = {}
        for i, w in enumerate(words):
            self.masks[w] = self.masks.get(w, 0) | 1 << i
        self.count = {w: m.bit_count() for w, m in self.masks.items()}
        self.stretch = len(words) + len(words) // 4 + 2

    def check(self, words: list[bytes], begin: int, end: int, seen: set) -> tuple[float, bool, int, int]:
        """Best (share, answer found, first word, end word) of stretches that begin in [begin, end)."""
        best = (0.0, False, begin, begin)
        # no subsequence can be longer than what of the passage occurs there at all
        there = self.count.keys() & set(words[begin:end + self.stretch])
        if sum(map(self.count.__getitem__, there)) < PARAPHRASE * len(self.words):
            return best
        size, step = len(self.words), max(1, len(self.words) // 6)
        for at in range(begin - begin % step, end, step):
            if at in seen:
                continue
            seen.add(at)
            part = words[at:at + self.stretch]
            share = longest_common(self.masks, size, part) / size
            if share >= PARAPHRASE and share > best[0]:
                around = b" " + b" ".join(words[max(0, at - ANSWER_WORDS):at + self.stretch + ANSWER_WORDS]) + b" "
                best = (share, self.answer in around, at, at + len(part))
        return best

    def excerpt(self, words: list[bytes], begin: int, end: int) -> tuple[int, int] | None:
        """(first word, end word) of a stretch from [begin, end) that holds EXCERPT words of the passage close together."""
        long = EXCERPT + EXCERPT // 4
        for at in range(begin, end, 5):
            part = words[at:at + long]
            if len(part) >= EXCERPT and longest_common(self.masks, len(self.words), part) >= EXCERPT:
                return at, at + len(part)
        return None


def passages_of(items: list[tuple[int, str | None]]) -> list[Passage]:
    out = []
    for item_id, text in items:
        words = words_of((text or "").encode())
        if len(words) < SHORTEST:
            continue
        starts = range(0, max(1, len(words) - PASSAGE // 2), PASSAGE // 2)
        out += [Passage(item_id, words[s:s + PASSAGE], words[-ANSWER_WORDS:]) for s in starts]
    return out


class Vocabulary(dict):
    """Number of each benchmark word."""

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """-1 for any other word."""
        return np.fromiter(map(self.get, words, itertools.repeat(-1)), np.int32, len(words))


def half_windows(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' word numbers as (term, half) of known words and each text's first half.

    A half is PASSAGE / 2 words; window h of a text is its halves h and h + 1.
    """
    half = PASSAGE // 2
    count = np.array([-(-len(x) // half) for x in numbers], np.int64)
    first = np.cumsum(count) - count
    terms, halves = [], []
    for x, f in zip(numbers, first, strict=True):
        at = np.flatnonzero(x >= 0)
        terms.append(x[at])
        halves.append(at // half + f)
    return np.concatenate(terms), np.concatenate(halves), np.append(first, count.sum())


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


# ---- corpus statistics and the latent space -----------------------------------------------------------

def document_frequencies(texts: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """In how many documents each word of the vocabulary stands, and how many documents there are."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value) + 1, np.int64)
        known = shared.value.keys()
        for batch in slices(batches):
            for t in utf8(batch):
                for w in known & set(words_of(t)):
                    total[shared.value[w]] += 1
                total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    out = np.zeros(len(vocabulary) + 1, np.int64)
    for r in texts.select("text").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n  # one row per word of the block's vocabulary
    return out[:-1], int(out[-1])


def _weights(passages: list[Passage], vocabulary: Vocabulary, df: np.ndarray, n: int) -> np.ndarray:
    """Inverse document frequencies; 0 for words that are too common and no passage's rarest."""
    idf = (np.log((1 + n) / (1 + df)) + 0.1).astype(np.float32)
    keep = df <= MAX_SHARE * n
    for p in passages:
        terms = vocabulary.numbers(list(p.masks))
        keep[terms[np.argsort(df[terms], kind="stable")[:MIN_KEPT]]] = True
    return np.where(keep, idf, 0).astype(np.float32)


def passage_rows(texts: DataFrame, vocabulary: Vocabulary, idf: np.ndarray) -> DataFrame:
    """Windows with words of the vocabulary, of all documents, as arrays of the numbers of words with a weight."""
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, idf > 0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, weighs = shared.value
        for batch in slices(batches):
            terms, sizes = [np.zeros(0, np.int32)], []
            for t in utf8(batch):
                x = known.numbers(words_of(t))
                at = np.flatnonzero(x >= 0)
                own = at[weighs[x[at]]]
                terms.append(x[own])
                passages = np.unique(at // PASSAGE)
                sizes.append(np.bincount(own // PASSAGE, minlength=int(passages.max(initial=0)) + 1)[passages])
            sizes = np.concatenate(sizes)
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(terms))),
                                              pa.array(np.zeros(len(sizes), bool))], names=["terms", "own"])

    return texts.select("text").mapInArrow(rows, "terms array<int>, own boolean")


def _tf_idf(size: np.ndarray, term: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit TF-IDF rows (of ``size`` terms each) as (row, term, weight), without zero weights; rows ascend."""
    row = np.repeat(np.arange(len(size)), size)
    weight = idf[term]
    norm = np.sqrt(np.bincount(row, weight.astype(np.float64) ** 2, minlength=len(size)))
    ok = weight > 0
    return row[ok], term[ok], (weight[ok] / norm[row[ok]]).astype(np.float32)


def row_sums(space: np.ndarray, term: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``space``'s rows ``term`` over stretches that begin at ``starts``, each added up from its first row on."""
    size = np.diff(np.append(starts, len(term)))
    order = np.argsort(-size, kind="stable")  # those with a k-th row lie in front
    starts, size = starts[order], size[order]
    total = space[term[starts]]
    for k in range(1, int(size.max(initial=0))):
        n = int(np.searchsorted(-size, -k, "left"))  # of more than k rows
        total[:n] += space[term[starts[:n] + k]]
    out = np.empty_like(total)
    out[order] = total
    return out


def _cell_sums(cells: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells, ascending, with the sums of their weights."""
    order = np.argsort(cells, kind="stable")
    cells, weights = cells[order], weights[order]
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[:len(cells)])
    return cells[starts], np.add.reduceat(weights, starts) if len(starts) else weights


def gram(rows: DataFrame, idf: np.ndarray, own_weight: float) -> DataFrame:
    """(first, second, weight): the cells of A'A, first <= second, of the stored rows' TF-IDF matrix A.

    A row adds the products of its terms' weights. Tasks add up their rows' cells, Spark those of all tasks; what remains is bounded by
    the block's vocabulary, however many documents there are.
    """
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast(idf)
    width = len(idf)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(cells: np.ndarray, weights: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(cells), PAIRS):
                c = cells[at:at + PAIRS]
                yield pa.RecordBatch.from_pydict({"first": pa.array(c // width, pa.int32()), "second": pa.array(c % width, pa.int32()),
                                                  "weight": pa.array(weights[at:at + PAIRS], pa.float64())})

        held = [(np.zeros(0, np.int64), np.zeros(0))]
        waiting = 0
        for batch in batches:
            ends = np.asarray(batch.column("terms").offsets)
            row, term, w = _tf_idf(np.diff(ends), np.asarray(batch.column("terms").values)[ends[0]:ends[-1]], shared.value)
            factor = np.where(np.asarray(batch.column("own").to_pylist(), bool), own_weight, 1)
            # a term once a row, ascending: the row's cells are the pairs of a term and one from there on
            own, w = _cell_sums(row * width + term, w.astype(np.float64))
            row, term = own // width, own % width
            after = np.searchsorted(row, row, "right") - np.arange(len(row))
            for at in range(0, len(row), PAIRS // PASSAGE):  # a row has at most PASSAGE terms
                n = after[at:at + PAIRS // PASSAGE]
                i = np.repeat(np.arange(at, at + len(n)), n)
                j = i + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
                held.append((term[i] * width + term[j], w[i] * w[j] * factor[row[i]]))
                waiting += len(i)
                if waiting > max(PAIRS, len(held[0][0])):
                    held = [_cell_sums(*map(np.concatenate, zip(*held, strict=True)))]
                    waiting = 0
                    if len(held[0][0]) > 4 * PAIRS:
                        yield from handed(*held[0])
                        held = [(np.zeros(0, np.int64), np.zeros(0))]
        yield from handed(*_cell_sums(*map(np.concatenate, zip(*held, strict=True))))

    return rows.mapInArrow(part, "first int, second int, weight double").groupBy("first", "second").agg(F.sum("weight").alias("weight"))


def by_rows(cells: DataFrame) -> DataFrame:
    """(at, by, weight): the cells on both sides of the diagonal, those of a block of HEIGHT rows together.

    A block holds at most HEIGHT cells per word of the vocabulary, so none outgrows a task.
    """
    pair = F.struct(F.col("first").alias("at"), F.col("second").alias("by"))
    turned = F.struct(F.col("second").alias("at"), F.col("first").alias("by"))
    both = F.when(F.col("first") == F.col("second"), F.array(pair)).otherwise(F.array(pair, turned))
    return cells.select(F.explode(both).alias("cell"), "weight").select("cell.at", "cell.by", "weight").repartition(
        F.floor(F.col("at") / HEIGHT)).sortWithinPartitions("at", "by")


def row_parts(cells: DataFrame, q: np.ndarray) -> DataFrame:
    """(block, part): shares of A'A q, a block of HEIGHT rows each, from the cells as ``by_rows`` deals them.

    A task hands on the blocks that it has cells of: about as much as q in all, whatever the number of tasks.
    """
    shared = cells.sparkSession.sparkContext.broadcast(q)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = shared.value
        total, has = np.zeros_like(base), np.zeros(-(-len(base) // HEIGHT), bool)
        for batch in batches:
            at, by, w = (np.asarray(batch.column(c)) for c in ("at", "by", "weight"))
            order = np.argsort(at, kind="stable")
            has[at // HEIGHT] = True
            for k in range(0, len(order), 512):  # stays in a core's cache
                own = order[k:k + 512]
                x = at[own]
                first = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
                total[x[first]] += np.add.reduceat(w[own, None].astype(np.float32) * base[by[own]], first, axis=0)
        blocks = np.flatnonzero(has)
        yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()),
                                          "part": pa.array([total[b * HEIGHT:(b + 1) * HEIGHT].tobytes() for b in blocks], pa.binary())})

    return cells.mapInArrow(part, "block bigint, part binary")


def _cells_product(cells: DataFrame, q: np.ndarray) -> np.ndarray:
    """A'A q from the cells of A'A: summed per task, then per block of rows by Spark."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(p, np.float32).astype(np.float64) for p in pdf["part"])
        return pd.DataFrame({"block": pdf["block"].iloc[:1].to_numpy(), "part": [total.astype(np.float32).tobytes()]})

    out = np.zeros_like(q)
    summed = row_parts(cells, q).groupBy("block").applyInPandas(add, "block bigint, part binary")
    for r in summed.collect():  # as large as q
        piece = np.frombuffer(r.part, np.float32).reshape(-1, q.shape[1])
        out[r.block * HEIGHT:r.block * HEIGHT + len(piece)] = piece
    return out


def _product(rows: DataFrame, idf: np.ndarray, own_weight: float, q: np.ndarray) -> np.ndarray:
    """A'(A q) over all stored rows."""
    return _cells_product(by_rows(gram(rows, idf, own_weight)), q)


def latent_space(rows: DataFrame, idf: np.ndarray, dimensions: int = DIMENSIONS, rounds: int = 3) -> np.ndarray:
    """Leading right singular vectors (terms x dimensions) of the stored rows' TF-IDF matrix."""
    width = min(dimensions + 16, len(idf))
    counts = {r.own: r["count"] for r in rows.groupBy("own").count().collect()}
    own_weight = max(1.0, counts.get(False, 0) / max(1, counts.get(True, 0)))
    cells = stored(by_rows(gram(rows, idf, own_weight)), "cells")
    q, _ = np.linalg.qr(np.random.default_rng(5).standard_normal((len(idf), width)))
    for _ in range(rounds):
        before = q.astype(np.float32)
        z = _cells_product(cells, before)
        q, _ = np.linalg.qr(z.astype(np.float64))
    values, turn = np.linalg.eigh(before.T.astype(np.float64) @ z)
    lead = turn[:, np.argsort(-values)[:dimensions]]
    return (before @ lead).astype(np.float32)


# ---- search -----------------------------------------------------------------------------------------

class Index:
    """What a task needs to search: vocabulary, weighted latent space, passages and their vectors."""

    def __init__(self, passages: list[Passage], vocabulary: Vocabulary, idf: np.ndarray, space: np.ndarray):
        self.passages, self.space = passages, space * idf[:, None]
        number = Vocabulary({w: i for w, i in vocabulary.items() if idf[i] > 0})
        self.vocabulary = number
        vectors = np.zeros((len(passages), space.shape[1]), np.float32)
        for k, p in enumerate(passages):
            x = number.numbers(p.words)
            vectors[k] = self.space[x[x >= 0]].sum(axis=0)
        self.vectors = unit(vectors)

    def candidates(self, numbers: list[np.ndarray]) -> list[tuple[int, int, int, float]]:
        """(text, window's first word, passage, cosine) at COSINE or more."""
        term, half, first = half_windows(numbers)
        if not len(term):
            return []
        halves = np.zeros((int(first[-1]) + 1, self.space.shape[1]), np.float32)
        starts = np.flatnonzero(np.append(True, half[1:] != half[:-1]))
        for at in range(0, len(starts), 8192):  # bounded gathers
            s = starts[at:at + 8192]
            stop = starts[at + 8192] if at + 8192 < len(starts) else len(term)
            halves[half[s]] = row_sums(self.space, term[:stop], s)
        whose = np.repeat(np.arange(len(numbers)), np.diff(first))
        window = halves[:-1]
        window[:-1] += halves[1:-1] * (whose[1:] == whose[:-1])[:, None]
        window = unit(window)
        out = []
        for at in range(0, len(window), 4096):
            cosine = window[at:at + 4096] @ self.vectors.T
            w, p = np.nonzero(cosine >= COSINE)
            for a, b in zip(w.tolist(), p.tolist(), strict=True):
                text = int(whose[at + a])
                out.append((text, int(at + a - first[text]) * (PASSAGE // 2), b, float(cosine[a, b])))
        return out

    def search(self, texts: list[bytes]) -> list[tuple]:
        """(text, item, cosine, share, answer found, first word, end word) of each leak, best place."""
        words = [words_of(t) for t in texts]
        found: dict[tuple[int, int], tuple] = {}
        seen: dict[tuple[int, int], set] = {}
        for text, begin, p, cosine in self.candidates([self.vocabulary.numbers(w) for w in words]):
            passage = self.passages[p]
            low, high = max(0, begin - PASSAGE // 2), min(len(words[text]), begin + PASSAGE)
            share, answer, first, end = passage.check(words[text], low, high, seen.setdefault((text, p), set()))
            leak = share >= VERBATIM or (share >= PARAPHRASE and answer)
            if not leak and share >= PARAPHRASE and share * len(passage.words) > EXCERPT - 0.5:
                if (at := passage.excerpt(words[text], low, high)) is not None:
                    leak, (first, end) = True, at
            if leak:
                key = (text, passage.item_id)
                if key not in found or found[key][3] < share:
                    found[key] = (text, passage.item_id, cosine, share, answer, first, end)
        return list(found.values())


def _leaks_of_block(texts: DataFrame, items: list[tuple[int, str | None]]) -> DataFrame | None:
    passages = passages_of(items)
    if not passages:
        return None
    vocabulary = Vocabulary({w: i for i, w in enumerate(sorted({w for p in passages for w in p.words}))})
    df, n = document_frequencies(texts, vocabulary)
    if not n:
        return None
    idf = _weights(passages, vocabulary, df, n)
    spark = texts.sparkSession
    own = spark.createDataFrame([(vocabulary.numbers(p.words).tolist(), True) for p in passages], "terms array<int>, own boolean")
    rows = stored(passage_rows(texts, vocabulary, idf).unionByName(own), "passages")
    shared = spark.sparkContext.broadcast(Index(passages, vocabulary, idf, latent_space(rows, idf)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            hits = shared.value.search(utf8(batch))
            columns = list(zip(*hits, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[t] for t in columns[0]], pa.int64()),
                 *(pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.float64(), pa.float64(), pa.bool_(), pa.int64(),
                                                                 pa.int64()), strict=True))],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

    return texts.mapInArrow(run, SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each (document, item) that leaks."""
    spark, texts = docs.sparkSession, texts_of(docs)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    blocks = max(1, -(-items.count() // BLOCK))
    out = spark.createDataFrame([], SCHEMA)
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        found = _leaks_of_block(texts, sorted(((r.item_id, r.text) for r in block), key=repr))
        out = out if found is None else out.unionByName(found)
    return out


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def stage_decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that leak no item, with all their columns."""
    found = stored(leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "leaks")
    leaking = found.select(F.col("doc_id").alias("leak_id")).distinct()
    return docs.join(leaking, docs["doc_id"].eqNullSafe(leaking["leak_id"]), "left_anti")
