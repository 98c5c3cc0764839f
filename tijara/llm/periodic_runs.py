"""Periodic runs of words, by internal pattern matching, and texts with their repetitions taken out.

A run is a stretch of words with smallest period q (words q apart are identical), at least
max(MIN_WORDS, MIN_PERIODS * q) words long, that no neighbouring word extends. Runs are found as follows, for
many texts at a time (a slice), each text with symbols of its own:

1. Names of dyadic blocks: positions are sorted by their blocks of 2, 4, 8, ... words (prefix doubling). A block's
   name is where its group starts, so the occurrences of any dyadic block are one interval of the resulting
   suffix array. Positions whose block occurs once leave the sort, so ordinary text is done after a few rounds.
2. A wavelet matrix over the suffix array answers range successor: of an interval's positions, the next one
   before and after a given one.
3. Every block of m = 2^k words at a multiple of m asks for its occurrences in the window of m words on either
   side. Such occurrences form an arithmetic progression; its step, the distance to the nearest one, is a
   candidate period in (m/2, m]. A run of period q contains a block of the m with m/2 < q <= m, as it has at least
   2m - 1 words, and has q further words on one of the block's sides, as it has 4q in all; and no rotation of
   the smallest period equals another, so the nearest occurrence there is q away. So no run is missed.
4. Candidates are extended both ways over the blocks' names, in a step per level, and kept if long enough.
   Stretches found under several periods keep the smallest.

Time is O(n log n) for n words whatever their periods; a text is never cut, and memory follows the longest one.

Defined results: a null text is empty; texts without words have no runs and collapse to the empty text. Words
are what stands between ASCII white space, compared byte by byte; the collapsed text joins the kept words by
one space. Repeated rows are rows of their own; rows without a doc_id are handled alike. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.llm.common import read_documents, slices, texts_of, utf8

MIN_WORDS = 6
MIN_PERIODS = 4
SLICE = 1 << 20  # text bytes handled at once; one text is never cut


class Blocks:
    """Names of the dyadic blocks of several texts, and the suffix array of those that occur again.

    ``names[k][i]`` names the 2^k words from i on: equal names, equal blocks of one text. Blocks that occur once,
    or that reach beyond their text, have the name n + i, from level 1 on.
    """

    def __init__(self, word: np.ndarray, ends: np.ndarray, text: np.ndarray):
        """``word``: a number for each word; ``text``: its text's number; ``ends``: where its text ends."""
        n = len(word)
        self.ends, self.names = ends, [word]
        here = np.arange(n)
        at = here[here + 2 <= ends]
        size = int(word.max(initial=0)) + 1
        key = (text[at] * size + word[at]) * size + word[at + 1]
        by = np.argsort(key)
        at, key = at[by], key[by]
        at, start, _ = self._groups(at, key)
        slot = np.arange(len(at))
        self.order = at.copy()  # the suffix array: positions of repeated blocks
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per level from 1: positions, interval
        width = 2
        while len(at):
            names = n + here
            names[at] = slot[start]
            self.names.append(names)
            stop = np.append(np.flatnonzero(np.diff(start)) + 1, len(at))
            size_of = np.repeat(np.diff(np.concatenate([[0], stop])), np.diff(np.concatenate([[0], stop])))
            self.levels.append((at, slot[start], slot[start] + size_of))
            # next level: by this block's group, then by the next block's
            follows = np.where(at + 2 * width <= ends[at], names[np.minimum(at + width, n - 1)], n + at)
            key = slot[start] * (2 * n) + follows
            by = np.argsort(key)
            at, key = at[by], key[by]
            self.order[slot] = at
            at, start, kept = self._groups(at, key)
            slot = slot[kept]
            width *= 2

    @staticmethod
    def _groups(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of positions sorted by key: those whose key occurs again, where each one's group starts, which were kept."""
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        where = np.flatnonzero(first)
        size = np.diff(np.append(where, len(key)))
        kept = np.repeat(size > 1, size)
        size = size[size > 1]
        return at[kept], np.repeat(np.cumsum(size) - size, size), kept

    def forward(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on (x before y in one text)."""
        got = np.zeros(len(x), np.int64)
        end = self.ends[y]
        for k in reversed(range(len(self.names))):
            names, width = self.names[k], 1 << k
            inside = y + got + width <= end
            i, j = np.where(inside, x + got, 0), np.where(inside, y + got, 0)
            got += np.where(inside & (names[i] == names[j]), width, 0)
        return got

    def backward(self, x: np.ndarray, y: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many words before x equal those before y; ``begin``: where their text starts."""
        got = np.zeros(len(x), np.int64)
        for k in reversed(range(len(self.names))):
            names, width = self.names[k], 1 << k
            inside = x - got - width >= begin
            i, j = np.where(inside, x - got - width, 0), np.where(inside, y - got - width, 0)
            got += np.where(inside & (names[i] == names[j]), width, 0)
        return got


class WaveletMatrix:
    """Numbers below 2^bits; counts and order statistics of any interval, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.bits = int(values.max(initial=0)).bit_length()
        self.zeros: list[np.ndarray] = []  # of each bit: zeros before each place
        for b in reversed(range(self.bits)):
            one = (values >> b) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - one)]))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of the places low..high-1 are less than x."""
        count = np.zeros(len(x), np.int64)
        for level, zeros in enumerate(self.zeros):
            a, b, one = zeros[low], zeros[high], (x >> (self.bits - 1 - level)) & 1 == 1
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return count

    def at_rank(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of that rank (from 0) among the places low..high-1."""
        value = np.zeros(len(rank), np.int64)
        for zeros in self.zeros:
            a, b = zeros[low], zeros[high]
            one = rank >= b - a
            rank = np.where(one, rank - (b - a), rank)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
            value = 2 * value + one
        return value


def find_runs(word: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of every run of several texts, by start, then period.

    ``word``: a number for each word of all texts, ``sizes``: how many words each text has. Starts count from the first text's first word.
    """
    stops = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    blocks = Blocks(word, stops[text], text)
    found = [np.empty((0, 2), np.int64)]
    if len(blocks.order):
        # the matrix holds positions by their rank among those in the suffix array
        values = np.sort(blocks.order)
        matrix = WaveletMatrix(np.searchsorted(values, blocks.order))
        at, low, high, width = [], [], [], []
        for k, (p, first, last) in enumerate(blocks.levels, 1):
            mine = p & ((1 << k) - 1) == 0
            at.append(p[mine])
            low.append(first[mine])
            high.append(last[mine])
            width.append(np.full(int(mine.sum()), 1 << k))
        p, low, high, width = (np.concatenate(x) for x in (at, low, high, width))
        rank = matrix.below(low, high, np.searchsorted(values, p))
        for step in (1, -1):
            there = (rank + step < high - low) & (rank + step >= 0)
            near = values[matrix.at_rank(low[there], high[there], rank[there] + step)]
            period = np.abs(near - p[there])
            fits = (period <= width[there]) & ((2 * period > width[there]) | (width[there] == 2))
            found.append(np.stack([np.minimum(near, p[there])[fits], period[fits]], axis=1))
    x, period = np.unique(np.concatenate(found), axis=0).T
    start = x - blocks.backward(x, x + period, (stops - sizes)[text[x]])
    length = x + period + blocks.forward(x, x + period) - start
    runs = np.stack([start, length, period], axis=1)[length >= np.maximum(MIN_WORDS, MIN_PERIODS * period)]
    runs = runs[np.lexsort(runs.T[::-1])]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    start, length, period = runs[new].T
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=SLICE):
        split = [t.split() for t in utf8(batch)]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        stops = np.cumsum(sizes)
        number: dict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        word = np.fromiter((number[w] for ws in split for w in ws), np.int64, int(sizes.sum()))
        start, length, period = find_runs(word, sizes)
        of = np.searchsorted(stops, start, side="right")
        change = np.zeros(len(word) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        kept = np.cumsum(change)[:-1] == 0
        collapsed = []
        for ws, end, n in zip(split, stops.tolist(), sizes.tolist(), strict=True):
            mine = kept[end - n:end]
            collapsed.append(b" ".join(ws if mine.all() else [ws[i] for i in np.flatnonzero(mine)]))
        offsets = np.searchsorted(of, np.arange(len(split) + 1))
        runs = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in (start - (stops - sizes)[of], length, period)],
                                          ["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
             pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period of each, by start, then period), collapsed of every row.

    ``collapsed`` is the text without the words that any run holds after its first period.
    """
    return texts_of(docs).mapInArrow(
        _collapse, "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def made_periodic(text: Column, doc_id: Column) -> Column:
    """Texts of every tenth doc_id (by its CRC) with a tail that repeats itself; others as they are."""
    blanks, spaces = "\t\n\x0b\x0c\r", "     "
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeat(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(w, lambda x, i: F.when(i >= a, F.get(w, (a + (i - a) % p).cast("int"))).otherwise(x)), " ")

    split = F.array_remove(F.split(F.translate(text, blanks, spaces), " "), "")
    edited = F.transform(F.array(split), lambda w: F.when(F.size(w) > 0, repeat(w)))[0]
    return F.when(h % 10 == 0, edited).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir).select("doc_id", made_periodic(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic_runs(docs)
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), *(F.col(f"best.{c}") for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
