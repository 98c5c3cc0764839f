"""Word-shingle sets as 64-bit hashes, and a bounded sketch of how often shingles occur."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tijara.llm.common import count_for, slices, stored, utf8

SLOTS = 1 << 22
LEVELLED = 1 << 17
_SHIFT = np.uint64(42)  # the hash's highest bits number its slot


class WordHashes(dict):
    """64-bit hash of each word; remembers words, within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(words: WordHashes, texts: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's shingle hashes, in order and with repeats: runs of k words between ASCII white
    space, A-Z lower-cased; one hash of all words if they are fewer; none without words."""
    split = [t.lower().split() for t in texts]
    size = np.fromiter(map(len, split), np.int64, len(split))
    h = words.of([w for ws in split for w in ws])
    runs = np.full(max(0, len(h) - k + 1), k, np.uint64)
    for i in range(k):
        runs = mix(runs + h[i:i + len(runs)])
    out = []
    for end, n in zip(np.cumsum(size).tolist(), size.tolist(), strict=True):
        if n >= k or not n:
            out.append(runs[end - n:end - n + max(0, n - k + 1)])
            continue
        short = np.full(1, n, np.uint64)
        for x in h[end - n:end]:
            short = mix(short + x)
        out.append(short)
    return out


def shingle_sets(words: WordHashes, texts: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's distinct shingles, ascending."""
    return [np.unique(h) for h in shingle_hashes(words, texts, k)]


def shingle_levels(texts: DataFrame, k: int) -> np.ndarray:
    """A level for each of SLOTS hash slots: 0 for ordinary ones, more the commoner their shingles are
    (uint8, two steps per doubling of the count).

    Every task counts all its shingles by slot and hands on the slots that stand out from its average;
    Spark adds them up, and the LEVELLED largest get a level. So a shingle in a noticeable share of the
    documents is seen at any size of the corpus. Levels only order shingles: no result depends on them.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = WordHashes(), np.zeros(SLOTS, np.int32)
        for batch in slices(batches):
            found = (np.concatenate(shingle_hashes(words, utf8(batch), k)) >> _SHIFT).astype(np.int64)
            slot, n = np.unique(found, return_counts=True)
            total[slot] += n.astype(np.int32)
        slot = np.flatnonzero(total >= max(4.0, 4 * total.mean()))
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slot, pa.int64()), "n": pa.array(total[slot], pa.int64())})

    counts = stored(texts.select("text").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")), "slots")
    levels, least = np.zeros(SLOTS, np.uint8), count_for(counts, LEVELLED)
    for r in [] if least is None else counts.where(F.col("n") >= least).collect():
        levels[r.slot] = min(255, 1 + int(2 * np.log2(r.n)))
    return levels


def in_order(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Ascending shingles put in the order (level, hash), which all documents' prefixes follow."""
    return shingles[np.argsort(levels[shingles >> _SHIFT], kind="stable")]


def parity_bits(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the shingles in each of ``bits`` cells, as 64-bit integers.

    Two sets differ in at least as many members as their parities differ in cells.
    """
    cells = np.bincount((shingles >> np.uint64(8)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)
