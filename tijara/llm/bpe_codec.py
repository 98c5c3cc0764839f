"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

Spark counts the corpus's words (all texts; map-side combined), the most frequent are encoded once
and compiled into a minimal acyclic automaton: words with equal endings share their states, and the
numbers on the arcs of a word's path add up to its ordinal, which leads to its token ids. The
arrays are shipped as one file (bounded by ``lexicon_words``), memory-mapped by every Python worker,
and walked for all distinct words of a slice of texts at once. Words outside it are merged
exactly, all of a slice at once.

A word here is a piece of text that the tokenizer never joins with its neighbours: texts are cut
before a single blank or line break between two visible characters (and after such a line break),
where the tokenizer's own splitting always has a boundary. So ids are equal to those of whole texts.

Defined results: null or empty text: no tokens, digests of nothing. Repeated rows give repeated
results; an empty table gives an empty one. Decoding replaces bytes that are no UTF-8, as the
library does.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.llm.common import count_for, read_documents, slices, stored, texts_of

LEXICON_WORDS = 1 << 16
COUNT_WORDS = 300_000  # distinct words a task counts before it hands partial counts on

# visible characters of ASCII, Latin-1 and Latin Extended-A/B: none is white space
_V = "[!-~¡-ɏ]"
_CUT = re.compile(f"(?<={_V})(?=[ \n]{_V})|(?<={_V}\n)(?={_V})")


# the tokenizer's own splitting, for text of the characters above
_PIECES = regex.compile(public_tokenizers.PATTERN)
_OTHER = re.compile("[^ \n!-~¡-ɏ]")
_PLAIN = re.compile("[ ]?[^ \n]+|\n")


def words_of(text: str) -> list[str]:
    """The text cut into words; joined they give the text again.

    A text of visible characters with single blanks and line breaks between them (the usual case)
    takes a faster pattern with the same result.
    """
    if not text:
        return []
    if (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or _OTHER.search(text)):
        return _CUT.split(text)
    return _PLAIN.findall(text)


class KeyTable:
    """Positions of distinct 64-bit keys, found for whole arrays (open addressing, load under 1/8)."""

    EMPTY = np.int64(-1)

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(len(keys) * 8).bit_length())
        self.keys = np.full(1 << self.bits, self.EMPTY, np.int64)
        self.at = np.zeros(1 << self.bits, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == self.EMPTY
            _, one = np.unique(slot[free], return_index=True)  # one key for each free slot
            took = np.flatnonzero(free)[one]
            self.keys[slot[took]], self.at[slot[took]] = keys[left[took]], left[took]
            rest = np.ones(len(left), bool)
            rest[took] = False
            left, slot = left[rest], (slot[rest] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 for others."""
        out = np.full(len(keys), -1, np.int64)
        slot = self._slot(keys)
        there = self.keys[slot]
        hit = there == keys
        out[hit] = self.at[slot[hit]]
        open_ = np.flatnonzero(~hit & (there != self.EMPTY))
        while len(open_):
            slot_ = slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slot_]
            hit = there == keys[open_]
            out[open_[hit]] = self.at[slot_[hit]]
            open_ = open_[~hit & (there != self.EMPTY)]
        return out


# ---- the transducer ------------------------------------------------------------------------------

class Transducer:
    """Minimal acyclic automaton over bytes whose path sums are word ordinals.

    ``arc_key`` is state * 256 + byte, ascending; ``arc_to`` the next state, ``arc_add`` what the arc
    adds to the ordinal; ``final`` marks the states in which a word ends.
    """

    def __init__(self, arc_key: np.ndarray, arc_to: np.ndarray, arc_add: np.ndarray, final: np.ndarray):
        self.arc_key, self.arc_to, self.arc_add, self.final = arc_key, arc_to, arc_add, final
        self.arcs = KeyTable(arc_key)

    @classmethod
    def compile(cls, words: list[bytes]) -> Transducer:
        """``words`` ascending and distinct. Built bottom-up: a state whose subtree can no longer
        change is replaced by an equal one of the register."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []  # of registered states: (final, ((byte, state), ...))
        count: list[int] = []  # words that a registered state accepts
        path: list[tuple[bool, list]] = [(False, [])]  # open states along the last word
        last = b""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                final, arcs = path.pop()
                key = (final, tuple(arcs))
                number = register.get(key)
                if number is None:
                    number = register[key] = len(states)
                    states.append(key)
                    count.append(final + sum(count[s] for _, s in arcs))
                path[-1][1][-1] = (path[-1][1][-1][0], number)

        for word in words:
            same = len(os.path.commonprefix([word, last]))
            close(same)
            for byte in word[same:]:
                path[-1][1].append((byte, -1))
                path.append((False, []))
            path[-1] = (True, path[-1][1])
            last = word
        close(0)
        states.append((path[0][0], tuple(path[0][1])))  # the start state is the last one
        key, to, add = [], [], []
        for number, (final, arcs) in enumerate(states):
            before = int(final)  # the state's own word comes first
            for byte, target in arcs:
                key.append(number << 8 | byte)
                to.append(target)
                add.append(before)
                before += count[target]
        return cls(np.array(key, np.int64), np.array(to, np.int32), np.array(add, np.int32),
                   np.array([f for f, _ in states], np.bool_))

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """Each word's ordinal, -1 if it isn't in the lexicon; all words step on together."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.arc_key):
            return out
        size = np.fromiter(map(len, words), np.int64, n)
        begin = np.cumsum(size) - size
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        live = np.arange(n)
        state = np.full(n, len(self.final) - 1, np.int64)
        total = np.zeros(n, np.int64)
        step = 0
        while len(live):
            ended = size[live] == step
            done = ended & self.final[state]
            out[live[done]] = total[done]
            live, state, total = live[~ended], state[~ended], total[~ended]
            key = state << 8 | text[begin[live] + step]
            arc = self.arcs.find(key)
            ok = arc >= 0
            live, state, total = live[ok], self.arc_to[arc[ok]].astype(np.int64), total[ok] + self.arc_add[arc[ok]]
            step += 1
        return out


class Lexicon:
    """Transducer plus the ids of each ordinal, saved as one memory-mapped file."""

    PARTS = (("arc_key", np.int64), ("arc_to", np.int32), ("arc_add", np.int32), ("final", np.bool_),
             ("id_at", np.int64), ("ids", np.uint32))

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        self.transducer = Transducer(*(parts[k] for k in ("arc_key", "arc_to", "arc_add", "final")))
        self.id_at, self.ids = parts["id_at"], parts["ids"]

    @classmethod
    def compile(cls, ids_of: dict[bytes, list[int]]) -> Lexicon:
        words = sorted(ids_of)
        fst = Transducer.compile(words)
        sizes = np.array([0, *(len(ids_of[w]) for w in words)], np.int64)
        return cls({"arc_key": fst.arc_key, "arc_to": fst.arc_to, "arc_add": fst.arc_add, "final": fst.final,
                    "id_at": np.cumsum(sizes), "ids": np.array([i for w in words for i in ids_of[w]], np.uint32)})

    def save(self, path: str) -> None:
        with open(path, "wb") as f:
            head = json.dumps([len(self.parts[k]) for k, _ in self.PARTS]).ljust(256).encode()
            f.write(head)
            for k, kind in self.PARTS:
                data = self.parts[k].astype(kind).tobytes()
                f.write(data.ljust(-(-len(data) // 8) * 8, b"\0"))

    @classmethod
    def load(cls, path: str) -> Lexicon:
        whole = np.memmap(path, np.uint8, "r")
        parts, at = {}, 256
        for (k, kind), n in zip(cls.PARTS, json.loads(bytes(whole[:256])), strict=True):
            size = n * np.dtype(kind).itemsize
            parts[k] = whole[at:at + size].view(kind)
            at += -(-size // 8) * 8
        return cls(parts)

    def lookup(self, words: list[bytes]) -> list[bytes | None]:
        """Each word's ids as little-endian 32-bit integers; None outside the lexicon."""
        found = self.transducer.ordinals(words)
        hit = np.maximum(found, 0)
        if not len(self.id_at) > 1:
            return [None] * len(words)
        blob = self.ids.tobytes()
        at, to = (self.id_at[hit] * 4).tolist(), (self.id_at[hit + 1] * 4).tolist()
        return [blob[a:b] if f >= 0 else None for f, a, b in zip(found.tolist(), at, to, strict=True)]


# ---- encoding and decoding in a worker -------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes
    for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Merger:
    """The tokenizer's merges applied to many pieces at once.

    In every round each piece merges all places of its pair of lowest rank, left to right; a merge
    never makes a pair of lower rank, so this equals merging one place at a time.
    """

    def __init__(self, spec: dict):
        vocab, byte_of = spec["model"]["vocab"], byte_alphabet()
        self.first = np.zeros(256, np.int64)
        for c, b in byte_of.items():
            self.first[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = KeyTable(np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64))  # position = rank
        self.to = np.array([vocab[a + b] for a, b in pairs], np.int64)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian 32-bit integers."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        piece = np.repeat(np.arange(len(pieces)), size)
        ids = self.first[np.frombuffer(b"".join(pieces), np.uint8)]
        none = len(self.to)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            pair = ids[:-1] << 32 | ids[1:]
            at = self.ranks.find(pair)
            rank = np.append(np.where((at >= 0) & (piece[1:] == piece[:-1]), at, none), none)
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            over = least == none
            done.append((piece[over], ids[over]))
            chosen = (rank == least) & ~over
            # of neighbouring places (a pair of equal symbols) every second one merges
            run = np.flatnonzero(chosen)
            begin = np.append(True, np.diff(run) != 1) if len(run) else np.zeros(0, bool)
            nth = np.arange(len(run)) - np.maximum.accumulate(np.where(begin, np.arange(len(run)), 0))
            run = run[nth % 2 == 0]
            ids[run] = self.to[rank[run]]
            keep = ~over
            keep[run + 1] = False
            ids, piece = ids[keep], piece[keep]
        piece = np.concatenate([p for p, _ in done]) if done else piece
        ids = np.concatenate([i for _, i in done]) if done else ids
        order = np.argsort(piece, kind="stable")
        ends = 4 * np.cumsum(np.bincount(piece, minlength=len(pieces)))
        blob = ids[order].astype("<u4").tobytes()
        return [blob[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def token_bytes(content: str) -> list[bytes]:
    """Bytes of each id: byte-level token strings spelled back, added tokens as they stand."""
    spec, byte_of = json.loads(content), byte_alphabet()
    table = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()}
    table |= {a["id"]: a["content"].encode() for a in spec["added_tokens"]}
    return [table.get(i, b"") for i in range(max(table) + 1)]


def load_tokenizer(content: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(content)
    tok.no_truncation()
    tok.no_padding()
    return tok


class Codec:
    """Encoder and decoder of one tokenizer file with a lexicon."""

    def __init__(self, content: str, lexicon: Lexicon):
        self.tokenizer, self.lexicon = load_tokenizer(content), lexicon
        self.bytes_of = token_bytes(content)
        spec = json.loads(content)
        self.merger = Merger(spec)
        self.special = re.compile("|".join([_OTHER.pattern, *(re.escape(a["content"]) for a in spec["added_tokens"])]))

    def merged(self, words: list[str]) -> list[bytes]:
        """Ids of words outside the lexicon: their pieces by the merger. Words with characters whose
        Unicode class may differ between libraries, or with added tokens, go to the library itself."""
        plain = [w for w in words if not self.special.search(w)]
        split = [_PIECES.findall(w) for w in plain]
        pieces = list(dict.fromkeys(p for ps in split for p in ps))
        encoded = [p.encode() for p in pieces]
        ids = dict(zip(pieces, self.lexicon.lookup(encoded), strict=True))
        new = [p for p, found in ids.items() if found is None]
        for p, i in zip(new, self.merger.merge([p.encode() for p in new]), strict=True):
            ids[p] = i
        out = {w: b"".join([ids[p] for p in ps]) for w, ps in zip(plain, split, strict=True)}
        rest = [w for w in words if w not in out]
        for w, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            out[w] = np.array(e.ids, "<u4").tobytes()
        return [out[w] for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [words_of(t) for t in texts]
        words = list(dict.fromkeys(w for ws in split for w in ws))
        ids = dict(zip(words, self.lexicon.lookup([w.encode() for w in words]), strict=True))
        unseen = [w for w, found in ids.items() if found is None]
        ids.update(zip(unseen, self.merged(unseen), strict=True))
        return [b"".join(map(ids.__getitem__, ws)) for ws in split]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def _codec(content: str, file: str) -> Codec:
    if file not in _codecs:
        _codecs.clear()
        _codecs[file] = Codec(content, Lexicon.load(SparkFiles.get(file)))
    return _codecs[file]


# ---- Spark side --------------------------------------------------------------------------------------

def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def flush():
        return pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()),
                                           "n": pa.array(list(counts.values()), pa.int64())})

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            counts.update(words_of(text))
            if len(counts) > COUNT_WORDS:
                yield flush()
                counts.clear()
    yield flush()


def frequent_words(docs: DataFrame, n: int) -> list[str]:
    """The most frequent words of all texts, at most ``n``: words of one count come all or not at all."""
    counted = texts_of(docs).select("text").mapInArrow(_count_words, "word string, n bigint")
    total = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    least = count_for(total, n)
    return [] if least is None else [r.word for r in total.where(F.col("n") >= least).select("word").collect()]


def build_lexicon(words: list[str], content: str) -> Lexicon:
    encoded = load_tokenizer(content).encode_batch_fast(words, add_special_tokens=False)
    return Lexicon.compile({w.encode(): e.ids for w, e in zip(words, encoded, strict=True)})


def ship_lexicon(spark: SparkSession, lexicon: Lexicon) -> str:
    """Name under which every worker finds the lexicon's file (Spark fetches it to each executor)."""
    name = f"lexicon-{uuid.uuid4().hex}"
    path = f"{tempfile.mkdtemp(prefix='tijara-lexicon-')}/{name}"
    lexicon.save(path)
    spark.sparkContext.addFile(path)
    return name


def _mapped(docs: DataFrame, tokenizer_path: str, lexicon_words: int, schema: str, row) -> DataFrame:
    spark = docs.sparkSession
    content = open(tokenizer_path, encoding="utf-8").read()
    file = ship_lexicon(spark, build_lexicon(frequent_words(docs, lexicon_words), content))
    shipped = spark.sparkContext.broadcast(content)  # one vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shipped.value, file)
        for batch in slices(batches):
            yield row(codec, batch)

    return texts_of(docs).mapInArrow(run, schema)


def encode(docs: DataFrame, tokenizer_path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id and the text's ids (array of long)."""
    def row(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [np.frombuffer(b, "<u4").astype(np.int64) for b in codec.encode(batch.column("text").to_pylist())]
        return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int64()))})

    return _mapped(docs, tokenizer_path, lexicon_words, "doc_id bigint, ids array<bigint>", row)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids decode to the empty text."""
    content = open(tokenizer_path, encoding="utf-8").read()
    shipped = encoded.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(shipped.value)
        for batch in batches:
            texts = [b"".join(map(table.__getitem__, ids or ())).decode("utf-8", "replace")
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(run, "doc_id bigint, text string")


def round_trip(docs: DataFrame, tokenizer_path: str, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text is encoded, and its ids decoded again."""
    def row(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = codec.encode(batch.column("text").to_pylist())
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(b) // 4 for b in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(b).hexdigest() for b in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(codec.decode(b).encode()).hexdigest() for b in ids], pa.string())})

    return _mapped(docs, tokenizer_path, lexicon_words,
                   "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string", row)


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the token ids' count and digests of every remaining document."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))
