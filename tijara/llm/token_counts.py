"""Token counts through a digest cache.

The cache is a Parquet folder of (tokenizer, digest, n_tokens): digest is the SHA-256 of a text's
normalised content, tokenizer the SHA-256 of the tokenizer's file, so a new tokenizer version never
meets old counts. A call joins the documents' digests to the cache, encodes one document of each
digest that is missing, appends those counts, and reads every document's count from the cache.

Normalised content: runs of blanks, tabs and line breaks become one blank. The tokenizer does the
same before it splits, so equal normalised contents have equal counts.

Only digests are grouped (map-side first, so a text that holds a third of all rows is one row per
task); the text of each missing digest's chosen document is shuffled once, at most. The last join
meets all rows of a hot digest; adaptive execution splits it.

Defined results: null or empty text: no bytes, no tokens. Rows that repeat give repeated results. An
empty table gives an empty result. Chunks between ASCII white space are tokenized apart, which
changes nothing: the tokenizer drops white space and never joins across it. Two calls that append
the same digest at once leave two equal rows; reads take one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tijara.llm.common import read_documents, slices, stored, texts_of, utf8, work_path

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"
LIMIT = 2048
MEMO_CHUNKS = 400_000  # chunk counts a Python worker remembers (speed only)

_loaded: dict[str, tuple] = {}


def _tokenizer(version: str, content: str):
    """The worker's tokenizer of this version, and its memory of chunk counts."""
    if version not in _loaded:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_str(content)
        tok.no_truncation()
        tok.no_padding()
        _loaded[version] = (tok, {})
    return _loaded[version]


def chunk_counter(version: str, content: str):
    """Function from a list of texts (UTF-8) to their token counts."""
    def count(texts: list[bytes]) -> list[int]:
        tok, memo = _tokenizer(version, content)
        split = [t.split() for t in texts]  # bytes.split(): ASCII white space only
        new = list({c for chunks in split for c in chunks if c not in memo})
        if len(memo) + len(new) > MEMO_CHUNKS:
            memo.clear()
            new = list({c for chunks in split for c in chunks})
        encoded = tok.encode_batch_fast([c.decode() for c in new], add_special_tokens=False)
        memo.update(zip(new, map(len, encoded), strict=True))
        return [sum(map(memo.__getitem__, chunks)) for chunks in split]

    return count


def digested(docs: DataFrame) -> DataFrame:
    """(doc_id, text, digest) with the digest of the normalised content."""
    return texts_of(docs).withColumn("digest", F.unhex(F.sha2(F.regexp_replace("text", "[ \t\n\r]+", " "), 256)))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; an absent folder is an empty cache."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    df = (spark.read.schema(CACHE_SCHEMA).option("recursiveFileLookup", "true").parquet(cache) if there
          else spark.createDataFrame([], CACHE_SCHEMA))
    return df.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; missing counts are appended to ``cache``."""
    spark = docs.sparkSession
    content = open(tokenizer_path, encoding="utf-8").read()
    version = hashlib.sha256(content.encode()).hexdigest()
    shipped = spark.sparkContext.broadcast(content)  # one vocabulary file

    texts = digested(docs)
    rows = stored(texts.select("doc_id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")), "digests")
    missing = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).join(
        read_cache(spark, cache, version), "digest", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = chunk_counter(version, shipped.value)
        for batch in slices(batches):
            n = count(utf8(batch))
            yield pa.RecordBatch.from_pydict({"tokenizer": pa.array([version] * len(n), pa.string()),
                                              "digest": batch.column("digest"), "n_tokens": pa.array(n, pa.int64())})

    chosen = texts.alias("t").join(
        missing.alias("m"), (F.col("t.digest") == F.col("m.digest")) & F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")),
        "left_semi")
    chosen.mapInArrow(encode, CACHE_SCHEMA).write.parquet(f"{cache.rstrip('/')}/batch-{uuid.uuid4().hex}")

    counts = read_cache(spark, cache, version)
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache of its own for each call, so that the result never depends on earlier runs."""
    return count_tokens(read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"),
                        work_path(spark, "token-cache"))
