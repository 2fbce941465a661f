"""Token counts through a digest cache.

The count of a text under a tokenizer is stored under the SHA-256 of its
normalised content and the tokenizer's version digest.  A run joins its
documents' digests to the stored counts, encodes only distinct misses and
appends them to the cache, a Parquet folder that any number of runs share.

Normalising maps a null text to the empty one and changes nothing else, since
every character counts for a tokenizer.

Defined cases: a null or empty text has no tokens; copies of a text are
encoded once; repeated rows keep a row each; an empty table gives an empty
result and leaves the cache as it is; a cache that holds a digest twice (two
runs met the same new text) is read as if it held it once.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, python_bytes, slices
from .memo import Memo

CACHE_SCHEMA = "digest binary, tokenizer string, n_tokens long"
LIMIT = 4096


class PieceCounter:
    """Counts of a sentencepiece model, one encode for each distinct word that
    a bounded memo does not hold.

    No piece of the model reaches from a word into the space after it, nor
    holds a line feed beside other characters (both are checked here), so a
    text's tokens are those of its words, each with the space before it, and
    those of the parts after a line feed.  Texts with runs of spaces, spaces at
    an end, or the model's own space sign are encoded whole."""

    def __init__(self, path: str, memo_words: int = 600_000):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.by_word = not any(re.search("[^▁]▁|\n", x) for x in names)
        self.memo = Memo(self._count, memo_words)

    def _count(self, word: bytes) -> int:
        # the model puts a space before what it encodes; none stood before a line feed
        return len(self.model.encode(word.decode("utf-8", "replace"))) - (word[:1] == b"\n")

    def count(self, text: bytes) -> int:
        if not text:
            return 0
        parted = text.replace(b"\n", b" \n")
        if not self.by_word or b"  " in parted or parted[:1] == b" " or parted[-1:] == b" " or "▁".encode() in text:
            return len(self.model.encode(text.decode("utf-8", "replace")))
        return sum(self.memo.many(parted.split(b" ")))


def tokenizer_digest(path: str) -> str:
    """SHA-256 of the tokenizer's file and the version of its library."""
    import sentencepiece
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + sentencepiece.__version__.encode()).hexdigest()


def normalised(text):
    """The content that is counted."""
    return F.coalesce(text.cast("string"), F.lit(""))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """The stored counts; empty if nothing was stored at ``path`` yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def _encode(model_path: str, tokenizer: str):
    schema = pa.schema([("digest", pa.binary()), ("tokenizer", pa.string()), ("n_tokens", pa.int64())])

    def encode(batches):
        counter = PieceCounter(model_path)
        for batch in batches:
            for part in slices(batch, "content", 8 << 20):
                counts = [counter.count(t) for t in python_bytes(part.column("content"))]
                yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array([tokenizer] * len(counts), pa.string()), pa.array(counts, pa.int64())], schema=schema)
    return encode


def count_tokens(docs: DataFrame, model_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens and over_limit.
    New counts are appended to the cache before this returns."""
    spark = docs.sparkSession
    prepare(spark)
    version = tokenizer_digest(model_path)
    content = normalised(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("doc_id"), content.alias("content"), F.unhex(F.sha2(content, 256)).alias("digest"))
    stored = read_cache(spark, cache_path).filter(F.col("tokenizer") == version).select("digest", "n_tokens")
    # copies meet in a task's own part first: a third of all rows may be one text
    distinct = keyed.select("digest", "content").dropDuplicates(["digest"])
    # (an outer join, since Spark would put an anti join before the aggregate)
    misses = distinct.join(stored.withColumnRenamed("n_tokens", "stored"), "digest", "left").filter("stored is null")
    misses.select("digest", "content").mapInArrow(_encode(model_path, version), CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == version)
              .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    # the second key keeps the aggregate out of the join's stage, so that Spark
    # can split a digest that a third of all rows share
    second = F.xxhash64("digest").alias("second")
    rows = keyed.select("doc_id", "digest", second, F.octet_length("content").cast("long").alias("n_bytes"))
    return (rows.join(counts.select("*", second), ["digest", "second"])
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
