"""Corpus pipeline: documents to packed training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet into the shared folder and read back as the next stage's
documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fusekit.llm import decontaminate, line_dedup, packing, quality_rules, simhash_trie
from fusekit.llm.common import prepare, read_table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that another document holds first go; n_chars follows the text."""
    done = line_dedup.line_dedup(docs, kept="__kept", n_lines="__lines", n_dropped="__dropped")
    kept = F.when(F.col("__dropped") > 0, F.col("__kept")).otherwise(F.col("text"))
    done = done.withColumn("text", kept)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("__dropped") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: its smallest doc_id."""
    return simhash_trie.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), short_items=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_dedup_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Edit matching, XXH64 fingerprints and tokenizers have no SQL form; the
#: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
