"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (
    alignment,
    byte_bpe,
    chat_format,
    decontaminate,
    language_id,
    licenses,
    line_dedup,
    merkle,
    packing,
    quality_rules,
    simhash_trie,
    token_counts,
    url_filter,
)
from .common import read_table


def op1_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op2_token_counts(spark, sf_dir):
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), scratch_path(spark, "token-cache"))


def op3_chat_format(spark, sf_dir):
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.format_chats(turns.unionByName(more)))


def op4_simhash(spark, sf_dir):
    groups = simhash_trie.simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash_trie.fingerprint_hex().alias("fingerprint"), "component_id")


def op5_quality_rules(spark, sf_dir):
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents")).drop("n_lines")


def op6_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_license_scan(spark, sf_dir):
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_decontamination(spark, sf_dir):
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), short_items=True)


def op10_url_filter(spark, sf_dir):
    return url_filter.judge(read_table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op11_byte_bpe(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.round_trip(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op12_token_alignment(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return alignment.link_statistics(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.verified_manifest(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_chat_format": op3_chat_format,
    "op4_simhash": op4_simhash,
    "op5_quality_rules": op5_quality_rules,
    "op6_line_dedup": op6_line_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_decontamination": op9_decontamination,
    "op10_url_filter": op10_url_filter,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE = {
    "op3_chat_format": chat_format.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op6_line_dedup": line_dedup.ORACLE,
    "op7_license_scan": licenses.oracle_sql(),
    "op13_merkle_manifest": merkle.ORACLE,
}
