"""Queries of this package: each applies one operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weir.llm import (
    alignment,
    decontam,
    minhash,
    neighbours,
    pieces,
    prefix_trie,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_counts,
    toxicity,
)
from weir.llm.common import read


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeated(read(spark, sf_dir, "documents", "doc_id", "text"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(read(spark, sf_dir, "documents", "doc_id", "text"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(read(spark, sf_dir, "documents", "doc_id", "text"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "lang", "text")
    return quality.classify(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_tokens(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(read(spark, sf_dir, "documents", "doc_id", "text"))


_OPERATORS = (
    op1_sentencepiece,
    op2_toxicity,
    op3_substring_dedup,
    op4_decontamination,
    op5_nearest_neighbours,
    op6_suffix_array_dedup,
    op7_minhash_near_dedup,
    op8_secret_scans,
    op9_quality_classifier,
    op10_token_counts,
    op11_prefix_trie,
    op12_simhash_near_dedup,
    op13_tokenizer_alignment,
)

QUERIES = {f.__name__: f for f in _OPERATORS}

ORACLE_SQL: dict[str, str] = {
    "op3_substring_dedup": substring_dedup.remove_repeated_sql(),
    "op4_decontamination": decontam.leaks_sql(),
    "op6_suffix_array_dedup": suffix_dedup.remove_repeated_sql(),
    "op7_minhash_near_dedup": minhash.near_duplicates_sql(),
    "op11_prefix_trie": prefix_trie.prefix_nodes_sql(),
}
