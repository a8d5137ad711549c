"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cdrflow.llm.common import table
from cdrflow.llm.cover_lloyd import compressed_vectors
from cdrflow.llm.cover_tree import near_duplicates
from cdrflow.llm.fit_packing import pack_documents
from cdrflow.llm.gram_variants import spelling_variants
from cdrflow.llm.ngram_join import jaccard_components
from cdrflow.llm.oracle import ORACLE_SQL
from cdrflow.llm.order_minhash import fingerprint_documents
from cdrflow.llm.quality_gam import score_documents
from cdrflow.llm.secret_scan import scan_secrets, span_digest
from cdrflow.llm.sentence_pieces import piece_digests
from cdrflow.llm.style_tree import extract_pages
from cdrflow.llm.substring_dedup import dedup_documents
from cdrflow.llm.token_store import stored_documents
from cdrflow.llm.url_filters import filter_urls


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_documents(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(scan_secrets(table(spark, sf_dir, "documents")))


def op7_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op11_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_cover_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed_vectors(table(spark, sf_dir, "embeddings"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {
    "op1_quality_gam": op1_quality_gam,
    "op2_style_tree": op2_style_tree,
    "op3_sentence_pieces": op3_sentence_pieces,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_secret_scan": op6_secret_scan,
    "op7_fit_packing": op7_fit_packing,
    "op8_cover_tree": op8_cover_tree,
    "op9_order_minhash": op9_order_minhash,
    "op10_url_filters": op10_url_filters,
    "op11_gram_variants": op11_gram_variants,
    "op12_token_store": op12_token_store,
    "op13_cover_lloyd": op13_cover_lloyd,
}
