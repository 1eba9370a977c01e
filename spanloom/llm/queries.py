"""Registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import (
    embeddings, html, langid, lines, manifest, mixing, packing, pieces, quality, resample, simhash,
    tokens, warc,
)
from spanloom.llm.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(read_table(spark, sf_dir, "documents"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(read_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.document_tokens(read_table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.stored_pages(read_table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.document_languages(read_table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.page_texts(read_table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read_table(spark, sf_dir, "documents"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(read_table(spark, sf_dir, "documents"))


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(read_table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    functions = (
        op1_embedding_dedup, op2_substring_dedup, op3_simhash_dedup, op4_quality_rules,
        op5_token_counts, op6_warc, op7_language_id, op8_html_text, op9_packing, op10_source_mix,
        op11_target_resampling, op12_piece_encoding, op13_merkle_manifest,
    )
    return {f.__name__: f for f in functions}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": lines.ORACLE,
        "op6_warc": warc.ORACLE,
        "op10_source_mix": mixing.ORACLE,
        "op13_merkle_manifest": manifest.ORACLE,
    }
