"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deltarecon.llm import (
    decontaminate, html_text, katz, langid, licenses, mixing, periodic, quality, simhash, suffix_dedup,
    token_counts, toxicity, whitening)
from deltarecon.llm.common import table


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(table(spark, sf_dir, "documents"), katz.held_out(F.col("doc_id"), 4, 2))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(table(spark, sf_dir, "documents"), katz.held_out(F.col("doc_id"), 7, 2))


def op5_line_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), katz.held_out(F.col("doc_id"), 3, 1))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_report(table(spark, sf_dir, "documents"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.page_report(table(spark, sf_dir, "pages"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_temperature_mixing,
    op2_license_scan,
    op3_token_counts,
    op4_katz_scoring,
    op5_line_quality_rules,
    op6_toxicity,
    op7_simhash_near_dedup,
    op8_language_id,
    op9_benchmark_decontamination,
    op10_suffix_array_dedup,
    op11_periodic_runs,
    op12_html_extraction,
    op13_embedding_whitening,
)}
