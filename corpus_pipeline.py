"""The corpus pipeline: five stages over ``documents``, each by one operator.

Every stage takes what its predecessor kept, written as Parquet and read again.
Rows that a stage rejects go; the cleaned or shortened text replaces ``text`` (and
``n_chars``). The last stage returns the draws of the training mix.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from deltarecon.llm import decontaminate, mixing, quality, simhash, suffix_dedup
from deltarecon.llm.common import table
from deltarecon.session import hand_over, materialize, remove_path, scratch_scope


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    return quality.clean(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group."""
    return simhash.keep_first(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings that also start earlier."""
    return suffix_dedup.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The draws of the mix."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# Components and repeated strings have no SQL form; tests/llm/test_pipeline.py holds
# the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``. What a stage writes on its way goes when its
    result is written, and that when the next one's is. The last result is lazy: what
    it reads goes with the caller's ``session.scratch_scope``."""
    docs, before = table(spark, sf_dir, "documents"), None
    *firsts, (_, last) = STAGES
    for name, stage in firsts:
        with scratch_scope(spark) as made:
            docs = materialize(stage(spark, docs, sf_dir), name)
            path = made.pop()
        if before:
            remove_path(spark, os.path.dirname(before))
        before = path
    hand_over(before)
    return last(spark, docs, sf_dir)
