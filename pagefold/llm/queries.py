"""One query per operator, over the whole of its tables, with the settings of a production run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagefold.llm import (
    decontamination,
    mixing,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    resampling,
    sharding,
    simhash,
    spelling,
    substring,
    token_counts,
    toxicity,
)
from pagefold.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]


def mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(load_table(spark, folder, "documents"))


def quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.rule_report(load_table(spark, folder, "documents"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.spans_report(load_table(spark, folder, "documents"))


def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.classify(load_table(spark, folder, "documents"))


def decontamination_hits(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.overlap_report(
        load_table(spark, folder, "documents"), load_table(spark, folder, "benchmark")
    )


def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.group_report(load_table(spark, folder, "documents"))


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return substring.removal_report(load_table(spark, folder, "documents"))


def edited_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.edit_report(load_table(spark, folder, "documents"))


def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_report(load_table(spark, folder, "documents"), load_table(spark, folder, "labels"))


def kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_report(load_table(spark, folder, "documents"))


def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_report(load_table(spark, folder, "documents"))


def target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample_report(load_table(spark, folder, "documents"), load_table(spark, folder, "benchmark"))


def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packing_report(load_table(spark, folder, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_mixing": mixture,
    "op2_quality_rules": quality_votes,
    "op3_pii": personal_data,
    "op4_quality_classifier": quality_scores,
    "op5_decontamination": decontamination_hits,
    "op6_simhash": simhash_groups,
    "op7_substring": repeated_passages,
    "op8_token_counts": edited_token_counts,
    "op9_toxicity": toxicity_scores,
    "op10_sharding": kd_shards,
    "op11_spelling_variants": spelling_variants,
    "op12_resampling": target_resampling,
    "op13_packing": packed_sequences,
}
