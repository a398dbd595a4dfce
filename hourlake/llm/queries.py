"""The registered queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourlake.llm import (
    chat,
    decontaminate,
    near_dedup,
    packing,
    periodic_runs,
    quality_model,
    quality_rules,
    suffix_dedup,
    token_files,
    toxicity,
    turn_repair,
    url_templates,
    warc,
)
from hourlake.llm.tables import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(read_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(read_table(spark, sf_dir, "conversations"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_derivatives(read_table(spark, sf_dir, "pages"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(read_table(spark, sf_dir, "documents"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_roundtrip(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def op11_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judged(read_table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(read_table(spark, sf_dir, "documents"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_report(read_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_quality_classifier,
        op3_suffix_array_dedup,
        op4_best_fit_packing,
        op5_chat_formatting,
        op6_warc_derivatives,
        op7_minhash_near_dedup,
        op8_quality_rules,
        op9_token_files,
        op10_toxicity,
        op11_url_templates,
        op12_periodic_runs,
        op13_turn_repair,
    )
}
