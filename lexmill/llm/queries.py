"""Queries of the subpackage, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import flat_graph, importance, jaccard_join, license_scan, mixing, packing, ppm, quality_rules, substring_dedup, suffix_index
from .common import read


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans and coverage of every license template in every document."""
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document, or piece of one, in training sequences."""
    return packing.packed(read(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal token intervals that occur at least twice in the table, by the index family."""
    return suffix_index.intervals(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition shares of every document and whether it is kept."""
    return quality_rules.metrics(read(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal token intervals that occur at least twice in the table, by window counts."""
    return substring_dedup.intervals(read(spark, sf_dir, "documents"))


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sampled in proportion to how much they are like those labelled good."""
    return importance.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_flat_graph_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of near duplicates of every vector."""
    return flat_graph.near_duplicates(read(spark, sf_dir, "embeddings"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of similar documents of every document."""
    return jaccard_join.linked(read(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken for sources to have their target shares."""
    return mixing.counts(read(spark, sf_dir, "documents"))


def op10_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every document under a model of the whole table."""
    return ppm.score(read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_best_fit_packing, op3_suffix_array_dedup, op4_quality_rules, op5_substring_dedup, op6_importance_resampling, op7_flat_graph_near_dedup, op8_ngram_jaccard_join, op9_source_mixing, op10_ppm_scoring)}


def oracle_sql() -> dict[str, str]:
    return {"op3_suffix_array_dedup": substring_dedup.sql(), "op4_quality_rules": quality_rules.sql(), "op5_substring_dedup": substring_dedup.sql(), "op8_ngram_jaccard_join": jaccard_join.sql(), "op9_source_mixing": mixing.sql()}
