"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; ``run`` writes every stage's
rows to the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import jaccard_join, mixing, packing, quality_rules, substring_dedup
from lexmill.llm.common import read, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return quality_rules.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group of equal or similar texts, with a doc_id or without, and all others."""
    return jaccard_join.keep_one_row(docs)


def shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that occur again anywhere."""
    return substring_dedup.cut(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn, some several times, so that each source has its target share of bytes."""
    return mixing.mixed(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document, or piece of one, in training sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", shared_passages),
    ("mixing sources", source_mixture),
    ("best-fit packing", packed_sequences),
]

#: SQL has no form of the packing's local search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
