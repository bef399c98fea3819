"""The older tools' commands as plans: annotate, and the filter chain."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import filters
from ..operators.line_dedup import dedup_lines
from ..operators.scoring import with_scores
from ..schema import lid_label, lid_score


def annotate(docs: DataFrame, load: Callable) -> DataFrame:
    """Every document with its line-weighted scores."""
    return with_scores(docs, load)


def legacy_filter(docs: DataFrame, language: str, load: Callable, threshold: float = 0.0, min_bytes: int = 1, max_rand: float = filters.LEGACY_MAX_RAND, seen: DataFrame | None = None) -> DataFrame:
    """Language of ``lid``, then line dedup among what is left, in the order of ``record_idx``, then bytes, scores and
    ``rand``, in this order; ``language`` and ``language_score`` come from ``lid``. A null text goes, as do documents that lost all their
    lines, if ``min_bytes`` is 1 or more; a document without a score ``rand`` is an error."""
    docs = docs.where(filters.legacy_language("lid", language) & F.col("text").isNotNull()).withColumns({"language": lid_label(F.col("lid")), "language_score": lid_score(F.col("lid"))})
    docs = dedup_lines(docs.withColumn("__lexmill_scope", F.lit(0)), threshold, scope="__lexmill_scope", seen=seen).drop("__lexmill_scope")
    docs = with_scores(docs.where(filters.long_enough_bytes("text", min_bytes)), load)
    return docs.where(filters.not_random("scores", max_rand))
