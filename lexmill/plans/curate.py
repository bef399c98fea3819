"""The whole curation in its order: extraction, language, lines, near-duplicates, metrics, gate, scores."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import gopher as heuristics
from ..functions import metrics
from ..functions.html import decoded, plain_text
from ..functions.text import round3
from ..operators import filters
from ..operators.line_dedup import dedup_lines, filtered_lines
from ..operators.minhash import drop_near_duplicates
from ..operators.scoring import identify_language, with_scores
from ..schema import with_document_columns
from ..storage import stored


@dataclass(frozen=True)
class CurateConfig:
    """Options of a run; models are loaders, and without one its step is left out."""

    min_length: int = 500
    languages: tuple[str, ...] | None = None
    language_model: Callable | None = None
    dedup_lines: bool = True
    seen_lines: DataFrame | None = None
    bloom: str | None = None
    min_new_bytes: float = 0.2
    scoring_models: Callable | None = None
    max_rand_score: float = 0.9
    gopher: bool = False
    gate: heuristics.GateConfig = field(default_factory=heuristics.GateConfig)
    minhash: bool = False
    minhash_threshold: float = 0.8
    minhash_num_perm: int = 128
    quality_model: Callable | None = None
    max_low_quality: float = 0.5


def extract(records: DataFrame, config: CurateConfig = CurateConfig()) -> DataFrame:
    """Captured responses as documents, long enough and in a wanted language. A record without a body, or without text in it, goes;
    one without a language goes where a language model is given."""
    docs = records.where("warc_type = 'response'").withColumn("text", plain_text(decoded("payload"))).where(filters.long_enough("text", config.min_length))
    if config.language_model is not None:
        docs = identify_language(docs, config.language_model)
        docs = docs.withColumnsRenamed({"lid_label": "language"}).withColumn("language_score", filters.language_score("language", "lid_score"))
        if config.languages is not None:
            docs = docs.where(filters.wanted_language("language", list(config.languages)))
        docs = docs.where(filters.confident("language_score")).withColumn("language_score", round3("language_score"))
    return with_document_columns(docs)


def curate(docs: DataFrame, config: CurateConfig = CurateConfig()) -> DataFrame:
    """Documents (group_idx, record_idx identify one) through all later steps. Filters are not moved across the two
    dedups: a document that goes later still counts as seen. ``seen_lines`` (column line) and ``bloom`` (path of a prebuilt filter) name lines
    that count as seen before. Null texts go with the length filter; an empty table gives none."""
    if config.dedup_lines:
        seen = config.seen_lines
        if config.bloom is not None:
            known = filtered_lines(docs, config.bloom)
            seen = known if seen is None else known.unionByName(seen.select("line"))
        docs = stored(dedup_lines(docs, config.min_new_bytes, seen=seen), "curate-lines").where(filters.still_long_enough("text", config.min_length))
    if config.minhash:
        docs = stored(drop_near_duplicates(docs, config.minhash_threshold, config.minhash_num_perm), "curate-minhash")
    docs = docs.withColumns({"repetitions": metrics.repetitions("text"), "long_words": metrics.long_words("text")})
    if config.gopher:
        docs = heuristics.with_metrics(docs, into="__m")
        own = {n: F.col(f"__m.{n}") for n in heuristics.METRICS}
        shown = F.create_map(*[x for n, c in own.items() for x in (F.lit(n), round3(c))])
        docs = docs.withColumn("gopher_metrics", shown).where(heuristics.first_failed_rule(own, config.gate).isNull()).drop("__m")
    if config.scoring_models is not None:
        docs = with_scores(docs, config.scoring_models).where(filters.not_random("scores", config.max_rand_score))
    if config.quality_model is not None:
        docs = with_scores(docs, config.quality_model, prefix="dclm_").where(filters.not_low_quality("scores", config.max_low_quality))
    return docs
