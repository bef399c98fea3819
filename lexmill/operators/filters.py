"""Row filters; each returns the predicate that is true for rows that stay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.metrics import numeric_share
from ..functions.text import col
from ..schema import lid_label, lid_score


#: The older tools' bound on ``rand``.
LEGACY_MAX_RAND = 1.0


def long_enough(text: Column | str = "text", min_length: int = 500) -> Column:
    """More than so many characters: of extracted text, before anything is removed."""
    return F.length(col(text)) > min_length


def still_long_enough(text: Column | str = "text", min_length: int = 500) -> Column:
    """At least so many characters: after repeated lines went."""
    return F.length(col(text)) >= min_length


def long_enough_bytes(text: Column | str = "text", min_length: int = 1) -> Column:
    """At least so many bytes."""
    return F.octet_length(col(text)) >= min_length


def language_score(label: Column | str, score: Column | str) -> Column:
    """The score, doubled for Croatian, which detectors confuse with its neighbours."""
    return F.when(col(label) == "hr", col(score) * 2).otherwise(col(score))


def wanted_language(label: Column | str, languages: list[str]) -> Column:
    return col(label).isin(list(languages))


def confident(score: Column | str, least: float = 0.8) -> Column:
    return col(score) >= least


def not_random(scores: Column | str = "scores", most: float = 0.9) -> Column:
    """Score ``rand`` at most so high; a document without that score is an error."""
    rand = F.try_element_at(col(scores), F.lit("rand"))
    return F.when(rand.isNull(), F.raise_error(F.lit("scores have no entry rand")).cast("boolean")).otherwise(rand <= most)


def not_low_quality(scores: Column | str = "scores", most: float = 0.5) -> Column:
    """Score ``dclm_low``, 0 where absent, at most so high."""
    return F.coalesce(F.try_element_at(col(scores), F.lit("dclm_low")), F.lit(0.0)) <= most


def legacy_language(lid: Column | str, language: str) -> Column:
    return lid_label(col(lid)) == language


def legacy_gate(lid: Column | str = "lid", scores: Column | str = "scores") -> Column:
    """Language score of at least 0.85 and ``rand`` of at most 0.8, absent ones counting as 1 and 0; in single precision."""
    rand = F.coalesce(F.try_element_at(col(scores), F.lit("rand")), F.lit(0.0))
    return (lid_score(col(lid)).cast("float") >= F.lit(0.85).cast("float")) & (rand.cast("float") <= F.lit(0.8).cast("float"))


def not_generated(text: Column | str = "text") -> Column:
    """No "generated by" that starts within the first 400 bytes."""
    t = col(text)
    return ~(t.rlike("[Gg]enerated by") & (F.octet_length(F.split(t, "[Gg]enerated by", 2)[0]) < 400))


def code_gate(text: Column | str = "text", stars: Column | str = "repo_stars") -> Column:
    """Fewer numeric characters than a fifth, more than ten stars, and not generated."""
    return F.coalesce(numeric_share(text) < 0.2, F.lit(False)) & (F.coalesce(col(stars), F.lit(0.0)) > 10) & not_generated(text)


def unix_newlines(text: Column | str = "text") -> Column:
    return F.replace(col(text), F.lit("\r\n"), F.lit("\n"))
