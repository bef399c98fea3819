"""Document metrics and the heuristic gate over them, as native expressions in one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stop_words import STOP_WORDS
from .text import MARK, WS, col, let, lines, ratio, total_bytes, trim, words

METRICS = (
    "mean_word_length",
    "frac_words_with_alpha",
    "frac_lines_end_punctuation",
    "frac_lines_start_bullet",
    "frac_alphabetic_chars",
    "has_stop_words",
    "frac_duplicate_sentences",
    "frac_duplicate_paragraphs",
)


@dataclass(frozen=True)
class GateConfig:
    """Bounds of the gate; a document on a bound passes."""

    min_mean_word_length: float = 3.0
    max_mean_word_length: float = 10.0
    min_frac_words_with_alpha: float = 0.8
    min_frac_lines_end_punctuation: float = 0.1
    max_frac_lines_start_bullet: float = 0.9
    min_frac_alphabetic_chars: float = 0.7
    require_stop_words: bool = True
    max_frac_duplicate_sentences: float = 0.3
    max_frac_duplicate_paragraphs: float = 0.3


def _or_zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def mean_word_length(text: Column | str) -> Column:
    """Bytes of words per word; 0 without words."""
    return _mean_bytes(words(text))


def _mean_bytes(w: Column) -> Column:
    return _or_zero(ratio(total_bytes(w), F.size(w)))


def frac_words_with_alpha(text: Column | str) -> Column:
    """Share of words with an alphabetic character."""
    return _share(words(text), _has_alpha)


def _has_alpha(word: Column) -> Column:
    return word.rlike(r"\p{IsAlphabetic}")


def _share(items: Column, test) -> Column:
    return _or_zero(ratio(F.size(F.filter(items, test)), F.size(items)))


def frac_lines_end_punctuation(text: Column | str) -> Column:
    """Share of lines, blank ones included, whose last character before white space is one of . ! ? ; :"""
    return _share(lines(text), _ends_in_punctuation)


def _ends_in_punctuation(line: Column) -> Column:
    return line.rlike(rf"[.!?;:]{WS}*\z")


def frac_lines_start_bullet(text: Column | str) -> Column:
    """Share of lines that start with - * + or with ASCII digits and a full stop."""
    return _share(lines(text), _starts_with_bullet)


def _starts_with_bullet(line: Column) -> Column:
    return line.rlike(rf"^{WS}*([-*+]|[0-9]+\.)")


def frac_alphabetic_chars(text: Column | str) -> Column:
    """Share of characters, white space included, that are alphabetic."""
    t = col(text)
    return _or_zero(ratio(F.length(F.regexp_replace(t, r"[^\p{IsAlphabetic}]+", "")), F.length(t)))


def has_stop_words(text: Column | str, language: Column | str) -> Column:
    """1 where two entries of the language's list occur as lower-cased words, or the language has no list; else 0."""
    return _stop_words(words(text), language)


def _by_language(lists: dict[str, list[str]], language: Column | str) -> Column:
    pairs = [x for lang, ws in lists.items() for x in (F.lit(lang), F.array(*[F.lit(w) for w in ws]).cast("array<string>"))]
    return F.try_element_at(F.create_map(*pairs), col(language))


def _stop_words(w: Column, language: Column | str) -> Column:
    """Entries are counted as often as the list has them: by the set of words, its part on the list, and for each further
    time its part on the entries that are listed so often."""
    most = max(ws.count(x) for ws in STOP_WORDS.values() for x in ws)
    listed = [_by_language({lang: sorted({x for x in ws if ws.count(x) > n}) for lang, ws in STOP_WORDS.items()}, language) for n in range(most)]
    hits = let(F.transform(w, F.lower), lambda own: sum((F.size(F.array_intersect(own, ws)) for ws in listed[1:]), F.size(F.array_intersect(own, listed[0]))))
    return F.when(listed[0].isNull(), 1.0).when(hits >= 2, 1.0).otherwise(0.0)


def _duplicate_share(chunks: Column) -> Column:
    whole = total_bytes(chunks)
    return _or_zero(ratio(whole - total_bytes(F.array_distinct(chunks)), whole))


def _chunks(parts: Column) -> Column:
    return F.filter(F.transform(parts, trim), lambda x: x != "")


def _sentences(text: Column | str) -> Column:
    t = F.translate(col(text), MARK, "")
    return _chunks(F.split(F.regexp_replace(t, "([.!?;:])([ \\t\\n\\f\\r])", "$1" + MARK + "$2"), MARK))


def _paragraphs(text: Column | str) -> Column:
    return _chunks(F.split(col(text), "\n\n"))


def frac_duplicate_sentences(text: Column | str) -> Column:
    """Share of the bytes of sentences, cut after . ! ? ; : before ASCII white space, that repeat an earlier one."""
    return _duplicate_share(_sentences(text))


def frac_duplicate_paragraphs(text: Column | str) -> Column:
    """The same of paragraphs, which an empty line separates."""
    return _duplicate_share(_paragraphs(text))


def with_metrics(docs: DataFrame, text: str = "text", language: str = "language", into: str = "gopher") -> DataFrame:
    """Adds a struct of all metrics. Words, lines, sentences and paragraphs are made once, in a projection of their own,
    and every metric reads them.

    Null text: counts are null and shares 0; a null language has no list. Other columns stay, whatever their names, but for
    ``into``, which is replaced."""
    own = {n: f"__lexmill_{n}" for n in ("words", "lines", "sentences", "paragraphs")}
    parts = docs.withColumns({own["words"]: words(text), own["lines"]: lines(text), own["sentences"]: _sentences(text), own["paragraphs"]: _paragraphs(text)})
    w, ls = F.col(own["words"]), F.col(own["lines"])
    found = {
        "mean_word_length": _mean_bytes(w),
        "frac_words_with_alpha": _share(w, _has_alpha),
        "frac_lines_end_punctuation": _share(ls, _ends_in_punctuation),
        "frac_lines_start_bullet": _share(ls, _starts_with_bullet),
        "frac_alphabetic_chars": frac_alphabetic_chars(text),
        "has_stop_words": _stop_words(w, language),
        "frac_duplicate_sentences": _duplicate_share(F.col(own["sentences"])),
        "frac_duplicate_paragraphs": _duplicate_share(F.col(own["paragraphs"])),
    }
    return parts.withColumn(into, F.struct(*[c.alias(n) for n, c in found.items()])).drop(*own.values())


def rules(metrics: dict[str, Column], config: GateConfig = GateConfig()) -> list[tuple[str, Column]]:
    """(name, rejects) in the order in which they are tried."""
    m, c = metrics, config
    found = [
        ("mean_word_length_low", m["mean_word_length"] < c.min_mean_word_length),
        ("mean_word_length_high", m["mean_word_length"] > c.max_mean_word_length),
        ("words_with_alpha", m["frac_words_with_alpha"] < c.min_frac_words_with_alpha),
        ("end_punctuation", m["frac_lines_end_punctuation"] < c.min_frac_lines_end_punctuation),
        ("bullets", m["frac_lines_start_bullet"] > c.max_frac_lines_start_bullet),
        ("alphabetic_chars", m["frac_alphabetic_chars"] < c.min_frac_alphabetic_chars),
    ]
    if c.require_stop_words:
        found.append(("stop_words", m["has_stop_words"] < 0.5))
    return [
        *found,
        ("duplicate_sentences", m["frac_duplicate_sentences"] > c.max_frac_duplicate_sentences),
        ("duplicate_paragraphs", m["frac_duplicate_paragraphs"] > c.max_frac_duplicate_paragraphs),
    ]


def first_failed_rule(metrics: dict[str, Column], config: GateConfig = GateConfig()) -> Column:
    """Name of the first rule that rejects; null where the document passes."""
    (name, rejects), *rest = rules(metrics, config)
    out = F.when(rejects, name)
    for name, rejects in rest:
        out = out.when(rejects, name)
    return out
