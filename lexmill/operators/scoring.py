"""Classifier scores: line-weighted document annotation, language identification and per-language models.

A model is anything with ``labels()`` and ``predict(list of lines) -> list of {label: probability}``. Models come by a loader
that runs once per Python worker and language, so that no executor holds more than it needs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batches import slices
from ..functions.stop_words import STOP_WORDS
from ..functions.text import col, flatten_newlines, let, round2_single, round3, single, words


class TextClassifier(Protocol):
    def labels(self) -> list[str]: ...

    def predict(self, texts: list[str]) -> list[dict[str, float]]: ...


def lexical_scores(text: Column | str, languages: list[str] | None = None) -> Column:
    """Share of words that are common words of each language, as a map; native, for tests and small vocabularies."""
    own = words(F.lower(flatten_newlines(text)))

    def share(ws: Column, lang: str) -> Column:
        hits = F.size(F.filter(ws, lambda w: w.isin(sorted(set(STOP_WORDS[lang])))))
        return single(F.coalesce(F.try_divide(hits.cast("double"), F.size(ws).cast("double")), F.lit(0.0)))

    return let(own, lambda ws: F.create_map(*[x for lang in sorted(languages or STOP_WORDS) for x in (F.lit(lang), share(ws, lang))]))


def top_label(scores: Column | str) -> Column:
    """(label, score) of the highest score; among equals the first label in alphabetical order."""
    entries = F.transform(F.map_entries(col(scores)), lambda e: F.struct((-e["value"]).alias("low"), e["key"].alias("label")))
    best = F.array_min(entries)
    return F.struct(best["label"].alias("label"), (-best["low"]).alias("score"))


def identify_language(docs: DataFrame, load: Callable[[], TextClassifier], text: str = "text") -> DataFrame:
    """Adds ``lid_label`` and ``lid_score``: the best label, without prefix, of the text on one line."""
    kept: dict[str, TextClassifier] = {}

    @F.pandas_udf("struct<label string, score double>")
    def best(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if "model" not in kept:
            kept["model"] = load()
        for part in parts:
            found = [max(p.items(), key=lambda kv: kv[1]) if p else (None, None) for p in kept["model"].predict(part.fillna("").tolist())]
            yield pd.DataFrame({"label": [x[0].removeprefix("__label__") if x[0] else None for x in found], "score": [x[1] for x in found]})

    return docs.withColumn("__best", best(flatten_newlines(text))).withColumns({"lid_label": F.col("__best.label"), "lid_score": F.col("__best.score")}).drop("__best")


def line_means(load: Callable[[str], TextClassifier], language: Column, text: Column) -> Column:
    """(labels, means) of a document: the mean over its lines that are not empty of the probability of each label, weighted by
    the bytes of the line with its newline. Rows come with languages together where they are sorted, so that a
    worker holds one model at a time; lines and their scores are held for a slice of a batch."""
    held: dict[str | None, TextClassifier] = {}

    def score(lang: str | None, texts: list) -> list[dict]:
        if lang not in held:
            held.clear()
            held[lang] = load(lang)
        rows = [[line + "\n" for line in (t or "").split("\n") if line] for t in texts]
        found = iter(held[lang].predict([line for own in rows for line in own]))
        out = []
        for own in rows:
            total: dict[str, float] = {}
            whole = 0
            for line in own:
                n = len(line.encode())
                whole += n
                for label, p in next(found).items():
                    total[label] = total.get(label, 0.0) + float(np.float32(p)) * n
            labels = sorted(total)
            out.append({"labels": [x.removeprefix("__label__") for x in labels], "means": [total[x] / whole for x in labels]})
        return out

    kind = pa.struct([("labels", pa.list_(pa.string())), ("means", pa.list_(pa.float64()))])

    @F.arrow_udf("struct<labels array<string>, means array<double>>")
    def run(parts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for langs, texts in parts:
            done, at = [], 0
            for part in slices(texts):
                own = langs.slice(at, len(part)).to_pylist()
                at += len(part)
                rows, out = part.to_pylist(), [None] * len(part)
                for lang in dict.fromkeys(own):
                    where = [i for i, x in enumerate(own) if x == lang]
                    for i, x in zip(where, score(lang, [rows[i] for i in where])):
                        out[i] = x
                done.append(pa.array(out, kind))
            yield pa.concat_arrays(done) if done else pa.array([], kind)

    return run(language, text)


def with_scores(docs: DataFrame, load: Callable[[str], TextClassifier], supported: list[str] | None = None, prefix: str = "", language: str = "language", text: str = "text") -> DataFrame:
    """Merges the weighted scores, to two decimals in single precision and then to three, under their labels with a prefix, into
    ``scores``. A language that is not supported is an error.

    Documents are scored whole, where they are: rows are sorted by language within their partition, nothing is exchanged. Null and empty
    texts and texts of newlines have no lines and get no new scores; null scores count as none; repeated rows each get theirs; other
    columns pass through."""
    lang = F.col(language) if language in docs.columns else F.lit(None).cast("string")
    if supported is not None:
        lang = F.when(lang.isin(supported), lang).otherwise(F.raise_error(F.concat(F.lit("unsupported language "), F.coalesce(lang, F.lit("null")))))
    if language in docs.columns:
        docs = docs.sortWithinPartitions(language)
    found = docs.withColumn("__lexmill_found", line_means(load, lang, F.col(text)))
    names = F.transform("__lexmill_found.labels", lambda k: F.concat(F.lit(prefix), k))
    new = F.map_from_arrays(names, F.transform("__lexmill_found.means", lambda v: round3(round2_single(v))))
    old = F.coalesce(F.col("scores"), F.create_map().cast("map<string,double>")) if "scores" in docs.columns else F.create_map().cast("map<string,double>")
    fresh = F.map_filter(old, lambda k, _: ~F.coalesce(F.array_contains(names, k), F.lit(False)))
    return found.withColumn("scores", F.map_concat(fresh, new)).drop("__lexmill_found")


class LogisticLines:
    """Hashed-word logistic model: the trainable stand-in for published classifiers."""

    def __init__(self, names: list[str], weights, bias, cells: int):
        self.names, self.weights, self.bias, self.cells = names, weights, bias, cells

    def labels(self) -> list[str]:
        return self.names

    def predict(self, texts: list[str]) -> list[dict[str, float]]:
        out = []
        for t in texts:
            cells = [hash_word(w, self.cells) for w in t.split()]
            z = self.bias + (self.weights[:, cells].mean(1) if cells else 0)
            p = np.exp(z - z.max())
            out.append(dict(zip(self.names, (p / p.sum()).tolist())))
        return out


def hash_word(word: str, cells: int) -> int:
    import zlib

    return zlib.crc32(word.encode()) % cells


def train_classifier(rows: pd.DataFrame, cells: int = 1 << 14, rounds: int = 60, rate: float = 4.0) -> LogisticLines:
    """Fits labels to texts (columns ``text`` and ``label``) by full-batch gradient steps; rows are a bounded sample."""
    names = sorted(rows["label"].unique())
    y = np.eye(len(names))[[names.index(x) for x in rows["label"]]]
    docs = [np.array([hash_word(w, cells) for w in t.split()], np.int64) for t in rows["text"]]
    size = np.array([max(1, len(d)) for d in docs])
    owner, cell = np.repeat(np.arange(len(docs)), [len(d) for d in docs]), np.concatenate(docs) if docs else np.zeros(0, np.int64)
    share = 1.0 / size[owner]
    w, b = np.zeros((len(names), cells)), np.zeros(len(names))
    for _ in range(rounds):
        z = np.stack([np.bincount(owner, w[k, cell] * share, len(docs)) for k in range(len(names))], 1) + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (y - p) / len(docs)
        for k in range(len(names)):
            w[k] += rate * cells**0.5 * np.bincount(cell, g[owner, k] * share, cells)
        b += rate * g.sum(0)
    return LogisticLines([f"__label__{n}" for n in names], w, b, cells)
