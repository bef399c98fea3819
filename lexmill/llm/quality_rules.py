"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths, computed in numpy over whole texts, mark the words that lie in
an n-gram occurring at least twice in the same document; the rules bound the share of the document's
characters inside such n-grams and inside repeated lines. One scan, no shuffle.

Words are runs of characters other than ASCII white space; characters are Unicode code points and white
space is not counted. Lines are split at newlines; blank lines count for nothing. A character inside
several overlapping n-grams counts once.

Defined results: a null or blank text has 0 words and every share 0.0, and is rejected by ``min_words``;
a null doc_id stays null; repeated rows each get their row; columns other than doc_id and text are left
out of the metrics and kept, untouched, by ``keep_documents``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text
from .kernels import mix, pieces, repeated, span_hashes, tokens, utf8, windows, U

#: Largest share of characters inside repeated n-grams of each length.
MAX_NGRAM = {2: 0.70, 3: 0.50, 5: 0.25, 7: 0.21, 10: 0.18}
MAX_LINE = 0.30
MIN_WORDS = 1


def _code_points(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def _lines(data: np.ndarray, offsets: np.ndarray):
    inside = np.ones(256, bool)
    inside[10] = False
    return tokens(data, offsets, inside)


def coverage(data: np.ndarray, offsets: np.ndarray, lengths: list[int]) -> dict[str, np.ndarray]:
    """Counts and shares for each row of a text buffer."""
    n = len(offsets) - 1
    upto = _code_points(data)
    start, end, row = tokens(data, offsets)
    size = upto[end] - upto[start]
    chars = np.bincount(row, size, n)
    salt = mix(np.arange(n, dtype=U))
    word = span_hashes(data, start, end)
    out = {"n_words": np.bincount(row, minlength=n), "n_chars_words": chars.astype(np.int64)}
    alive = np.ones(len(word), bool)
    for k in sorted(lengths):  # an n-gram can only repeat where the shorter one before it does
        hashed, first = windows(word, row, k)
        hashed, first = hashed[alive[first]], first[alive[first]]
        again = first[repeated(hashed ^ salt[row[first]])]
        alive[:] = False
        alive[again] = True
        step = np.zeros(len(word) + 1, np.int64)
        step[again] += 1
        np.add.at(step, again + k, -1)
        held = np.bincount(row, size * (np.cumsum(step)[:-1] > 0), n) if len(word) else np.zeros(n)
        out[f"dup_{k}gram_frac"] = np.divide(held, chars, out=np.zeros(n), where=chars > 0)
    ls, le, lrow = _lines(data, offsets)
    in_line = upto[le] - upto[ls]
    line_hash = span_hashes(data, ls, le) ^ salt[lrow]
    some = np.isin(np.arange(len(ls)), np.searchsorted(ls, start, "right") - 1)  # lines that hold a word
    ls, lrow, in_line, line_hash = ls[some], lrow[some], in_line[some], line_hash[some]
    total = np.bincount(lrow, in_line, n)
    held = np.bincount(lrow, in_line * repeated(line_hash), n)
    out["dup_line_frac"] = np.divide(held, total, out=np.zeros(n), where=total > 0)
    return out


def passes(found: dict[str, np.ndarray], limits: dict[int, float], max_line: float, min_words: int) -> np.ndarray:
    keep = (found["n_words"] >= min_words) & (found["dup_line_frac"] <= max_line)
    for k, most in limits.items():
        keep &= found[f"dup_{k}gram_frac"] <= most
    return keep


def metrics(docs: DataFrame, ngrams: dict[int, float] | None = None, max_line: float = MAX_LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_words, n_chars_words, dup_*gram_frac.., dup_line_frac, keep), one row per document."""
    limits = dict(sorted((MAX_NGRAM if ngrams is None else ngrams).items()))
    schema = "doc_id long, n_words long, n_chars_words long, " + ", ".join(f"dup_{k}gram_frac double" for k in limits) + ", dup_line_frac double, keep boolean"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = coverage(*utf8(piece.column("text")), list(limits))
                keep = passes(found, limits, max_line, min_words)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, found.values()), pa.array(keep)], names=["doc_id", *found, "keep"])

    return id_text(docs).mapInArrow(score, schema)


def keep_documents(docs: DataFrame, ngrams: dict[int, float] | None = None, max_line: float = MAX_LINE, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows that pass every rule, with all their columns; the decision is made in the scan, so texts never shuffle."""
    limits = dict(sorted((MAX_NGRAM if ngrams is None else ngrams).items()))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                found = coverage(*utf8(piece.column("text")), list(limits))
                yield piece.filter(pa.array(passes(found, limits, max_line, min_words)))

    return docs.mapInArrow(keep, docs.schema)


def sql(ngrams: dict[int, float] | None = None, max_line: float = MAX_LINE, min_words: int = MIN_WORDS) -> str:
    """The same metrics in DuckDB, by listing the n-grams themselves."""
    limits = dict(sorted((MAX_NGRAM if ngrams is None else ngrams).items()))
    parts, joins, columns, keep = [], [], [], [f"n_words >= {min_words}", f"dup_line_frac <= {max_line}"]
    for k, most in limits.items():
        gram = " || chr(10) || ".join(f"list_extract(ws, p + {i})" for i in range(k))
        parts.append(
            f"g{k} AS (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM (SELECT r, p, {gram} AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - {k - 2})) AS p FROM d))), "
            f"c{k} AS (SELECT r, sum(length(list_extract(ws, i))) AS held FROM (SELECT DISTINCT r, unnest(range(p, p + {k})) AS i FROM g{k} WHERE c > 1) JOIN d USING (r) GROUP BY r)"
        )
        joins.append(f"LEFT JOIN c{k} ON c{k}.r = d.r")
        columns.append(f"CASE WHEN ch > 0 THEN coalesce(c{k}.held, 0)::DOUBLE / ch ELSE 0.0 END AS dup_{k}gram_frac")
        keep.append(f"dup_{k}gram_frac <= {most}")
    return (
        "WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM documents), "
        "n AS (SELECT r, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS ch FROM d), "
        "l AS (SELECT r, sum(length(x)) AS total, sum(CASE WHEN c > 1 THEN length(x) ELSE 0 END) AS held FROM (SELECT r, x, count(*) OVER (PARTITION BY r, x) AS c FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) GROUP BY r), "
        + ", ".join(parts)
        + ", m AS (SELECT d.doc_id, n.n_words, n.ch AS n_chars_words, "
        + ", ".join(columns)
        + ", CASE WHEN l.total > 0 THEN l.held::DOUBLE / l.total ELSE 0.0 END AS dup_line_frac FROM d JOIN n ON n.r = d.r LEFT JOIN l ON l.r = d.r "
        + " ".join(joins)
        + ") SELECT *, " + " AND ".join(keep) + " AS keep FROM m"
    )
