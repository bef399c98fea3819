"""Scalar text metrics outside the gate."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .batches import mapped
from .text import col, ratio, round2_single, single, total_bytes, words

_MIX = np.uint64(0x9E3779B97F4A7C15)
_NUMBER_OR_PUNCTUATION = r"[\p{N}!-/:-@\[-`{-~]"


def _repeated_windows(data: bytes, n: int, first: int, last: int) -> int:
    """Windows of n bytes starting in [first, last) that equal an earlier one in that range.

    A window whose hash occurs once equals no other; the others are compared as columns of eight bytes."""
    if last - first <= 1:
        return 0
    whole, width = np.frombuffer(data, np.uint8)[first : last + n - 1].astype(np.uint64), 1
    while width * 2 <= min(n, 8):  # words of 2, 4, 8 bytes at every place
        whole = whole[:-width] << np.uint64(8 * width) | whole[width:]
        width *= 2
    places = [*range(0, n - width, width), n - width]  # the last may overlap
    size = last - first
    hashed = np.zeros(size, np.uint64)
    for at in places:
        hashed = (hashed ^ whole[at : at + size]) * _MIX
        hashed ^= hashed >> np.uint64(29)
    ordered = np.sort(hashed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    found = np.searchsorted(twice, hashed)
    own = np.flatnonzero(twice[np.minimum(found, len(twice) - 1)] == hashed)
    parts = [whole[own + at] for at in places]
    order = np.argsort(hashed[own])  # equal windows are next to each other, but for those that share a hash
    new = np.zeros(len(own) - 1, bool)
    for part in parts:
        new |= part[order[1:]] != part[order[:-1]]
    if (new & (hashed[own][order[1:]] == hashed[own][order[:-1]])).any():
        order = np.lexsort(parts)
        new[:] = False
        for part in parts:
            new |= part[order[1:]] != part[order[:-1]]
    return int(len(new) - new.sum())


def repetitions(text: Column | str, n: int = 20) -> Column:
    """Repeated windows of n bytes, the first window of the text left out, per byte of text; 0 up to n bytes.

    Exact: windows are compared by content."""

    def one(t: str) -> float:
        data = t.encode()
        return 0.0 if len(data) <= n else float(np.float32(_repeated_windows(data, n, 1, len(data) - n + 1)) / np.float32(len(data)))

    @F.arrow_udf("double")
    def run(s: pa.Array) -> pa.Array:
        return mapped(s, one, pa.float64())

    return run(col(text))


def repetition_count(text: Column | str, n: int = 20) -> Column:
    """How many windows of n bytes, the last window of the text left out, occur earlier in it."""

    def one(t: str) -> int:
        data = t.encode()
        return _repeated_windows(data, n, 0, len(data) - n) if len(data) > n else 0

    @F.arrow_udf("long")
    def run(s: pa.Array) -> pa.Array:
        return mapped(s, one, pa.int64())

    return run(col(text))


def long_words(text: Column | str, min_bytes: int = 15) -> Column:
    """Bytes of words of at least so many bytes, per byte of text; 0 for empty text."""
    t = col(text)
    return F.coalesce(ratio(total_bytes(F.filter(words(t), lambda w: F.octet_length(w) >= min_bytes)), F.octet_length(t)), F.when(t.isNotNull(), 0.0))


def text_stats(text: Column | str) -> Column:
    """Counts of a document: words, words over 15 bytes, bytes of words, mean word bytes, characters, and characters
    that are numeric or ASCII punctuation."""
    t = col(text)
    w = words(t)
    n, whole = F.size(w).cast("long"), total_bytes(w)
    return F.struct(
        n.alias("n_words"),
        F.size(F.filter(w, lambda x: F.octet_length(x) > 15)).cast("long").alias("n_long_words"),
        whole.alias("total_length"),
        F.floor(whole / F.greatest(n, F.lit(1))).cast("long").alias("avg_length"),
        F.length(t).cast("long").alias("n_chars"),
        F.regexp_count(t, F.lit(_NUMBER_OR_PUNCTUATION)).cast("long").alias("n_numpunc"),
    )


def long_word_share(text: Column | str) -> Column:
    """Words over 15 bytes per word, two decimals; null without words."""
    w = words(text)
    return round2_single(F.try_divide(F.size(F.filter(w, lambda x: F.octet_length(x) > 15)).cast("double"), F.size(w).cast("double")))


def numpunc_share(text: Column | str) -> Column:
    """Characters that are numeric or ASCII punctuation per character, two decimals; null for empty text."""
    t = col(text)
    return round2_single(F.try_divide(F.regexp_count(t, F.lit(_NUMBER_OR_PUNCTUATION)).cast("double"), F.length(t).cast("double")))


def numeric_share(text: Column | str) -> Column:
    """Numeric characters per character; null for empty text."""
    t = col(text)
    return single(F.try_divide(F.regexp_count(t, F.lit(r"\p{N}")).cast("double"), F.length(t).cast("double")))
