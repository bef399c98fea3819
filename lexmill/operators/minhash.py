"""MinHash-LSH near-duplicates with greedy, order-dependent decisions.

A document goes when it shares a band of its signature with an earlier document that stays. That is the
lexicographically first maximal independent set of the collision graph; it is found in rounds on the bucket table, never
on pairs: a document goes if one of its buckets holds an earlier one that stays, and stays if it is the first undecided
one in all its buckets. Each round settles at least the first undecided document of every bucket chain.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batches import slices
from ..functions.text import col
from ..storage import stored

OFFSET = 0xCBF29CE484222325
PRIME = 0x100000001B3
#: Hashes of a text that are looked up for a value, 1 to 4 times so many.
LOW_HASHES = 24.0
_ROW_BITS, _SLICE_BYTES = 19, 8 << 20


def fnv1a(data: bytes, state: int = OFFSET) -> int:
    for b in data:
        state = ((state ^ b) * PRIME) & 0xFFFFFFFFFFFFFFFF
    return state


def seeds(num_perm: int) -> np.ndarray:
    return np.array([fnv1a(i.to_bytes(8, "little")) for i in range(num_perm)], np.uint64)


def signature_of(data: bytes, num_perm: int = 128, ngram: int = 5) -> np.ndarray:
    """Least seeded FNV-1a hash over all byte n-grams for each seed; all ones for shorter data."""
    out = np.full(num_perm, 0xFFFFFFFFFFFFFFFF, np.uint64)
    if len(data) < ngram:
        return out
    view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), ngram)
    if ngram <= 8:  # repeated n-grams hash once
        packed = np.zeros(len(view), np.uint64)
        for j in range(ngram):
            packed = (packed << np.uint64(8)) | view[:, j].astype(np.uint64)
        grams = np.unique(packed)
        columns = [(grams >> np.uint64(8 * (ngram - 1 - j))) & np.uint64(0xFF) for j in range(ngram)]
    else:
        columns = [view[:, j].astype(np.uint64) for j in range(ngram)]
    start = seeds(num_perm)
    for s in range(0, len(columns[0]), 4096):
        state = np.repeat(start[:, None], len(columns[0][s : s + 4096]), 1)
        for c in columns:
            state = (state ^ c[s : s + 4096]) * np.uint64(PRIME)
        np.minimum(out, state.min(1), out=out)
    return out


def _changes(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], x[1:] != x[:-1]])


def signatures_of(data: np.ndarray, ends: np.ndarray, num_perm: int = 128, ngram: int = 5) -> np.ndarray:
    """The signatures of many texts, up to 2**19, in one buffer; ``ends`` has 0 and the end of each.

    Each distinct n-gram is hashed once for a seed. Its texts are looked up only where the hash is so low that a text of their
    size should have some ``LOW_HASHES`` such; a text that has none is hashed by itself, so that the values are exact."""
    n, last = len(ends) - 1, np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((num_perm, n), last, np.uint64)
    if ngram > 5:  # gram, row and size share 64 bits
        return np.stack([signature_of(data[a:b].tobytes(), num_perm, ngram) for a, b in zip(ends, ends[1:])]) if n else out.T
    m = len(data) - ngram + 1
    if m <= 0:
        return out.T
    shift, low = np.uint64(_ROW_BITS), np.uint64((1 << _ROW_BITS) - 1)
    key = np.repeat(np.arange(n, dtype=np.uint64), np.diff(ends))[:m]
    for s in range(0, m, 1 << 14):
        part = np.zeros(min(m - s, 1 << 14), np.uint64)
        for j in range(ngram):
            part = part << np.uint64(8) | data[s + j : s + j + len(part)]
        key[s : s + len(part)] |= part << shift
    inside = np.ones(m, bool)
    for j in range(1, ngram):  # windows that reach into the next text
        at = ends[1:] - j
        inside[at[(at >= 0) & (at < m)]] = False
    key = key[inside]
    if not len(key):
        return out.T
    key.sort()
    key = key[_changes(key)]
    row = (key & low).astype(np.int32)
    count = np.bincount(row, minlength=n)
    size = ((np.frexp(count)[1] - 1).clip(0) // 2).astype(np.uint64)  # powers of four
    grams = key >> shift
    grams = grams[_changes(grams)]
    levels, node = [], grams  # distinct beginnings of each length: last byte, and place of what is before it
    for _ in range(ngram):
        new = _changes(node >> np.uint64(8))
        levels.insert(0, (node & np.uint64(255), np.cumsum(new) - 1))
        node = (node >> np.uint64(8))[new]
    key |= size[row] << np.uint64(_ROW_BITS + 8 * ngram)
    del row
    key.sort()
    group = key >> shift
    start = np.flatnonzero(_changes(group))
    group = group[start]
    row, rows = (key & low).astype(np.int32), np.diff(start, append=len(key))
    del key
    of = np.searchsorted(grams, group & np.uint64((1 << 8 * ngram) - 1))
    share = LOW_HASHES / 4.0 ** np.arange(16)
    bounds = np.searchsorted(group >> np.uint64(8 * ngram), np.arange(17, dtype=np.uint64))
    parts = [(c, a, b) for c, (a, b) in enumerate(zip(bounds, bounds[1:])) if a < b]
    for i, seed in enumerate(seeds(num_perm)):
        state = np.array([seed])
        for byte, before in levels:
            state = state.take(before)
            state ^= byte
            state *= np.uint64(PRIME)
        state = state.take(of)
        at = np.concatenate([np.arange(a, b) if share[c] >= 1 else a + np.flatnonzero(state[a:b] < np.uint64(int(share[c] * 2**64))) for c, a, b in parts])
        k = rows[at]
        where = np.repeat(start[at] - np.cumsum(k) + k, k)
        where += np.arange(len(where))
        np.minimum.at(out[i], row[where], np.repeat(state[at], k))
    for x in np.flatnonzero((out == last).any(0) & (count > 0)):
        out[:, x] = signature_of(data[ends[x] : ends[x + 1]].tobytes(), num_perm, ngram)
    return out.T


def signature(text: Column | str, num_perm: int = 128, ngram: int = 5) -> Column:
    """The signature as 64-bit patterns; the sign means nothing."""

    @F.arrow_udf("array<long>")
    def run(s: pa.Array) -> pa.Array:
        parts = []
        for part in slices(s, _SLICE_BYTES, 1 << _ROW_BITS):
            texts = pc.fill_null(part, "").cast(pa.large_binary())
            texts = pa.concat_arrays([texts])  # its buffers may be those of all of the batch
            ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
            found = np.ascontiguousarray(signatures_of(data, ends - ends[0], num_perm, ngram)).view(np.int64)
            parts.append(pa.ListArray.from_arrays(np.arange(0, found.size + 1, num_perm, dtype=np.int32), found.ravel()))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))

    return run(col(text))


@lru_cache
def bands_and_rows(threshold: float, num_perm: int) -> tuple[int, int]:
    """Bands and rows for which false positives and false negatives around the threshold are equally small in sum."""

    def area(f, a, b, n=1000):
        if b <= a:
            return 0.0
        x = a + (np.arange(n) + 0.5) * (b - a) / n
        return float(np.sum(f(x)) * (b - a) / n)

    best = (float("inf"), 1, 1)
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            positive = area(lambda s: 1 - (1 - s**r) ** b, 0.0, threshold)
            negative = area(lambda s: (1 - s**r) ** b, threshold, 1.0)
            best = min(best, (0.5 * positive + 0.5 * negative, b, r))
    return best[1], best[2]


def band_keys(signature_: Column | str, threshold: float = 0.8, num_perm: int = 128) -> Column:
    """Hash of each band of a signature."""
    b, r = bands_and_rows(threshold, num_perm)
    s = col(signature_)
    return F.array(*[F.xxhash64(F.lit(i), F.slice(s, 1 + i * r, r)) for i in range(b)])


def near_duplicate_ids(docs: DataFrame, threshold: float = 0.8, num_perm: int = 128, ngram: int = 5, scope: str = "group_idx", order: str = "record_idx") -> DataFrame:
    """(scope, ord) of the documents that go.

    Null texts, and those of fewer than ``ngram`` bytes, have one signature, so that all but the first of a scope go; rows that repeat a
    document share its place and its fate; documents without an order take no part; an empty table gives no rows."""
    bands, rows = bands_and_rows(threshold, num_perm)  # values beyond the bands are not made
    keyed = docs.select(F.col(scope).alias("scope"), F.col(order).alias("ord"), band_keys(signature("text", bands * rows, ngram), threshold, num_perm).alias("keys"))
    buckets = stored(keyed.select("scope", "ord", F.posexplode("keys").alias("band", "key")), "minhash-buckets")
    shared = buckets.groupBy("scope", "band", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    # documents alone in all their buckets stay, and hold nobody back
    open_ = stored(buckets.join(shared, ["scope", "band", "key"]).select("scope", "ord", F.xxhash64("band", "key").alias("bucket")), "minhash-open")
    gone = None
    while not open_.isEmpty():
        first = open_.groupBy("scope", "bucket").agg(F.min("ord").alias("first"))
        stays = open_.join(first, ["scope", "bucket"]).groupBy("scope", "ord").agg(F.min((F.col("ord") == F.col("first")).cast("int")).alias("all")).where("all = 1").select("scope", "ord")
        stays = stored(stays, "minhash-stays")
        taken = open_.join(stays, ["scope", "ord"], "left_semi").groupBy("scope", "bucket").agg(F.min("ord").alias("stay"))
        goes = stored(open_.join(taken, ["scope", "bucket"]).where("ord > stay").select("scope", "ord").distinct(), "minhash-goes")
        gone = goes if gone is None else gone.unionByName(goes)
        open_ = stored(open_.join(stays.unionByName(goes), ["scope", "ord"], "left_anti"), "minhash-open")
    return gone if gone is not None else docs.select(F.col(scope).alias("scope"), F.col(order).alias("ord")).limit(0)


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8, num_perm: int = 128, ngram: int = 5, scope: str = "group_idx", order: str = "record_idx") -> DataFrame:
    """The documents that stay. (scope, order) must identify a document."""
    gone = near_duplicate_ids(docs, threshold, num_perm, ngram, scope, order).withColumnsRenamed({"scope": "__scope", "ord": "__ord"})
    return docs.join(gone, F.col(scope).eqNullSafe(F.col("__scope")) & (F.col(order) == F.col("__ord")), "left_anti")
