"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts of up to three bytes. A byte is coded in its longest known context; if it was
never seen there, an escape (method C: as likely as the number of different bytes seen in the context) leads to the
next shorter context, in which the bytes of the longer one are excluded, down to a uniform code over the bytes never
seen at all. A document's code length in bits is the sum over its bytes; contexts start with zero bytes at
its beginning.

Pretrained: all documents are counted, in two folds by a hash of doc_id, and each fold is scored with the
trie of the other, so that no document is judged by its own bytes and escapes stay honest. Only 4-byte counts are
gathered, combined in every task first; shorter contexts follow from them. Exclusion needs no walk: the bytes seen
in a context are always seen in its suffix too, so each context carries the count that its own bytes take away from
the next shorter one, and costs are looked up by whole arrays of 4-byte keys.

Above the trie stands one long context, the LONG words before a word. Where the table has these words followed by the same
word at least twice, the word is known to the model of the whole corpus and its bytes cost nothing further; whether it is so is
told by a flag for every word that has LONG words before it, and the flags of a document are coded adaptively, by the rule of succession:
log2((n + 1) * (n choose k)) bits for k known ones of n. So a document that occurs twice costs hardly more than a few bits, and one
that quotes others costs less. The LONG + 1 words are counted over the whole table by hash in a packed exchange (5 bytes a word),
which grows with the input; what the trie gathers levels off, as there are only so many contexts of three bytes.

The trie goes to the executors by broadcast up to MODEL_BYTES. A larger one is cut by the last context byte, to
which all longer contexts of a key belong, and the documents are scanned once per part; the sums are the same.

Adaptive: each document is coded with a trie that starts empty and learns as it goes; plain Python, for small inputs.

Defined results: null and empty texts have 0 bytes, 0.0 bits and a null rate; where the other fold is empty every byte
costs 8 bits; a null doc_id is reported as null; repeated rows give repeated rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, stored
from .kernels import pieces, row_starts, tokens, utf8
from .substring_dedup import repeated_features, window_features

FOLDS = 2
ORDER = 3
LONG = 8
MODEL_BYTES = 256 << 20
_MASK = {3: 0xFFFFFFFF, 2: 0xFFFFFF, 1: 0xFFFF, 0: 0xFF}


def keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte the key (third, second, last byte before it, the byte), zero before the start of its row."""
    n = len(data)
    place = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
    out = data.astype(np.uint32)
    for back in (1, 2, 3):
        before = np.zeros(n, np.uint32)
        before[back:] = data[: max(0, n - back)]
        before[place < back] = 0
        out |= before << np.uint32(8 * back)
    return out


def _summed(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, at = np.unique(key, return_inverse=True)
    return known, np.bincount(at, count, len(known)).astype(np.int64)


class Trie:
    """Counts by context order, and costs of 4-byte keys.

    ``key`` and ``count`` hold the 4-byte counts of all keys whose last context byte is wanted; ``symbols`` the counts
    of single bytes over everything.
    """

    def __init__(self, key: np.ndarray, count: np.ndarray, symbols: np.ndarray):
        key, count = key.astype(np.uint32), count.astype(np.int64)
        order = np.argsort(key)
        self.symbol, self.context = {3: (key[order], count[order])}, {}
        for o in (2, 1):
            self.symbol[o] = _summed(self.symbol[o + 1][0] & np.uint32(_MASK[o]), self.symbol[o + 1][1])
        seen = np.flatnonzero(symbols)
        self.symbol[0] = seen.astype(np.uint32), symbols[seen].astype(np.int64)
        for o in (3, 2, 1, 0):
            k, n = self.symbol[o]
            lower = self._count(o - 1, k)[0] if o else np.zeros(len(k), np.int64)
            known, at = np.unique(k >> np.uint32(8), return_inverse=True)
            sums = [np.bincount(at, x, len(known)).astype(np.int64) for x in (n, np.ones(len(k)), lower)]
            self.context[o] = (known, *sums)

    @staticmethod
    def _find(table: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
        at = np.minimum(np.searchsorted(table, x), len(table) - 1)
        return at, table[at] == x

    def _count(self, order: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, n = self.symbol[order]
        at, known = self._find(k, key & np.uint32(_MASK[order]))
        return (np.where(known, n[at], 0) if len(n) else np.zeros(len(key), np.int64)), known

    def costs(self, key: np.ndarray) -> np.ndarray:
        """Bits of each 4-byte key."""
        bits = np.zeros(len(key))
        open_ = np.arange(len(key))
        gone, gone_kinds = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)  # what the longer context excludes
        for o in (3, 2, 1, 0):
            k = key[open_]
            known, total, kinds, lower = self.context[o]
            at, here = self._find(known, (k & np.uint32(_MASK[o])) >> np.uint32(8))
            if here.any():
                at, some = at[here], open_[here]
                n, hit = self._count(o, key[some])
                left, kinds_left = total[at] - gone[some], kinds[at] - gone_kinds[some]
                whole = (left + kinds_left).astype(float)
                share = np.where(hit, n, kinds_left) / np.maximum(whole, 1)
                bits[some] -= np.log2(np.where(share > 0, share, 1.0))
                gone[some], gone_kinds[some] = lower[at], kinds[at]
                done = np.zeros(len(key), bool)
                done[some[hit]] = True
                open_ = open_[~done[open_]]
        bits[open_] += np.log2(256 - len(self.symbol[0][0]))
        return bits


def _folded(docs: DataFrame) -> DataFrame:
    return id_text(docs).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))


def counts(docs: DataFrame) -> DataFrame:
    """(fold, last, keys, counts, symbols): packed counts of all 4-byte keys of the table by the last context byte."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.uint32), np.zeros(0, np.int64)) for _ in range(FOLDS)]
        for batch in batches:
            for fold in range(FOLDS):
                own = batch.filter(pa.array(batch.column("fold").to_numpy() == fold))
                for piece in pieces(own, most=8 << 20):
                    k, n = np.unique(keys(*utf8(piece.column("text"))), return_counts=True)
                    held[fold] = _summed(np.concatenate([held[fold][0], k]), np.concatenate([held[fold][1], n]))
        for fold, (k, n) in enumerate(held):
            last = (k >> np.uint32(8)) & np.uint32(0xFF)
            order = np.argsort(last, kind="stable")
            edges = np.searchsorted(last[order], np.arange(257))
            full = np.flatnonzero(np.diff(edges))
            parts = [order[edges[b] : edges[b + 1]] for b in full]
            yield pa.RecordBatch.from_arrays([pa.array([fold] * len(full), pa.int32()), pa.array(full, pa.int32()), pa.array([k[p].tobytes() for p in parts], pa.binary()), pa.array([n[p].tobytes() for p in parts], pa.binary())], names=["fold", "last", "keys", "counts"])

    def total(table: pa.Table) -> pa.Table:
        k = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint32)
        n = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.int64)
        k, n = _summed(k, n)
        symbols = np.bincount(k & np.uint32(0xFF), n, 256).astype(np.int64)
        return pa.table({"fold": table.column("fold")[:1], "last": table.column("last")[:1], "keys": pa.array([k.tobytes()], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary()), "symbols": pa.array([symbols.tobytes()], pa.binary())})

    schema = "fold int, last int, keys binary, counts binary"
    return _folded(docs).mapInArrow(count, schema).groupBy("fold", "last").applyInArrow(total, schema + ", symbols binary")


def flag_bits(n: int, k: int) -> float:
    """Bits of n flags of which k are set, by the rule of succession."""
    return log2(n + 1) + (lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)) / log(2) if n > 0 else 0.0


def score(docs: DataFrame, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """(doc_id, n_bytes, bits, bits_per_byte), one row per document, by the tries of the other fold and the long contexts of
    the table."""
    spark = docs.sparkSession
    model = stored(counts(docs), "ppm-counts")
    sizes = model.select("fold", "last", F.octet_length("keys").alias("b"), "symbols").collect()
    symbols = np.zeros((FOLDS, 256), np.int64)
    size = np.zeros(256, np.int64)
    for fold, last, b, packed in sizes:
        symbols[fold] += np.frombuffer(packed, np.int64)
        size[last] += 12 * (b // 4)
    parts: list[list[int]] = [[]]
    for last in range(256):  # consecutive last bytes, as many as fit
        if parts[-1] and size[parts[-1]].sum() + size[last] > model_bytes:
            parts.append([])
        parts[-1].append(last)
    known = repeated_features(docs, window_features(LONG + 1), hash_bytes=5).dropDuplicates(["doc_id", "text_hash"]).toDF("id", "hash", "at")
    folded, out = _folded(docs).withColumn("text_hash", F.xxhash64("text")), None
    folded = folded.join(known, F.col("doc_id").eqNullSafe(F.col("id")) & F.col("text_hash").eqNullSafe(F.col("hash")), "left").drop("id", "hash")
    if len(parts) > 1:
        folded = stored(folded, "ppm-documents")
    for turn, part in enumerate(parts):
        rows = model.where(F.col("last").isin(part)).select("fold", "keys", "counts").collect()
        tables = []
        for fold in range(FOLDS):
            own = [r for r in rows if r["fold"] == fold]
            tables.append((np.frombuffer(b"".join(r["keys"] for r in own), np.uint32), np.frombuffer(b"".join(r["counts"] for r in own), np.int64), symbols[fold]))
        scan = _scan(spark.sparkContext.broadcast(tables), None if len(parts) == 1 else np.isin(np.arange(256), part), turn == 0)
        one = folded.mapInArrow(scan, "doc_id long, text_hash long, n_bytes long, bits double")
        out = one if out is None else out.unionByName(one)
    if len(parts) > 1:  # every row was seen once per part
        copies = (F.count("*") / len(parts)).cast("int").alias("copies")
        out = out.groupBy("doc_id", "text_hash", "n_bytes").agg((F.sum("bits") * len(parts) / F.count("*")).alias("bits"), copies)
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return out.select("doc_id", "n_bytes", "bits", F.try_divide("bits", "n_bytes").alias("bits_per_byte"))


def known_bytes(at: pa.Array, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes lie in words that the long context knows, and the bits of each row's flags; ``at`` has the packed first
    words of the windows that occur again."""
    start, end, row = tokens(data, offsets)
    first = row_starts(row, len(offsets) - 1)
    rows = [np.frombuffer(x, np.int32).astype(np.int64) if x else np.zeros(0, np.int64) for x in at.to_pylist()]
    word = np.concatenate([first[i] + x + LONG for i, x in enumerate(rows)]) if rows else np.zeros(0, np.int64)
    step = np.zeros(len(data) + 1, np.int64)
    np.add.at(step, start[word], 1)
    np.add.at(step, end[word], -1)
    flags = np.array([flag_bits(int(n) - LONG, len(x)) for n, x in zip(np.diff(first), rows)])
    return np.cumsum(step[:-1]) > 0, flags


def _scan(shared, wanted: np.ndarray | None, flags: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [None] * FOLDS
        for batch in batches:
            for fold in range(FOLDS):
                own = batch.filter(pa.array(batch.column("fold").to_numpy() == fold))
                for piece in pieces(own):
                    if tries[fold] is None:
                        tries[fold] = Trie(*shared.value[1 - fold])
                    data, offsets = utf8(piece.column("text"))
                    key, at = np.unique(keys(data, offsets), return_inverse=True)
                    bits = tries[fold].costs(key)
                    if wanted is not None:
                        bits[~wanted[(key >> np.uint32(8)) & np.uint32(0xFF)]] = 0
                    n = np.diff(offsets)
                    full = np.flatnonzero(n)
                    known, total = known_bytes(piece.column("at"), data, offsets)
                    if not flags:
                        total = np.zeros(len(n))
                    if len(full):
                        total[full] += np.add.reduceat(np.where(known, 0.0, bits[at]), offsets[full])
                    yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("text_hash"), pa.array(n, pa.int64()), pa.array(total)], names=["doc_id", "text_hash", "n_bytes", "bits"])

    return scan


def adaptive_bits(data: bytes, order: int = ORDER, model: dict | None = None, learn: bool = True) -> float:
    """Bits of one text, byte by byte through a trie of dictionaries that is updated after each byte."""
    model = {} if model is None else model
    past, bits = bytes(order), 0.0
    for symbol in data:
        gone: set[int] = set()
        for o in range(order, -1, -1):
            seen = model.get(past[order - o :])
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in gone}
            whole = sum(left.values()) + len(left)
            if symbol in left:
                bits -= log2(left[symbol] / whole)
                break
            if left:
                bits -= log2(len(left) / whole)
            gone |= seen.keys()
        else:
            bits += log2(256 - len(gone))
        if learn:
            for o in range(order + 1):
                seen = model.setdefault(past[order - o :], {})
                seen[symbol] = seen.get(symbol, 0) + 1
        past = (past + bytes([symbol]))[1:]
    return bits


def score_adaptive(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The columns of ``score``, each document coded on its own."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([adaptive_bits(t, order) for t in texts], pa.float64())], names=["doc_id", "n_bytes", "bits"])

    return id_text(docs).mapInArrow(scan, "doc_id long, n_bytes long, bits double").withColumn("bits_per_byte", F.try_divide("bits", "n_bytes"))
