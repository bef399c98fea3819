"""Quality classifier by importance resampling (hashed n-gram generative models, Gumbel top-k).

Words and word pairs are hashed into CELLS features. Two generative models are bags of these features: the target,
from documents labelled good, and the raw text, from all documents of the table. A document's log weight is the
sum over its features of log p_target - log p_raw. Adding Gumbel noise to the log weights and taking the k largest
samples k documents without replacement in proportion to their weights. k is the share of good labels times the
number of documents.

The target is fitted on at most TRAIN_ROWS labelled rows, the first in hash order of doc_id and label; a bounded,
documented sample. The raw counts and the scores cover every document. Both models have a fixed size and travel by
broadcast. The k-th largest key is found from four histograms of its bits, without a sort and without bringing any rows together.

Words are runs of characters other than ASCII white space, so that symbols count. Features are smoothed by adding one.

Defined results: null and blank texts have no features and are never sampled; a null doc_id is scored and has a
noise of its own; rows with the same doc_id have the same noise; rows tied at the cut are all taken; without good
labels there is no target and nothing is sampled; labels that are null or for unknown documents count for nothing; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_sample, id_text, stored
from .kernels import U, mix, pieces, span_hashes, tokens, utf8, windows

CELLS = 1 << 16
TRAIN_ROWS = 20_000
SEED = 29


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row) of every word and word pair."""
    start, end, row = tokens(data, offsets)
    word = span_hashes(data, start, end)
    pair, first = windows(word, row, 2)
    return (np.concatenate([word, mix(pair)]) % U(CELLS)).astype(np.int64), np.concatenate([row, row[first]])


def good_ids(labels: DataFrame, most: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Ids of documents labelled good within the sample, and their share of it."""
    sample = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).alias("good"))
    rows = hashed_sample(sample, most, "doc_id", "good").toPandas()
    return np.unique(rows.loc[rows["good"], "doc_id"].to_numpy(np.int64)), float(rows["good"].mean()) if len(rows) else 0.0


def log_ratios(docs: DataFrame, good: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of each cell, from all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(good)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
        for batch in batches:
            for piece in pieces(batch):
                cell, row = features(*utf8(piece.column("text")))
                raw += np.bincount(cell, minlength=CELLS)
                ids = piece.column("doc_id")
                ours = np.isin(ids.fill_null(0).to_numpy(), shared.value) & ids.is_valid().to_numpy(zero_copy_only=False)
                target += np.bincount(cell[ours[row]], minlength=CELLS)
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array([raw.tobytes(), target.tobytes()], pa.binary())], names=["model", "counts"])

    def total(table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"model": table.column("model")[:1], "counts": pa.array([counts.tobytes()], pa.binary())})

    rows = docs.mapInArrow(count, "model int, counts binary").groupBy("model").applyInArrow(total, "model int, counts binary").collect()
    held = {r["model"]: np.frombuffer(r["counts"], np.int64) + 1.0 for r in rows}
    raw, target = (held.get(m, np.ones(CELLS)) for m in (0, 1))
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def gumbel(ids: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Standard Gumbel noise, a fixed function of seed and id."""
    u = ((mix(mix(ids.view(U)) + U(seed)) >> U(12)).astype(np.float64) + 0.5) / float(1 << 52)
    return -np.log(-np.log(u))


def weights(docs: DataFrame, good: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, log_weight, key, rank_bits) of every document that has a word."""
    docs = id_text(docs)
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, good))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                cell, row = features(*utf8(piece.column("text")))
                size = np.bincount(row, minlength=piece.num_rows)
                weight = np.bincount(row, shared.value[cell], piece.num_rows)
                key = weight + gumbel(piece.column("doc_id").fill_null(-1).to_numpy().astype(np.int64), seed)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(size), pa.array(weight), pa.array(key), pa.array(ascending(key))], names=["doc_id", "n_features", "log_weight", "key", "rank_bits"]).filter(pa.array(size > 0))

    return docs.mapInArrow(score, "doc_id long, n_features long, log_weight double, key double, rank_bits long")


def ascending(keys: np.ndarray) -> np.ndarray:
    """Integers that are in the order of the doubles."""
    bits = keys.view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)


def largest(scored: DataFrame, k: int) -> DataFrame:
    """The rows with the k largest keys, and those tied with the last of them.

    The k-th largest is found 16 bits at a time: each pass counts the rows that have the bits found so far by their next bits."""
    if k <= 0:
        return scored.limit(0)
    at, left, rows = None, k, scored.select("rank_bits")
    for shift in (48, 32, 16, 0):
        own = rows if at is None else rows.where(F.shiftright("rank_bits", shift + 16) == at)
        for cell, count in sorted(((r["cell"], r["count"]) for r in own.groupBy(F.shiftright("rank_bits", shift).alias("cell")).count().collect()), reverse=True):
            if count >= left:
                break
            left -= count
        else:
            return scored  # fewer than k
        at = cell
    return scored.where(F.col("rank_bits") >= at)


def resampled(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, log_weight, key): the sampled documents."""
    good, share = good_ids(labels, train_rows)
    if not len(good):
        return id_text(docs).limit(0).selectExpr("doc_id", "0L AS n_features", "0D AS log_weight", "0D AS key")
    scored = stored(weights(docs, good, seed), "importance-weights")
    return largest(scored, int(share * docs.count() + 0.5)).drop("rank_bits")
