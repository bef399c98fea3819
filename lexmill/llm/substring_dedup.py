"""Substring dedup over fixed-length token windows.

Every window of ``width`` consecutive tokens of every document gets a 64-bit Rabin-Karp hash. Windows are
counted over the whole table; those that occur at least twice, in one document or in several, merge into
maximal removal intervals where they overlap or touch.

The count is one Spark shuffle by hash bucket. A row per window would cost about 24 bytes each, so each map
task packs the hashes of a few MB of text into one binary value per bucket (8 bytes a window) and, for the way
back, the bucket of each window. A bucket answers with one bit per window, and the answers meet again by
chunk. Nothing is broadcast or collected; the number of buckets follows the bytes of text, so that a bucket fits a
worker at any size, and chunks and buckets grow with the square root of the table, so that packed values do not get small. A window that is repeated a million times weighs no more than a million others.

Tokens are runs of characters other than ASCII white space. Every occurrence of a repeated window is covered:
no copy is preferred. Windows with one 64-bit hash are taken for equal; they are not compared.

Defined results: null, empty and short texts have no windows and no intervals; repeated rows (same doc_id and
text) repeat each other's windows and give one set of intervals; a null doc_id is reported as null; an empty
table gives no rows; other columns are ignored by ``intervals`` and kept by ``cut``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bucket, exchange_sizes, text_bytes
from .kernels import U, lean, long, mix, pieces, repeated, row_starts, short, span_hashes, tokens, utf8, windows

WIDTH = 50
#: Least numbers of features that share a bucket and that a map task packs together; both grow with the square root of the
#: table, so that a chunk has some dozens of features for each bucket.
BUCKET_FEATURES = 1_400_000
CHUNK_FEATURES = 500_000

Feature = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def window_features(width: int) -> Feature:
    """Hash, row and first token of every window."""

    def features(data, offsets):
        start, end, row = tokens(data, offsets)
        hashed, first = windows(span_hashes(data, start, end), row, width)
        return hashed, row[first], first - row_starts(row, len(offsets) - 1)[row[first]]

    return features


def _narrow(most: int) -> type:
    return np.uint8 if most <= 1 << 8 else np.uint16 if most <= 1 << 16 else np.uint32


def repeated_features(docs: DataFrame, features: Feature, bytes_each: int = 6, hash_bytes: int = 8, bucket_features: int = BUCKET_FEATURES, chunk_features: int = CHUNK_FEATURES) -> DataFrame:
    """(doc_id, text_hash, at): for each document that has any, the packed int32 positions of its features that
    occur at least twice in the table, of which there is about one for ``bytes_each`` bytes of text. ``hash_bytes`` of each hash are compared, within a bucket."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets, chunk_features = exchange_sizes(text_bytes(docs) // bytes_each, bucket_features, chunk_features)
    code = _narrow(buckets)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            hashed, row, at = (np.concatenate(x) for x in list(zip(*held))[:3])
            ids = pa.concat_arrays([x[3].column("doc_id") for x in held])
            texts = np.concatenate([x[3].column("text_hash").to_numpy() for x in held]).astype(np.int64)
            null = np.packbits(ids.is_null().to_numpy(zero_copy_only=False))
            ids = ids.fill_null(0).to_numpy().astype(np.int64)
            chunk = int(mix(np.array([part << 32 | nth], U))[0] ^ np.bitwise_xor.reduce(mix(ids.view(U) + texts.view(U)))) >> 1
            bucket = (hashed % U(buckets)).astype(code)
            order = np.argsort(bucket, kind="stable")
            full, starts = np.unique(bucket[order], return_index=True)
            edges = np.append(starts, len(order))
            ordered = (hashed // U(buckets) if hash_bytes < 8 else hashed)[order]
            # positions travel only where they are not 0, 1, 2 and so on
            meta = [ids.tobytes(), texts.tobytes(), null.tobytes(), np.bincount(row, minlength=len(ids)).astype(np.int32).tobytes(), at.astype(np.int32).tobytes() if not _dense(row, at) else b"", bucket.tobytes()]
            full = full.tolist()
            return pa.RecordBatch.from_pydict(
                {
                    "bucket": pa.array([*full, full[chunk % len(full)]], pa.int32()),
                    "chunk": pa.array([chunk] * (len(full) + 1), pa.int64()),
                    "part": pa.array([*full, -1], pa.int32()),
                    "parts": pa.array([[short(ordered[edges[i] : edges[i + 1]], hash_bytes)] for i in range(len(full))] + [meta], pa.list_(pa.binary())),
                }
            )

        rows = 0
        for batch in batches:
            for piece in pieces(batch):
                hashed, row, at = features(*utf8(piece.column("text")))
                if not len(hashed):
                    continue
                held.append((hashed, row + rows, at, piece.select(["doc_id", "text_hash"])))
                rows += piece.num_rows
                size += len(hashed)
                if size >= chunk_features:
                    yield flush()
                    held, rows, size, nth = [], 0, 0, nth + 1
        if held:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        lean()
        part = table.column("part").to_numpy()
        held = [x[0] for x, p in zip(table.column("parts").to_pylist(), part) if p >= 0]
        marks = repeated(long(b"".join(held), hash_bytes))
        ends = np.cumsum([len(x) // hash_bytes for x in held])
        bits = iter(np.split(marks, ends[:-1]) if held else [])
        answer = [[np.packbits(next(bits)).tobytes()] if p >= 0 else x for p, x in zip(part, table.column("parts").to_pylist())]
        return pa.table({"chunk": table.column("chunk"), "part": table.column("part"), "parts": pa.array(answer, pa.list_(pa.binary()))})

    def gather(table: pa.Table) -> pa.Table:
        lean()
        answers = dict(zip(table.column("part").to_pylist(), table.column("parts").to_pylist()))
        if -1 not in answers:
            raise RuntimeError("a chunk came without its documents: the input gave other rows when it was read again")
        ids, texts, null, sizes, at, bucket = answers[-1]
        ids, texts, sizes = np.frombuffer(ids, np.int64), np.frombuffer(texts, np.int64), np.frombuffer(sizes, np.int32)
        null = np.unpackbits(np.frombuffer(null, np.uint8))[: len(ids)].astype(bool)
        bucket = np.frombuffer(bucket, code)
        order = np.argsort(bucket, kind="stable")
        full, starts = np.unique(bucket[order], return_index=True)
        edges = np.append(starts, len(order))
        marks = np.zeros(len(bucket), bool)
        for i, b in enumerate(full.tolist()):
            got = np.unpackbits(np.frombuffer(answers[b][0], np.uint8))[: edges[i + 1] - edges[i]]
            marks[order[edges[i] : edges[i + 1]]] = got.astype(bool)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.frombuffer(at, np.int32) if at else (np.arange(len(bucket)) - np.repeat(starts[:-1], sizes)).astype(np.int32)
        some = np.flatnonzero(np.add.reduceat(np.append(marks, False).astype(np.int64), np.minimum(starts[:-1], len(marks))) * (sizes > 0))
        return pa.table(
            {
                "doc_id": pa.array(ids[some], pa.int64(), mask=null[some]),
                "text_hash": pa.array(texts[some], pa.int64()),
                "at": pa.array([at[starts[i] : starts[i + 1]][marks[starts[i] : starts[i + 1]]].tobytes() for i in some], pa.binary()),
            }
        )

    packed = docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(pack, "bucket int, chunk long, part int, parts array<binary>")
    counted = by_bucket(packed, buckets).applyInArrow(count, "chunk long, part int, parts array<binary>")
    return counted.groupBy("chunk").applyInArrow(gather, "doc_id long, text_hash long, at binary")


def _dense(row: np.ndarray, at: np.ndarray) -> bool:
    """True where the positions of each row are 0, 1, 2 and so on."""
    return bool(np.array_equal(at, np.arange(len(row)) - np.searchsorted(row, row)))


def merge_runs(at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals [start, end) covered by windows of ``width`` at ascending positions."""
    if not len(at):
        return at, at
    new = np.flatnonzero(np.diff(at) > width)
    return at[np.concatenate([[0], new + 1])], at[np.concatenate([new, [len(at) - 1]])] + width


def _spans(docs: DataFrame, width: int) -> DataFrame:
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [merge_runs(np.frombuffer(x, np.int32), width) for x in batch.column("at").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array([r[0].tolist() for r in runs], pa.list_(pa.int32())), pa.array([r[1].tolist() for r in runs], pa.list_(pa.int32()))], names=["doc_id", "text_hash", "starts", "ends"])

    return repeated_features(docs, window_features(width)).mapInArrow(merge, "doc_id long, text_hash long, starts array<int>, ends array<int>")


def intervals(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, start_token, end_token): maximal runs of tokens, end exclusive, covered by repeated windows."""
    return (
        _spans(docs, width)
        .select("doc_id", F.posexplode("starts").alias("i", "start_token"), "ends")
        .select("doc_id", "start_token", F.element_at("ends", F.col("i") + 1).alias("end_token"))
        .distinct()
    )


def remove_tokens(text: str, starts, ends) -> str:
    """The text without the given token intervals and the white space after each."""
    data = text.encode()
    first, _, _ = tokens(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    edge = np.append(first, len(data))
    out, at = [], 0
    for s, e in zip(starts, ends):
        out.append(data[at : edge[s]])
        at = edge[e]
    return b"".join([*out, data[at:]]).decode()


def cut(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents without their repeated passages; those of which nothing but white space is left go.

    ``n_chars``, where there is such a column, is counted anew. Texts cross the network once, in a join on
    (doc_id, hash of the text) with the intervals; documents without repeats come out unchanged.
    """
    start, end, key, text_hash = (f"__lexmill_{x}" for x in ("starts", "ends", "id", "hash"))
    spans = _spans(docs, width).dropDuplicates(["doc_id", "text_hash"]).toDF(key, text_hash, start, end)
    joined = docs.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.xxhash64(F.col("text").cast("string")) == F.col(text_hash)), "left").drop(key, text_hash)

    def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.select([n for n in batch.schema.names if n not in (start, end)])
            touched = np.flatnonzero(batch.column(start).is_valid().to_numpy(zero_copy_only=False))
            if len(touched):
                texts = batch.column("text").to_pylist()
                for i in touched:
                    texts[i] = remove_tokens(texts[i], batch.column(start)[i].as_py(), batch.column(end)[i].as_py())
                gone = np.zeros(len(texts), bool)
                gone[[i for i in touched if not texts[i].strip(" \t\n\x0b\f\r")]] = True
                table = table.set_column(table.schema.get_field_index("text"), "text", pa.array(texts, table.schema.field("text").type)).filter(pa.array(~gone))
            yield table

    out = joined.mapInArrow(shorten, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def sql(width: int = WIDTH) -> str:
    """The intervals in DuckDB, by grouping the windows themselves."""
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS ws FROM documents),
    w AS (SELECT r, doc_id, p, array_to_string(list_slice(ws, p + 1, p + {width}), ' ') AS g
          FROM (SELECT r, doc_id, ws, unnest(range(0, len(ws) - {width - 1})) AS p FROM d)),
    s AS (SELECT r, doc_id, p FROM (SELECT r, doc_id, p, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
    i AS (SELECT r, doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= {width} THEN 0 ELSE 1 END AS first FROM s),
    g AS (SELECT r, doc_id, p, sum(first) OVER (PARTITION BY r ORDER BY p) AS n FROM i)
    SELECT DISTINCT doc_id, min(p)::INT AS start_token, (max(p) + {width})::INT AS end_token FROM g GROUP BY r, doc_id, n"""
