"""Suffix-array dedup with a logarithmic index family.

Finds all token runs of ``width`` or more that occur at least twice in the table. The index is a family of levels in the shared
folder. Documents come in batches; each batch gets suffix arrays, is merge-scanned against every existing level for
matches of ``width`` tokens, and then becomes a level itself; two levels of one rank merge into one of the next, so that n batches
leave at most log2(n) + 1 levels and every suffix is merged log2(n) times at most. What came before is never sorted again:
``IndexFamily.add`` takes further batches at any time and returns the matches that they bring, in old documents too.

A level is cut into shards by content: every window of ``width`` tokens belongs to the
least of its ``SEED``-gram hashes, equal windows to equal ones, and consecutive windows mostly share it. A maximal run
of windows with one and the same least n-gram is a stretch of at most 2 * width tokens, and travels whole to the shard of its hash; there
its suffixes meet all others they can equal. Levels are tables bucketed by shard, so that scans and merges of two levels move nothing.
In a shard, suffixes are ordered by their first ``width`` tokens, as far as a match must reach; longer matches
show as runs of windows, which merge into maximal intervals for each document.

Where all documents are known, stretches whose hash occurs only once in the table hold no repeated window and
need no place in the index: ``intervals`` first counts the hashes over the whole table in a packed exchange (8 bytes a stretch, some
twenty tokens) and sends the others through the family in BATCHES batches. The number of shards follows the bytes of
text, so that one is bounded, and nothing is broadcast.

Tokens are runs of characters other than ASCII white space; they are compared by 32-bit hashes, a window by fifty of them.

Result: (doc_id, start_token, end_token), end exclusive: every occurrence, merged where matches overlap or touch.

Defined results: null, empty and short texts have no match; repeated rows (same doc_id and text) match each other and
give one set of intervals; a null doc_id is reported as null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import delete_folder
from .common import id_text, new_folder, stored, text_bytes
from .kernels import U, lean, mix, pieces, row_starts, sliding_min, span_hashes, tokens, utf8, windows
from .substring_dedup import Feature, repeated_features

WIDTH = 50
SEED = 8
#: Batches in which a whole table goes through the family.
BATCHES = 8
#: Bytes of text whose stretches share a shard.
SHARD_BYTES = 4 << 20
#: Shards of a level that share a file, and the most files of a level.
SHARDS_PER_FILE = 4
MOST_FILES = 50_000

_SENT = "shard int, doc_id array<long>, text_hash binary, first binary, count binary, tokens binary"
_LEVEL = _SENT + ", suffixes binary"
_MATCH = "doc_id long, text_hash long, first int, last int"


def stretches(data: np.ndarray, offsets: np.ndarray, width: int, seed: int):
    """(hash, row, first window, windows) of every run of windows with one least hash, and the tokens' hashes and
    the first token of each row."""
    start, end, row = tokens(data, offsets)
    word = span_hashes(data, start, end)
    first_token = row_starts(row, len(offsets) - 1)
    grams, at = windows(word, row, seed)
    if len(word) < width:
        none = np.zeros(0, np.int64)
        return none.astype(U), none, none, none, word, first_token
    all_grams = np.zeros(len(word) - seed + 1, U)  # by first token; those across rows are never used
    all_grams[at] = grams
    least = sliding_min(all_grams, width - seed + 1)
    inside = np.flatnonzero(row[: len(word) - width + 1] == row[width - 1 :])
    least, owner = least[inside], row[inside]
    new = np.ones(len(inside), bool)
    # a run also ends where its least hash leaves the window, so that no window occurs twice in one run
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | (all_grams[inside[:-1]] == least[:-1])
    head = np.flatnonzero(new)
    return least[head], owner[head], inside[head] - first_token[owner[head]], np.diff(np.append(head, len(inside))), word, first_token


def stretch_features(width: int, seed: int) -> Feature:
    """Hash, row and number within the row of every stretch."""

    def features(data, offsets):
        hashed, row, _, _, _, _ = stretches(data, offsets, width, seed)
        return hashed, row, np.arange(len(row)) - np.searchsorted(row, row)

    return features


class Level:
    """The stretches of a shard and their suffixes in the order of their first ``width`` tokens."""

    def __init__(self, tables: list[pa.Table], width: int):
        rows = [t for t in tables if t.num_rows]
        join = lambda name, kind: np.frombuffer(b"".join(x for t in rows for x in t.column(name).to_pylist()), kind)
        self.ids = pa.array([x for t in rows for own in t.column("doc_id").to_pylist() for x in own], pa.int64())
        self.texts, self.first, self.count = join("text_hash", np.int64), join("first", np.int32), join("count", np.int32)
        self.tokens, self.width = join("tokens", ">u4"), width
        n = self.count.astype(np.int64) + width - 1
        self.begin = np.cumsum(n) - n
        self.order = None

    @property
    def windows(self) -> np.ndarray:
        """Start of every window, stretch by stretch."""
        count = self.count.astype(np.int64)
        return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.begin, count)

    def keys(self, at: np.ndarray) -> np.ndarray:
        """The first ``width`` tokens of suffixes as strings of bytes that sort like them."""
        if not len(at):
            return np.zeros(0, f"S{4 * self.width}")
        rows = np.lib.stride_tricks.sliding_window_view(self.tokens, self.width)[at]
        return np.ascontiguousarray(rows).view(f"S{4 * self.width}").reshape(-1)

    def sort(self) -> None:
        at = self.windows
        self.order = at[np.argsort(self.keys(at), kind="stable")]

    def matches(self, at: np.ndarray) -> pa.Table:
        """Runs of the windows that start at these tokens, by stretch."""
        at = np.unique(at)
        owner = np.searchsorted(self.begin, at, "right") - 1
        place = self.first[owner].astype(np.int64) + at - self.begin[owner]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(owner)) - 1 if len(head) else head
        return pa.table({"doc_id": self.ids.take(pa.array(owner[head])), "text_hash": self.texts[owner[head]], "first": place[head].astype(np.int32), "last": place[tail].astype(np.int32)})

    def row(self, shard: int) -> pa.Table:
        """One row of _LEVEL."""
        values = {"shard": [shard], "doc_id": [self.ids.to_pylist()], "text_hash": [self.texts.tobytes()], "first": [self.first.tobytes()], "count": [self.count.tobytes()], "tokens": [self.tokens.tobytes()], "suffixes": [self.order.astype("<u4").tobytes()]}
        return pa.table({k: pa.array(v, {"shard": pa.int32(), "doc_id": pa.list_(pa.int64())}.get(k, pa.binary())) for k, v in values.items()})


def _indexed(table: pa.Table, width: int) -> Level:
    level = Level([table], width)
    level.order = np.frombuffer(b"".join(table.column("suffixes").to_pylist()), "<u4").astype(np.int64)
    return level


def suffix_sort(table: pa.Table, width: int) -> Level:
    level = Level([table], width)
    level.sort()
    return level


def repeats(level: Level) -> np.ndarray:
    """Suffixes of a level that have their first ``width`` tokens in common with a neighbour."""
    keys = level.keys(level.order)
    same = keys[1:] == keys[:-1]
    return np.concatenate([level.order[1:][same], level.order[:-1][same]])


def merged(one: Level, two: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, common, side): the suffixes of two levels in one order, as places among those of one and then of two; which of them
    have their first ``width`` tokens in common with a suffix of the other level; and from which level they are. Both ascend, and a stable
    sort of two ascending runs is one pass of a merge."""
    keys = np.concatenate([one.keys(one.order), two.keys(two.order)])
    order = np.argsort(keys, kind="stable")
    side = order >= len(one.order)
    keys = keys[order]
    group = np.cumsum(np.concatenate([[True], keys[1:] != keys[:-1]])) - 1 if len(keys) else order
    both = (np.bincount(group, side) > 0) & (np.bincount(group, ~side) > 0) if len(keys) else np.zeros(0, bool)
    return order, both[group], side


class IndexFamily:
    """Levels of a growing collection in one folder; ``levels`` has the table of each rank that is taken.

    All batches must be cut for the same number of shards, and width and seed. The tables belong to the folder: ``IndexFamily.open``
    finds them again in another session."""

    def __init__(self, spark: SparkSession, shards: int, width: int = WIDTH, seed: int = SEED, folder: str | None = None):
        self.spark, self.shards, self.width, self.seed = spark, shards, width, seed
        self.folder = folder or new_folder(spark, "suffix-family")
        self.files = min(MOST_FILES, max(1, -(-shards // SHARDS_PER_FILE)))
        self.levels: dict[int, str] = {}
        self.turn = 0

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _write(self, rows: DataFrame) -> str:
        name = f"suffix_level_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(self.files, "shard").sortBy("shard").option("path", self._path(name)).option("compression", "zstd").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        delete_folder(self.spark, self._path(name))

    def drop(self) -> None:
        """Forgets all levels, tables and files."""
        for name in self.levels.values():
            self._drop(name)
        self.levels = {}

    def _save(self) -> None:
        rows = [(self.shards, self.width, self.seed, self.turn, rank, name) for rank, name in self.levels.items()]
        self.spark.createDataFrame(rows, "shards int, width int, seed int, turn int, rank int, name string").coalesce(1).write.mode("overwrite").parquet(self._path(f"family/turn={self.turn}"))

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> IndexFamily:
        """The family as its last batch left it."""
        rows = spark.read.parquet(f"{folder}/family/turn=*").collect()
        rows = [r for r in rows if r["turn"] == max(x["turn"] for x in rows)]
        family = cls(spark, rows[0]["shards"], rows[0]["width"], rows[0]["seed"], folder)
        family.turn, family.levels = rows[0]["turn"], {r["rank"]: r["name"] for r in rows}
        for name in family.levels.values():
            if not spark.catalog.tableExists(name):
                spark.sql(f"CREATE TABLE {name} ({_LEVEL}) USING parquet CLUSTERED BY (shard) SORTED BY (shard) INTO {family.files} BUCKETS LOCATION '{family._path(name)}'")
        return family

    def add(self, sent: DataFrame, last: bool = False) -> DataFrame:
        """Takes in a batch of stretches as ``send`` cuts them; (doc_id, text_hash, first, last): runs of windows, of this
        batch and of earlier ones, that it matches or has twice. After the ``last`` batch the family is dropped: no level
        is merged any more, as none is read again."""
        width, spark = self.width, self.spark

        def sort(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
            lean()
            return suffix_sort(table, width).row(key[0].as_py())

        def within(table: pa.Table) -> pa.Table:
            lean()
            level = _indexed(table, width)
            return level.matches(repeats(level))

        def scan(left: pa.Table, right: pa.Table) -> pa.Table:
            lean()
            one, two = _indexed(left, width), _indexed(right, width)
            order, common, side = merged(one, two)
            found = [one.matches(one.order[order[common & ~side]]), two.matches(two.order[order[common & side] - len(one.order)])]
            return pa.concat_tables(x.cast(found[0].schema) for x in found)

        def merge(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
            lean()
            one, two = _indexed(left, width), _indexed(right, width)
            whole = Level([left, right], width)
            starts = np.concatenate([one.order, two.order + len(one.tokens)])
            whole.order = starts[merged(one, two)[0]]
            return whole.row(key[0].as_py())

        name = self._write(sent.repartition(self.files, "shard").groupBy("shard").applyInArrow(sort, _LEVEL))
        batch = spark.table(name).groupBy("shard")
        found = batch.applyInArrow(within, _MATCH)
        for level in self.levels.values():
            found = found.unionByName(batch.cogroup(spark.table(level).groupBy("shard")).applyInArrow(scan, _MATCH))
        found = stored(found, "suffix-matches")
        if last:
            self._drop(name)
            self.drop()
            return found
        rank = 0
        while rank in self.levels:
            old = self.levels.pop(rank)
            both = self._write(spark.table(old).groupBy("shard").cogroup(spark.table(name).groupBy("shard")).applyInArrow(merge, _LEVEL))
            self._drop(old)
            self._drop(name)
            name, rank = both, rank + 1
        self.levels[rank] = name
        self.turn += 1
        self._save()
        return found


def send(docs: DataFrame, shards: int, width: int = WIDTH, seed: int = SEED, batches: int = 1) -> DataFrame:
    """(batch, shard, ..): the stretches of (doc_id, text, text_hash) for each shard, packed. Where there is a column ``at``, only
    those whose numbers, packed int32, it has."""
    some = "at" in docs.columns

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for part in rows:
            for piece in pieces(part):
                turn += 1
                hashed, row, first, count, word, first_token = stretches(*utf8(piece.column("text")), width, seed)
                own = np.arange(len(row))
                if some:
                    starts = row_starts(row, piece.num_rows)
                    own = np.concatenate([starts[i] + np.frombuffer(x, np.int32) for i, x in enumerate(piece.column("at").to_pylist())])
                if not len(own):
                    continue
                shard = (mix(hashed[own]) % U(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                own, shard = own[order], shard[order]
                used, edge = np.unique(shard, return_index=True)
                ids, texts = piece.column("doc_id"), piece.column("text_hash").to_numpy()
                short = word.astype(np.uint32).astype(">u4")
                out = {"batch": [], "shard": [], "doc_id": [], "text_hash": [], "first": [], "count": [], "tokens": []}
                for s, mine in zip(used.tolist(), np.split(own, edge[1:])):
                    begin, n = first_token[row[mine]] + first[mine], count[mine] + width - 1
                    at = np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)
                    out["batch"].append(turn % batches)
                    out["shard"].append(s)
                    out["doc_id"].append(ids.take(pa.array(row[mine])).to_pylist())
                    out["text_hash"].append(texts[row[mine]].tobytes())
                    out["first"].append(first[mine].astype(np.int32).tobytes())
                    out["count"].append(count[mine].astype(np.int32).tobytes())
                    out["tokens"].append(short[at].tobytes())
                yield pa.RecordBatch.from_pydict({k: pa.array(v, {"batch": pa.int32(), "shard": pa.int32(), "doc_id": pa.list_(pa.int64())}.get(k, pa.binary())) for k, v in out.items()})

    return docs.mapInArrow(cut, "batch int, " + _SENT)


def hashed_documents(docs: DataFrame) -> DataFrame:
    return id_text(docs).withColumn("text_hash", F.xxhash64("text"))


def shards_of(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> int:
    return max(1, -(-text_bytes(docs) // shard_bytes))


def matches(docs: DataFrame, width: int = WIDTH, seed: int = SEED, batches: int = BATCHES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, text_hash, first, last): runs of windows that occur again, by stretch."""
    docs = hashed_documents(docs)
    shards = shards_of(docs, shard_bytes)
    again = repeated_features(docs, stretch_features(width, seed), bytes_each=120).dropDuplicates(["doc_id", "text_hash"]).toDF("id", "hash", "at")
    flagged = docs.join(again, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))).drop("id", "hash")
    path = new_folder(docs.sparkSession, "suffix-stretches")
    send(flagged, shards, width, seed, batches).write.partitionBy("batch").option("compression", "zstd").parquet(path)
    sent = docs.sparkSession.read.schema(_SENT + ", batch int").parquet(path)
    family, found = IndexFamily(docs.sparkSession, shards, width, seed), None
    for k in range(batches):
        own = family.add(sent.where(F.col("batch") == k).drop("batch"), last=k == batches - 1)
        found = own if found is None else found.unionByName(own)
    return found


def intervals(docs: DataFrame, width: int = WIDTH, seed: int = SEED, batches: int = BATCHES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(doc_id, start_token, end_token) as said above."""
    return merged_runs(matches(docs, width, seed, batches, shard_bytes), width)


def merged_runs(found: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, start_token, end_token): maximal intervals of runs of windows, whatever batches found them."""
    found = found.groupBy("doc_id", "text_hash", "first").agg((F.max("last") + F.lit(width)).alias("end"))
    by = Window.partitionBy("doc_id", "text_hash").orderBy("first", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("first") <= F.col("reach"), 0).otherwise(1)).over(by.rowsBetween(Window.unboundedPreceding, 0))
    whole = found.withColumn("reach", reach).withColumn("island", island).groupBy("doc_id", "text_hash", "island")
    return whole.agg(F.min("first").alias("start_token"), F.max("end").alias("end_token")).select("doc_id", "start_token", "end_token").distinct()
