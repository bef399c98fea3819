"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors go to the nearest of k centroids in two steps, so that shards overlap: sqrt(k) cells, and in each cell as many
centroids as its vectors need; a vector is in the ``overlap`` nearest shards of its nearest cell, in one less of the next cell
and so on. Each shard links every vector to its
nearest others in it, robustly pruned: a neighbour goes when one already taken is ``ALPHA`` times nearer to it than
the vector itself, which leaves long edges as well as short ones; the very nearest always stay. The adjacency lists that
a vector has in its shards are united. Every vector is then a query: in each of its shards a greedy best-first search
runs over the united lists from the vector itself and from the middles of the graph's connected components, the nearest
BEAM of them, and where it comes within the threshold the search expands over all vectors in range until none is new. Pairs
found are verified with their exact cosine; a pair that has several shards in common counts in the first of them.

Two audits guard the recall, over pairs as well as on average over the queries that have any. In each shard
SHARD_AUDIT queries are compared with brute force over the shard; a shard below SHARD_RECALL is searched exactly, and so is, in
blocks, one that came out larger than MOST_VECTORS. Then
queries are compared with brute force over all vectors, twice as many each time until they have AUDIT_PAIRS true pairs
or are AUDIT_MOST or all; if the recall is below MIN_RECALL, the whole is built again with more overlap.
Where that costs as much as comparing all vectors (overlap squared reaches the number of shards) or the overlap
passes MOST_OVERLAP, all are compared, in blocks, and the result is exact.

Equal vectors are one node. Result: (vec_id, class_id, n_links), one row for each id and vector: the least id of all that are
linked to it directly or through others, and how many other rows are similar to it, those with an equal vector included.
No pair leaves its shard: a shard returns a count and one edge for each of its vectors.

The index is fitted on samples, the first vectors in hash order: TRAIN_VECTORS, or TRAIN_EACH for each centroid of the first step
(whose number grows with the fourth root of the squared table, sqrt(n / SHARD_VECTORS)), and in each cell TRAIN_EACH for each of its
centroids. Every vector is indexed and every vector is a query.

Defined results: null ids, null vectors, vectors with a null or non-finite element or of zero length are left out; vectors of
different dimensions are never similar, each dimension is searched on its own; rows with the same id and vector
are one, those with one id and different vectors have a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, hashed_sample, stored
from .kernels import group_roots

THRESHOLD = 0.95
OVERLAP = 2
SHARD_VECTORS = 1500
MOST_VECTORS = 16_384
TRAIN_VECTORS = 20_000
TRAIN_EACH = 32
#: Rows of a cell that a task gives to its shards.
ASSIGN_ROWS = 50_000
CANDIDATES = 48
DEGREE = 16
NEAREST = 4
ALPHA = 1.2
BEAM = 32
AUDIT = 256
AUDIT_PAIRS = 2000
AUDIT_MOST = 8192
SHARD_AUDIT = 256
SHARD_RECALL = 0.99
MIN_RECALL = 0.95
MOST_OVERLAP = 16
EXACT_BLOCK = 4096

_FOUND = "id long, root long, pairs long, links long"


def matrix(column) -> np.ndarray:
    """Rows of a list column, scaled to length one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows."""
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = np.concatenate([np.argmax(x[i : i + 4096] @ c.T, 1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.maximum(size, 1e-300), c)
    return c


def prune(x: np.ndarray, block: int = 512) -> np.ndarray:
    """(n, DEGREE) robustly pruned neighbours of each row, -1 where there are fewer."""
    n = len(x)
    out = np.full((n, DEGREE), -1, np.int64)
    m = min(CANDIDATES, n - 1)
    if m < 1:
        return out
    for s in range(0, n, block):
        e = min(n, s + block)
        near = x[s:e] @ x.T
        near[np.arange(e - s), np.arange(s, e)] = -2
        cand = np.argpartition(-near, m - 1, axis=1)[:, :m]
        sims = np.take_along_axis(near, cand, 1)
        order = np.lexsort((cand, -sims), axis=1)
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        far = 1 - sims
        alive = np.ones(cand.shape, bool)
        lines = np.arange(e - s)
        for d in range(min(DEGREE, m)):
            some = alive.any(1)
            pick = np.argmax(alive, 1)
            if d < min(NEAREST, m):
                some[:], pick[:] = True, d
            out[s:e, d] = np.where(some, cand[lines, pick], -1)
            alive[lines, pick] = False
            chosen = x[cand[lines, pick]]
            between = 1 - np.einsum("bcd,bd->bc", x[cand], chosen)
            alive &= ~(some[:, None] & (ALPHA * between <= far))
    return out


def entries(x: np.ndarray, links: np.ndarray) -> np.ndarray:
    """The row nearest to the middle of each connected component of the graph."""
    a, col = np.nonzero(links >= 0)
    label = np.unique(group_roots(len(x), a, links[a, col]), return_inverse=True)[1]
    middle = np.zeros((int(label.max()) + 1, x.shape[1]))
    np.add.at(middle, label, x)
    order = np.lexsort((-np.einsum("nd,nd->n", x, middle[label]), label))
    return order[np.flatnonzero(np.diff(label[order], prepend=-1))]


def exact(x: np.ndarray, threshold: float, rows: np.ndarray | None = None, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, found row) within the threshold by brute force; the queries are ``rows``, or all."""
    rows = np.arange(len(x)) if rows is None else rows
    queries, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for s in range(0, len(rows), block):
        q, f = np.nonzero(x[rows[s : s + block]] @ x.T >= threshold)
        q = rows[s + q]
        queries.append(q[q != f])
        found.append(f[q != f])
    return np.concatenate(queries), np.concatenate(found)


def least_recall(true: np.ndarray, hit: np.ndarray) -> float:
    """Of true and found pairs by query: the recall over pairs or the mean over queries, whichever is less; 1.0 without pairs."""
    some = true > 0
    return float(min(hit.sum() / true.sum(), (hit[some] / true[some]).mean())) if some.any() else 1.0


def shard_pairs(x: np.ndarray, links: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs (a << 32 | b, a < b) of rows of a shard: by the graph, or exactly where a sample shows that it misses some."""

    def packed(q, f):
        return np.unique(np.minimum(q, f) << 32 | np.maximum(q, f))

    pairs = packed(*search(x, links, threshold))
    rows = np.unique(np.linspace(0, len(x) - 1, min(len(x), SHARD_AUDIT)).astype(np.int64))
    q, f = exact(x, threshold, rows)
    hit = np.isin(np.minimum(q, f) << 32 | np.maximum(q, f), pairs)
    if least_recall(np.bincount(q, minlength=len(x)), np.bincount(q[hit], minlength=len(x))) < SHARD_RECALL:
        pairs = packed(*exact(x, threshold))
    return pairs


def search(x: np.ndarray, links: np.ndarray, threshold: float, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, found row) within the threshold, every row being a query."""
    n = len(x)
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = entries(x, links)
    beam = min(BEAM, n)
    most = min(beam - 1, len(start))
    queries, found = [], []
    for s in range(0, n, block):
        q = x[s : s + block]
        lines = np.arange(len(q))
        ids = np.full((len(q), beam), -1, np.int64)
        sims = np.full((len(q), beam), -2.0)
        open_ = np.zeros((len(q), beam), bool)
        seen = np.zeros((len(q), n), bool)
        ids[:, 0], sims[:, 0], open_[:, 0] = s + lines, np.einsum("nd,nd->n", q, q), True
        seen[lines, s + lines] = True
        near = q @ x[start].T
        col = np.argpartition(-near, most - 1, axis=1)[:, :most]
        other = start[col] != s + lines[:, None]
        ids[:, 1 : most + 1] = np.where(other, start[col], -1)
        sims[:, 1 : most + 1] = np.where(other, np.take_along_axis(near, col, 1), -2)
        open_[:, 1 : most + 1] = other
        seen[lines[:, None], start[col]] = True
        while open_.any():
            at = np.argmax(np.where(open_, sims, -3), 1)
            busy = open_[lines, at]
            open_[lines, at] = False
            more = np.where(busy[:, None], links[np.maximum(ids[lines, at], 0)], -1)
            more[(more < 0) | np.take_along_axis(seen, np.maximum(more, 0), 1)] = -1
            line, col = np.nonzero(more >= 0)
            fresh = np.full(more.shape, -2.0)
            fresh[line, col] = np.einsum("nd,nd->n", x[more[line, col]], q[line])
            seen[line, more[line, col]] = True
            ids, sims = np.concatenate([ids, more], 1), np.concatenate([sims, fresh], 1)
            open_ = np.concatenate([open_, more >= 0], 1)
            best = np.argpartition(-sims, beam - 1, axis=1)[:, :beam]
            ids, sims, open_ = (np.take_along_axis(v, best, 1) for v in (ids, sims, open_))
        for i in np.flatnonzero(((sims >= threshold) & (ids >= 0) & (ids != s + lines[:, None])).any(1)):
            known = np.zeros(n, bool)
            front = ids[i][(sims[i] >= threshold) & (ids[i] >= 0)]
            known[front] = True
            reached = [front]
            tried = known.copy()
            while len(front):
                more = np.unique(links[front])
                more = more[more >= 0]
                more = more[~tried[more]]
                tried[more] = True
                front = more[x[more] @ q[i] >= threshold]
                reached.append(front)
            reached = np.concatenate(reached)
            reached = reached[reached != s + i]
            queries.append(np.full(len(reached), s + i))
            found.append(reached)
    none = [np.zeros(0, np.int64)]
    return np.concatenate(queries or none), np.concatenate(found or none)


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec, v, x, y): ids and vectors that count, once each, with two hashes that stand for the vector."""
    v = vectors.select(F.col("vec_id").cast("long").alias("vec"), F.col("embedding").cast("array<double>").alias("v")).where("vec IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    length = F.aggregate("v", F.lit(0.0), lambda a, e: a + e * e)
    return v.where(finite).where(length > 0).withColumns({"x": F.xxhash64("v"), "y": F.xxhash64(F.lit(1), "v")}).dropDuplicates(["vec", "x", "y"])


def _shards(nodes: DataFrame, n: int, overlap: int, shard_vectors: int) -> DataFrame:
    """(id, docs, v, shards, shard): every node in each of its shards, with the list of them."""
    spark = nodes.sparkSession
    k = -(-n // shard_vectors)
    cells_wanted = max(1, math.isqrt(k))
    sample = hashed_sample(nodes.select("id", "v"), max(TRAIN_VECTORS, TRAIN_EACH * cells_wanted), "id").toArrow()
    middle = spark.sparkContext.broadcast(centroids(matrix(sample.column("v")), min(cells_wanted, sample.num_rows)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                own = np.argsort(-(matrix(part.column("v")) @ middle.value.T), axis=1, kind="stable")[:, :overlap]
                rows = pa.array(np.repeat(np.arange(part.num_rows), own.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(own.reshape(-1), pa.int32()), pa.array(np.tile(np.arange(own.shape[1]), part.num_rows), pa.int32()), part.column("id").take(rows), part.column("v").take(rows)], names=["cell", "rank", "id", "v"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        c = centroids(matrix(table.column("v")), min(table.column("k")[0].as_py(), table.num_rows))
        return pa.table({"cell": table.column("cell")[:1], "centres": pa.array([c.tolist()], pa.list_(pa.list_(pa.float64())))})

    def assign(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, shards = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if left.num_rows:
            c = np.array(right.column("centres")[0].as_py()) if right.num_rows else matrix(left.slice(0, 1).column("v"))
            cell, rank = left.column("cell")[0].as_py(), left.column("rank").to_numpy()
            for s in range(0, left.num_rows, 2048):
                part = left.slice(s, 2048)
                own = np.argsort(-(matrix(part.column("v")) @ c.T), axis=1, kind="stable")[:, :overlap]
                i, j = np.nonzero(np.arange(own.shape[1]) < (overlap - rank[s : s + 2048])[:, None])
                ids.append(part.column("id").to_numpy()[i])
                shards.append(cell << 32 | own[i, j])
        return pa.table({"id": np.concatenate(ids), "shard": np.concatenate(shards)})

    cells = stored(nodes.select("id", "v").mapInArrow(place, "cell int, rank int, id long, v array<double>"), "graph-cells")
    sizes = cells.groupBy("cell").count().withColumns({"k": F.ceil(F.col("count") / shard_vectors).cast("int"), "salts": F.ceil(F.col("count") / ASSIGN_ROWS).cast("int")})
    rate = F.greatest(F.lit(TRAIN_EACH) * F.col("k"), F.lit(TRAIN_VECTORS / 10)) / F.col("count")
    some = (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1 << 30)) < rate * (1 << 30)) | (F.col("count") <= TRAIN_VECTORS / 10)
    centres = stored(cells.join(sizes, "cell").where(some).select("cell", "k", "id", "v").groupBy("cell").applyInArrow(train, "cell int, centres array<array<double>>"), "graph-centres")
    salted = cells.join(sizes.select("cell", "salts"), "cell").withColumn("salt", F.pmod(F.xxhash64("id", F.lit(3)), F.col("salts")).cast("int"))
    spread = centres.join(sizes.select("cell", "salts"), "cell").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    own = salted.select("cell", "salt", "rank", "id", "v").groupBy("cell", "salt").cogroup(spread.select("cell", "salt", "centres").groupBy("cell", "salt")).applyInArrow(assign, "id long, shard long")
    lists = own.groupBy("id").agg(F.sort_array(F.collect_set("shard")).alias("shards"))
    return nodes.select("id", "docs", "v").join(lists, "id").withColumn("shard", F.explode("shards"))


def _counted(ids: np.ndarray, docs: np.ndarray, a: np.ndarray, b: np.ndarray, once: np.ndarray) -> pa.Table:
    """A row for each node with pairs: how many, how many rows they stand for, and a node of its group. Pairs that are
    not ``once`` only join groups."""
    n = len(ids)
    root = group_roots(n, a, b)
    pairs, links = np.bincount(a[once], minlength=n) + np.bincount(b[once], minlength=n), np.bincount(a[once], docs[b[once]], n) + np.bincount(b[once], docs[a[once]], n)
    some = np.unique(np.concatenate([a, b]))
    return pa.table({"id": ids[some], "root": ids[root[some]], "pairs": pairs[some].astype(np.int64), "links": links[some].astype(np.int64)})


def _first_common(shards: np.ndarray, a: np.ndarray, b: np.ndarray, shard: int) -> np.ndarray:
    """Whether ``shard`` is the first one that the rows of each pair have in common; rows are padded with -1."""
    out = np.ones(len(a), bool)
    for s in range(0, len(a), 1 << 18):
        x, y = shards[a[s : s + (1 << 18)]], shards[b[s : s + (1 << 18)]]
        for i in range(x.shape[1]):
            before = (x[:, i] >= 0) & (x[:, i] < shard)
            if before.any():
                out[s : s + (1 << 18)] &= ~(before & (y == x[:, i : i + 1]).any(1))
    return out


def _padded(lists: list) -> np.ndarray:
    out = np.full((len(lists), max([1, *map(len, lists)])), -1, np.int64)
    for i, x in enumerate(lists):
        out[i, : len(x)] = x
    return out


def _build(nodes: DataFrame, n: int, overlap: int, shard_vectors: int, threshold: float) -> DataFrame:
    """(id, root, pairs, links): what each shard found."""

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table.column("id").to_numpy()
        links = prune(matrix(table.column("v")))
        return pa.table({"id": ids, "links": pa.array([ids[x[x >= 0]] for x in links], pa.list_(pa.int64()))})

    def find(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, x = table.column("id").to_numpy(), matrix(table.column("v"))
        lists = table.column("links").to_pylist()
        owner, other = np.repeat(np.arange(len(ids)), [len(r) for r in lists]), np.concatenate([np.asarray(r, np.int64) for r in lists])
        at = np.minimum(np.searchsorted(ids, other), len(ids) - 1)
        here = ids[at] == other
        owner, other = owner[here], at[here]
        # the NEAREST of each one lead back to it, as far as 2 * DEGREE, the most similar first
        near = np.einsum("nd,nd->n", x[owner], x[other])
        order = np.lexsort((-near, owner))
        owner, other, near = owner[order], other[order], near[order]
        first = np.arange(len(owner)) - np.searchsorted(owner, owner) < NEAREST
        back = np.lexsort((-near[first], other[first]))
        one, two = other[first][back], owner[first][back]
        kept = np.arange(len(one)) - np.searchsorted(one, one) < 2 * DEGREE
        both = np.unique(np.concatenate([owner << 32 | other, one[kept] << 32 | two[kept]]))
        owner, other = both >> 32, both & 0xFFFFFFFF
        links = np.full((len(ids), max(1, int(np.bincount(owner, minlength=len(ids)).max()))), -1, np.int64)
        links[owner, np.arange(len(owner)) - np.searchsorted(owner, owner)] = other
        pairs = shard_pairs(x, links, threshold)
        a, b = pairs >> 32, pairs & 0xFFFFFFFF
        ok = np.concatenate([np.einsum("nd,nd->n", x[a[i : i + 65536]], x[b[i : i + 65536]]) for i in range(0, max(1, len(a)), 65536)]) >= threshold
        a, b = a[ok], b[ok]
        return _counted(ids, table.column("docs").to_numpy(), a, b, _first_common(_padded(table.column("shards").to_pylist()), a, b, table.column("shard")[0].as_py()))

    placed = stored(_shards(nodes, n, overlap, shard_vectors), "graph-shards")
    sizes = placed.groupBy("shard").agg(F.ceil(F.count("*") / MOST_VECTORS).alias("blocks"))
    placed = placed.join(sizes, "shard")
    small = placed.where("blocks = 1").drop("blocks")
    lists = small.groupBy("shard").applyInArrow(link, "id long, links array<long>")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links"))
    found = small.join(united, "id").groupBy("shard").applyInArrow(find, _FOUND)
    return stored(found.unionByName(_in_blocks(placed.where("blocks > 1"), threshold)), "graph-found")


def _in_blocks(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, root, pairs, links): all pairs of each shard of (shard, id, docs, v, shards, blocks), from every two blocks of it."""
    own = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(4)), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = own.select("shard", "id", "docs", "v", "shards", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))

    def compare(table: pa.Table) -> pa.Table:
        ids, x, block = table.column("id").to_numpy(), matrix(table.column("v")), table.column("block").to_numpy()
        left, right = np.flatnonzero(block == table.column("one")[0].as_py()), np.flatnonzero(block == table.column("two")[0].as_py())
        across = table.column("one")[0].as_py() != table.column("two")[0].as_py()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for s in range(0, len(left) if len(right) else 0, 512):
            i, j = np.nonzero(x[left[s : s + 512]] @ x[right].T >= threshold)
            a, b = left[s + i], right[j]
            real = (ids[a] < ids[b]) | across
            found.append((a[real], b[real]))
        a, b = (np.concatenate(c) for c in zip(*found))
        return _counted(ids, table.column("docs").to_numpy(), a, b, _first_common(_padded(table.column("shards").to_pylist()), a, b, table.column("shard")[0].as_py()))

    return cells.groupBy("shard", "one", "two").applyInArrow(compare, _FOUND)


def _compare_all(nodes: DataFrame, n: int, threshold: float) -> DataFrame:
    """(id, root, pairs, links) from all pairs of nodes."""
    zero = F.lit(0).cast("long")
    whole = nodes.select("id", "docs", "v", zero.alias("shard"), F.array(zero).alias("shards"), F.lit(-(-n // EXACT_BLOCK)).cast("long").alias("blocks"))
    return stored(_in_blocks(whole, threshold), "graph-all")


def recall(nodes: DataFrame, n: int, found: DataFrame, threshold: float, audit: int = AUDIT) -> float:
    """Share of the true pairs of audit queries, the first in hash order, that were found, over pairs or on average over
    queries, whichever is less; 1.0 where they have none. ``audit`` doubles until there are enough true pairs. All pairs that
    were found are true and counted once, so that the counts tell."""
    while True:
        sample = hashed_sample(nodes.select("id", "v"), audit, "id", seed=1).toArrow()
        ids, x = sample.column("id").to_numpy(), matrix(sample.column("v"))

        def brute(batches: Iterator[pa.RecordBatch], ids=ids, x=x) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(ids), np.int64)
            for batch in batches:
                for s in range(0, batch.num_rows, 1024):
                    total += (x @ matrix(batch.slice(s, 1024).column("v")).T >= threshold).sum(1)
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(total[some])], names=["id", "true"])

        true = nodes.select("v").mapInArrow(brute, "id long, true long").groupBy("id").agg((F.sum("true") - 1).alias("true"))  # less itself
        hit = found.groupBy("id").agg(F.sum("pairs").alias("hit"))
        by = true.join(hit, "id", "left").select("true", F.coalesce("hit", F.lit(0)).alias("hit")).toArrow()
        total, hit = by.column("true").to_numpy(), by.column("hit").to_numpy()
        if total.sum() >= AUDIT_PAIRS or audit >= min(n, AUDIT_MOST):
            return least_recall(total, hit)
        audit *= 2


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, overlap: int = OVERLAP, shard_vectors: int = SHARD_VECTORS, min_recall: float = MIN_RECALL) -> DataFrame:
    """(vec_id, class_id, n_links) as said above."""
    rows = stored(_usable(vectors), "graph-vectors")
    # written, the ids are the same for every reader
    nodes = rows.groupBy("x", "y").agg(F.min("vec").alias("first"), F.count("*").alias("docs"), F.any_value("v").alias("v"))
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "graph-nodes")
    found = None
    for dims, n in nodes.groupBy(F.size("v")).count().collect():
        own = nodes.where(F.size("v") == dims)
        width = overlap
        part = _build(own, n, width, shard_vectors, threshold)
        while recall(own, n, part, threshold) < min_recall:
            width += 1
            if width**2 >= -(-n // shard_vectors) or width > MOST_OVERLAP:
                part = _compare_all(own, n, threshold)
                break
            part = _build(own, n, width, shard_vectors, threshold)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(F.col("vec").alias("vec_id"), F.col("vec").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select("id", "root")).toDF("id", "root")
    known = nodes.select("id", "x", "y", "first", "docs").join(links, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    classes = known.groupBy("root").agg(F.min("first").alias("class_id"))
    known = known.join(classes, "root").select("x", "y", "class_id", (F.col("docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return rows.select(F.col("vec").alias("vec_id"), "x", "y").join(known, ["x", "y"]).select("vec_id", "class_id", "n_links")
