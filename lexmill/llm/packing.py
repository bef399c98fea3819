"""Best-fit packing of documents into fixed-length training sequences, with swap-based local search.

Documents longer than the capacity are cut into full pieces and a rest, so that no token is lost. Pieces are
packed shard by shard: best-fit decreasing first, then local search over the underfull bins. Taking bins from the
fullest down, a bin may take a piece from a less full bin, or exchange one for one, two for one or one for two with
it, whichever fills it most; every such step raises the sum of squared fills, and bins that lose their last piece
vanish. The search ends when no exchange helps. What is still underfull in any shard is packed again in fewer,
newly mixed shards, round by round, until one shard is left, so the waste of sharding does not grow with
the number of shards; or until a round leaves as many shards as it had: then pieces do not fit together (all of them may be longer than half
the capacity), and further rounds would end no better. Only (doc_id, piece, tokens) travel; texts are read once, for their length.

Tokens are runs of characters other than ASCII white space.

Defined results: null and blank texts have no tokens and no piece; a null doc_id is packed like any other and
reported as null; repeated rows are packed as often as they occur; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from bisect import bisect_right, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

CAPACITY = 2048
#: Pieces packed together in one task.
SHARD_PIECES = 20_000

_BINS = "round int, shard int, bin int, slot int, doc_id long, piece int, n_tokens int, fill int"


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing; bins as lists of indexes."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), ascending
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        at = bisect_right(room, (sizes[i], -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if free > sizes[i]:
            insort(room, (free - sizes[i], b))
    return bins


def _two_of_each(bin_: list[int], sizes: list[int]) -> list[int]:
    """Pieces of one size are interchangeable: two of each size stand for a bin, at most some 2 * sqrt(2 * capacity)."""
    seen: dict[int, int] = {}
    out = []
    for i in bin_:
        seen[sizes[i]] = seen.get(sizes[i], 0) + 1
        if seen[sizes[i]] <= 2:
            out.append(i)
    return out


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Moves and exchanges between underfull bins while the sum of squared fills grows."""
    bins = [list(b) for b in bins]
    fill = [sum(sizes[i] for i in b) for b in bins]
    while True:
        order = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=lambda b: (-fill[b], b))
        singles = sorted((sizes[i], i) for b in order for i in bins[b])
        home = {i: b for b in order for i in bins[b]}
        pairs = sorted((sizes[x] + sizes[y], x, y) for own in (_two_of_each(bins[b], sizes) for b in order) for n, x in enumerate(own) for y in own[:n])
        improved = False
        for b in order:
            for i in bins[b]:
                singles.pop(bisect_right(singles, (sizes[i], i)) - 1)
                del home[i]
            while bins[b] and fill[b] < capacity:
                free = capacity - fill[b]
                mine = _two_of_each(bins[b], sizes)
                outs = [((), 0), *(((i,), sizes[i]) for i in mine)]
                twos = [((x, y), sizes[x] + sizes[y]) for n, x in enumerate(mine) for y in mine[:n]]
                best = (0, (), ())
                for out, given in outs + twos:
                    at = bisect_right(singles, (free + given, 1 << 62)) - 1
                    if at >= 0 and singles[at][0] - given > best[0]:
                        best = (singles[at][0] - given, out, (singles[at][1],))
                for out, given in outs:
                    at = bisect_right(pairs, (free + given, 1 << 62, 0)) - 1
                    while at >= 0 and pairs[at][0] - given > best[0]:
                        _, x, y = pairs[at]
                        if x in home and home[x] == home.get(y):
                            best = (pairs[at][0] - given, out, (x, y))
                            break
                        at -= 1
                gain, out, taken = best
                if not gain:
                    break
                a = home[taken[0]]
                for i in taken:
                    bins[a].remove(i)
                    bins[b].append(i)
                    singles.pop(bisect_right(singles, (sizes[i], i)) - 1)
                    del home[i]
                for i in out:
                    bins[b].remove(i)
                    bins[a].append(i)
                    insort(singles, (sizes[i], i))
                    home[i] = a
                fill[a] -= gain
                fill[b] += gain
                improved = True
        if not improved:
            return [b for b in bins if b]


def pieces(docs: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece, n_tokens): whole documents, or full pieces and the rest of longer ones."""
    count = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit("[^ \\t\\n\\x0B\\f\\r]+")), F.lit(0))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), count.alias("n")).where("n > 0")
    last = F.floor((F.col("n") - 1) / capacity).cast("int")
    cut = sized.select("doc_id", "n", last.alias("last"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    return cut.select("doc_id", "piece", F.when(F.col("piece") < F.col("last"), capacity).otherwise(F.col("n") - F.col("last") * capacity).cast("int").alias("n_tokens"))


def packed(docs: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """(bin_id, slot, doc_id, piece, n_tokens, start): every piece and its place; ``start`` is its first token's
    position in the bin."""

    def pack(key, table):
        table = table.sort_values(["doc_id", "piece", "n_tokens"], na_position="first", kind="stable").reset_index(drop=True)
        sizes = table["n_tokens"].tolist()
        bins = local_search(best_fit(sizes, capacity), sizes, capacity)
        at = [i for b in bins for i in b]
        out = table.loc[at, ["doc_id", "piece", "n_tokens"]].reset_index(drop=True)
        out["bin"] = [k for k, b in enumerate(bins) for _ in b]
        out["slot"] = [k for b in bins for k in range(len(b))]
        out["fill"] = out.groupby("bin")["n_tokens"].transform("sum")
        return out.assign(round=key[0], shard=key[1])[["round", "shard", "bin", "slot", "doc_id", "piece", "n_tokens", "fill"]]

    left = stored(pieces(docs, capacity), "packing-pieces")
    done, turn = [], 0
    while True:
        shards = max(1, -(-left.count() // shard_pieces))
        shard = F.pmod(F.xxhash64(F.lit(turn), "doc_id", "piece", "n_tokens"), F.lit(shards)).cast("int")
        bins = left.withColumn("round", F.lit(turn)).withColumn("shard", shard).groupBy("round", "shard").applyInPandas(pack, _BINS)
        bins = stored(bins, f"packing-{turn}")
        if shards == 1:
            done.append(bins)
            break
        done.append(bins.where(F.col("fill") == capacity))
        left, turn = bins.where(F.col("fill") < capacity).select("doc_id", "piece", "n_tokens"), turn + 1
        if turn > 1 and -(-left.count() // shard_pieces) >= shards:  # nothing fills up any more
            done.append(bins.where(F.col("fill") < capacity))
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    bin_id = F.shiftleft(F.col("round").cast("long"), 58) + F.shiftleft(F.col("shard").cast("long"), 30) + F.col("bin")
    start = F.expr("sum(n_tokens) OVER (PARTITION BY bin_id ORDER BY slot) - n_tokens").cast("int")
    return out.withColumn("bin_id", bin_id).select("bin_id", "slot", "doc_id", "piece", "n_tokens", start.alias("start"))
