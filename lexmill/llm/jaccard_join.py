"""N-gram Jaccard self-join by token-combination prefixes.

Documents are sets of word n-grams (lower-cased runs of letters, digits and non-ASCII characters), called tokens here; the
join finds every two sets with a Jaccard similarity of at least ``threshold``, exactly.

Tokens of all sets are in one global order, rare ones first, by their exact counts over the table. The counts come from a packed
exchange: every token goes to the bucket of its hash (5 bytes, and 6 for each document in a bucket), and those that
more than one document has come back to their documents with their counts. A set of m tokens must share at least threshold *
m of them, so that a document with fewer of those is done. The tokens of the others, 6 bytes each, are all that is needed from
here on; texts are read once and never cross the network.

A set x that is similar to y misses at most tau = m - ceil(threshold * m) of its tokens in y. Tokens with more than OFTEN
documents are frequent and form groups; x indexes single rare tokens, and for frequent ones the
2-combinations within a group, of a prefix so long that not sharing any index entry would mean missing more than
tau: a token that no other set has adds one to that bound and is no entry, a rare one adds one, a group of j frequent tokens
adds j - 1, so that prefixes extend past tau + 1 tokens as far as frequent tokens are in them. Groups scale with the set: spaces
by powers of two of the size, and each set indexes its own space and the one below, so that any two similar sets have a space in common;
in the lowest spaces, frequent tokens are indexed singly too. Whichever prefix ends first in the global order holds
for both sets, so no similar pair is lost.

Each bucket of the index pairs the sets that share an entry, within the length bound. With every set come its SIGNATURE least
entries: two sets that have some of these in common are a candidate only in the bucket of the least of them, others in each bucket
in which they meet. Every set has a block beforehand, that of the least set with which it shares one of its LABEL least entries, so
that near copies are in few blocks; blocks are bounded in sets and in tokens. Candidates are verified exactly, by pairs of blocks, and a
set is sent only to those in which it has a partner. Where an entry alone brings a 64th of all pairs of two blocks, or a sixteenth of
them are candidates, these are not listed: all sets of the two blocks are compared. So a group of near copies that grows with the table
is never a list of pairs, in no bucket and no block, and what a worker holds does not grow with it. Buckets of the index are bounded in
bytes, not in entries alone: the more buckets, the fewer entries of a set are in one, and what comes with the set weighs ten times an entry.
Blocks return the number of similar documents of each set and one edge for each set of a group, not pairs. Equal sets are one set throughout. Chunks and buckets grow with the square root of the table beyond their least sizes, so
that the packed values keep their size.

Result: (doc_id, class_id, n_links), one row per document: the least doc_id of all documents that are linked to it
directly or through others, and how many other documents are similar to it, those with an equal set included. Similar texts
are compared one by one: in a group of c different near copies that is c * c / 2 comparisons, in blocks, but not as many rows.

Defined results: texts without words, null texts included, have no set, no links and a class of their own; texts shorter
than n words have one n-gram, the whole; rows without doc_id are left out; rows with the same doc_id and set are one document;
those with the same doc_id and different sets are documents of their own with a row each, which may be linked to one another; of a doc_id
that has sets, texts without words give no row; an empty table gives no rows; other columns are ignored by ``linked`` and
kept by ``keep_one`` and ``keep_one_row``.

Tokens are told apart by 64-bit hashes, cut to 40 bits within a bucket of the count and to 48 bits in the comparison of two sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bucket, components, exchange_sizes, stored, text_bytes
from .kernels import U, WORD, group_roots, lean, long, mix, pieces, row_starts, short, span_hashes, thin, tokens, utf8, windows

NGRAM = 4
THRESHOLD = 0.5
#: Tokens of more documents than this are frequent.
OFTEN = 64
#: Least numbers of tokens, or index entries, that share a bucket and that a map task packs together.
BUCKET_TOKENS = 1 << 20
CHUNK_TOKENS = 1 << 19
#: Sets that share a block of the verification, and their tokens on average at most.
BLOCK_DOCS = 2048
BLOCK_TOKENS = 512
#: Sets of fewer than 2^_TINY tokens are in spaces without combinations; a group has about _GROUP tokens.
_TINY = 3
_GROUP = 4
#: Least entries of a set that travel with its other entries, 6 bytes each.
SIGNATURE = 6
#: Least entries of a set by which it finds its block.
LABEL = 16
#: Bytes that a set adds to each bucket of the index in which it has entries, and that a bucket may have for each of BUCKET_TOKENS.
MEMBER_BYTES = 22 + 6 * SIGNATURE
BUCKET_BYTES = 16
_NONE = U((1 << 48) - 1)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the n-grams of each row, repeats included; a shorter text is one n-gram."""
    start, end, row = tokens(data, offsets, WORD)
    word = span_hashes(data, start, end)
    hashed, first = windows(word, row, n)
    hashes, rows = [hashed], [row[first]]
    count = np.bincount(row, minlength=len(offsets) - 1)
    for k in range(1, n):
        hashed, first = windows(word, row, k)
        short = count[row[first]] == k
        hashes.append(hashed[short])
        rows.append(row[first][short])
    return np.concatenate(hashes), np.concatenate(rows)


def sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each row's distinct n-grams, by row, then hash."""
    hashed, row = shingles(data, offsets, n)
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    return hashed[new], row[new]


def fingerprints(hashed: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each row's whole set, and its size."""
    starts = row_starts(row, n_rows)
    total = np.zeros(len(hashed) + 1, U)
    np.cumsum(mix(hashed + U(1)), out=total[1:])
    size = np.diff(starts)
    return mix((total[starts[1:]] - total[starts[:-1]]) ^ size.astype(U)).view(np.int64), size


def _needed(size: np.ndarray, threshold: float) -> np.ndarray:
    return np.ceil(threshold * size - 1e-9).astype(np.int64)


def index_entries(hashed: np.ndarray, row: np.ndarray, frequent: np.ndarray, size: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(entry, row): what the prefix of each set puts into the index. Tokens come by row, then global order, without those
    that no other set has, which are the first of their set and use up its prefix; ``size`` counts them too."""
    n_rows = len(size)
    starts = row_starts(row, n_rows)
    tau = size - _needed(size, threshold) - (size - np.diff(starts))
    place = np.arange(len(row)) - starts[row]
    base = place <= tau[row]
    hot_row = np.zeros(n_rows, bool)
    hot_row[row[base & frequent]] = True
    plain = base & ~hot_row[row]
    entries, rows = [hashed[plain]], [row[plain]]
    hot = np.flatnonzero(hot_row[row])
    if len(hot):
        h, r, often = hashed[hot], row[hot], frequent[hot]
        first_of_row = np.searchsorted(r, r)
        level = np.floor(np.log2(np.maximum(size[r], 1))).astype(np.int64)
        rare = np.zeros(len(h), bool)
        for down in (0, 1):
            space = level - down
            tiny = space < _TINY
            group = (h >> U(40)) % np.maximum(U(1), (U(1) << np.maximum(space, 0).astype(U)) // U(_GROUP))
            adds = np.ones(len(h), np.int64)
            mixed = np.flatnonzero(often & ~tiny)
            both = mix(group[mixed]) ^ mix(r[mixed].astype(U) + U(1 << 40))
            adds[mixed[np.unique(both, return_index=True)[1]]] = 0
            upto = np.cumsum(adds)
            before = upto - adds - (upto - adds)[first_of_row]
            prefix = before <= tau[r]
            rare |= prefix & ~often
            single = prefix & often & tiny
            entries.append(mix(h[single] + U(0x51ED)))
            rows.append(r[single])
            pair = np.flatnonzero(prefix & often & ~tiny)
            pair = pair[np.lexsort((h[pair], group[pair], r[pair]))]
            g, ph, pr, ps = group[pair], h[pair], r[pair], space[pair].astype(U)
            step = 1
            while step < len(pair):
                same = (g[step:] == g[:-step]) & (pr[step:] == pr[:-step])
                if not same.any():
                    break
                entries.append(mix(mix(ph[:-step][same]) * U(3) + ph[step:][same] + (ps[step:][same] << U(56))))
                rows.append(pr[step:][same])
                step += 1
        entries.append(h[rare])
        rows.append(r[rare])
    return np.concatenate(entries), np.concatenate(rows)


def runs(member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, length) of the runs of an array, none longer than 65,535."""
    head = np.flatnonzero(np.diff(member, prepend=-1))
    n = np.diff(np.append(head, len(member)))
    parts = np.maximum(1, -(-n // 0xFFFF))
    last = np.cumsum(parts) - 1
    lengths = np.full(int(parts.sum()), 0xFFFF, np.int64)
    lengths[last] = n - (parts - 1) * 0xFFFF
    return np.repeat(member[head], parts), lengths


def rarity(count: np.ndarray) -> np.ndarray:
    """A byte that ascends with the count: itself up to 128, then eight steps for each doubling."""
    steps = 128 + np.floor(np.log2(np.maximum(count, 128) / 128.0) * 8)
    return np.where(count <= 128, count, np.minimum(steps, 255)).astype(np.uint8)


def combinations(key: np.ndarray, most: int = 500_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places a < b of equal keys in a sorted array, about ``most`` at a time."""
    end = np.searchsorted(key, key, "right") if len(key) else np.zeros(0, np.int64)
    left = end - np.arange(len(key)) - 1  # partners after each one
    total = np.cumsum(left)
    at = 0
    while at < len(key):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
        n = left[at:to]
        a = np.repeat(np.arange(at, to), n)
        yield a, a + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = to


def fewer(parts: Iterator[np.ndarray], most: int = 2_000_000) -> Iterator[np.ndarray]:
    """The values of all parts in fewer, without most of the repeats; about twice ``most`` values are held."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part)
        if n > most:
            held = [np.unique(np.concatenate(held))]
            n = len(held[0])
            if n > most // 2:
                yield held[0]
                held, n = [], 0
    if n:
        yield np.unique(np.concatenate(held))


def pairs_of(entry: np.ndarray, member: np.ndarray, size: np.ndarray, threshold: float, most: int = 500_000, small: int = 24) -> np.ndarray:
    """Pairs (a << 32 | b, a < b) of members that share an entry and whose sizes allow the threshold."""
    return np.unique(np.concatenate([np.zeros(0, np.int64), *pair_parts(entry, member, size, threshold, most, small)]))


def pair_parts(entry: np.ndarray, member: np.ndarray, size: np.ndarray, threshold: float, most: int = 500_000, small: int = 24) -> Iterator[np.ndarray]:
    """The pairs of ``pairs_of`` in parts, some of them in several.

    Entries with up to ``small`` members are paired one by one. Larger ones mostly have the same members, near copies, which would meet
    hundreds of times: of every group of members that such entries link, the matrix of members by entries is multiplied with its
    transpose, where that is less work."""
    order = np.lexsort((member, entry))
    e, m = entry[order], member[order].astype(np.int64)
    new = np.ones(len(e), bool)
    new[1:] = (e[1:] != e[:-1]) | (m[1:] != m[:-1])
    e, m = e[new], m[new]
    head = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]])) if len(e) else np.zeros(0, np.int64)
    length = np.diff(np.append(head, len(e)))
    n_of = np.repeat(length, length)
    large = np.flatnonzero(n_of > small)
    if len(large):
        number = np.repeat(np.arange(len(length)), length)[large]
        who, own = np.unique(m[large], return_inverse=True)
        root = group_roots(len(who), own, np.repeat(own[np.searchsorted(number, np.unique(number))], length[length > small]))
        group = root[own]
        order = np.argsort(group, kind="stable")
        edge = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
        single = np.zeros(len(e), bool)
        for s, t in zip(edge[:-1], edge[1:]):
            at = order[s:t]
            docs, row = np.unique(own[at], return_inverse=True)
            entries, col = np.unique(number[at], return_inverse=True)
            if len(docs) ** 2 * len(entries) > 500.0 * float((length[entries] ** 2).sum()):
                single[large[at]] = True  # few of the members share each entry
            else:
                yield from _multiplied(row, col, who[docs], len(entries), size, threshold)
        single |= n_of <= small
        e, m = e[single], m[single]
    keep = np.zeros(len(e), bool)
    keep[1:] = e[1:] == e[:-1]
    keep[:-1] |= keep[1:]
    e, m = e[keep], m[keep]
    for a, b in combinations(e, most):
        a, b = m[a], m[b]
        ok = _near(size[a], size[b], threshold)
        yield np.unique(a[ok] << 32 | b[ok])


def _near(one: np.ndarray, two: np.ndarray, threshold: float) -> np.ndarray:
    return np.minimum(one, two) >= threshold * np.maximum(one, two) - 1e-9


def pairs_by_block(entry: np.ndarray, member: np.ndarray, block: np.ndarray, size: np.ndarray, threshold: float, dense: int, most: int = 500_000) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """Pairs of blocks (one row each, the lesser first) of which an entry has ``dense`` pairs of members or more, and the pairs of
    ``pairs_of``, in parts, of members in other blocks. ``block``: of each member."""
    names, of = np.unique(block, return_inverse=True)
    order = np.lexsort((member, of[member], entry))
    e, m = entry[order], member[order].astype(np.int64)
    new = np.ones(len(e), bool)
    new[1:] = (e[1:] != e[:-1]) | (m[1:] != m[:-1])
    e, m = e[new], m[new]
    # units: the members of an entry in a block
    head = np.ones(len(e), bool)
    head[1:] = (e[1:] != e[:-1]) | (of[m[1:]] != of[m[:-1]])
    begin = np.flatnonzero(head)
    n, key, where = np.diff(np.append(begin, len(e))), e[begin], of[m[begin]]
    first = np.searchsorted(key, key)
    largest = np.maximum.reduceat(n, np.unique(first))[np.unique(first, return_inverse=True)[1]] if len(n) else n
    big = np.flatnonzero(n * largest >= dense)
    codes = [(where[big] * len(names) + where[big])[(n[big] > 1) & (n[big] ** 2 >= dense)]]
    for a, b in combinations(key[big], most):
        some = n[big[a]] * n[big[b]] >= dense
        codes.append(np.unique(where[big[a[some]]] * len(names) + where[big[b[some]]]))
    codes = np.unique(np.concatenate(codes))
    hot = np.zeros(len(names), bool)
    hot[codes // max(1, len(names))] = hot[codes % max(1, len(names))] = True
    mixed = np.zeros(len(n), bool)
    if len(codes):
        mixed = (np.bincount(first, hot[where], len(n)) > 0)[first]

    def rest() -> Iterator[np.ndarray]:
        plain = np.repeat(~mixed, n)
        yield from pair_parts(e[plain], m[plain], size, threshold, most)
        own = np.flatnonzero(mixed)
        yield from members(own, own)
        for a, b in combinations(key[own], most):
            yield from members(own[a], own[b])

    def members(u: np.ndarray, v: np.ndarray) -> Iterator[np.ndarray]:
        """Pairs of members of two units each, where their blocks are not among the dense ones."""
        keep = ~np.isin(where[u] * len(names) + where[v], codes) & ((u != v) | (n[u] > 1))
        u, v = u[keep], v[keep]
        total = np.cumsum(n[u] * n[v])
        at = 0
        while at < len(u):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
            x, y = u[at:to], v[at:to]
            each = n[x] * n[y]
            place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            width = np.repeat(n[y], each)
            a, b = m[np.repeat(begin[x], each) + place // width], m[np.repeat(begin[y], each) + place % width]
            ok = (a != b) & _near(size[a], size[b], threshold)
            yield np.unique(np.minimum(a, b)[ok] << 32 | np.maximum(a, b)[ok])
            at = to

    return np.stack([names[codes // len(names)], names[codes % len(names)]], 1) if len(codes) else np.zeros((0, 2), np.int64), rest()


def _multiplied(row: np.ndarray, col: np.ndarray, docs: np.ndarray, width: int, size: np.ndarray, threshold: float, block: int = 1024, columns: int = 4096) -> Iterator[np.ndarray]:
    """Pairs of the group of members ``docs``, which have an entry where (row, col) says; memory is a few blocks."""
    columns = min(columns, width)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    parts = [(row[i:j], col[i:j] - c) for c in range(0, width, columns) for i, j in [np.searchsorted(col, [c, c + columns])]]
    for s in range(0, len(docs), block):
        for t in range(s, len(docs), block):
            share = 0
            for r, c in parts:
                one = np.zeros((min(block, len(docs) - s), columns), np.float32)
                mine = (r >= s) & (r < s + block)
                one[r[mine] - s, c[mine]] = 1
                two = one
                if t > s:
                    two = np.zeros((min(block, len(docs) - t), columns), np.float32)
                    mine = (r >= t) & (r < t + block)
                    two[r[mine] - t, c[mine]] = 1
                share = share + one @ two.T
            i, j = np.nonzero(share)
            a, b = docs[s + i], docs[t + j]
            ok = (a < b) & _near(size[a], size[b], threshold)
            yield a[ok] << 32 | b[ok]


def shared_tokens(token: np.ndarray, row: np.ndarray, n: int, n_one: int, same: bool, columns: int = 2048) -> np.ndarray:
    """How many tokens the first ``n_one`` of n sets share with all, if ``same``, or with the others. ``row`` is the set of each token, ascending.
    Tokens of many sets are counted by the product of matrices, others pair by pair; where two of the same side meet, that
    counts only if ``same``, and then for the first of them."""
    lo = 0 if same else n_one
    out = np.zeros((n_one, n - lo), np.float32)
    count = np.bincount(token)
    many = count > math.isqrt(max(1, n_one * (n - lo)) // 64) + 1
    column = np.cumsum(many) - 1
    some = np.flatnonzero(many[token])
    some = some[np.argsort(column[token[some]], kind="stable")]
    r, c = row[some], column[token[some]]
    for s in range(0, int(many.sum()), columns):
        i, j = np.searchsorted(c, [s, s + columns])
        has = np.zeros((n, min(columns, int(many.sum()) - s)), np.float32)
        has[r[i:j], c[i:j] - s] = 1
        out += has[:n_one] @ has[lo:].T
    some = np.flatnonzero(~many[token] & (count[token] > 1))
    some = some[np.argsort(token[some], kind="stable")]
    r = row[some]
    for a, b in combinations(token[some]):
        a, b = r[a], r[b]
        if not same:
            across = (a < n_one) & (b >= n_one)
            a, b = a[across], b[across]
        np.add.at(out.reshape(-1), a * (n - lo) + b - lo, np.float32(1))
    return out


def least_common(one: np.ndarray, two: np.ndarray, block: int = 1 << 17) -> np.ndarray:
    """Least value that two rows of signatures, padded with _NONE, have in common; _NONE where there is none."""
    out = np.full(len(one), _NONE, U)
    for s in range(0, len(one), block):
        a, b = one[s : s + block], two[s : s + block]
        for i in range(a.shape[1]):
            x = a[:, i]
            hit = (b == x[:, None]).any(1) & (x != _NONE)
            out[s : s + block] = np.where(hit, np.minimum(out[s : s + block], x), out[s : s + block])
    return out


def _clean(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.col("text").cast("string")).alias("text")).where(F.col("doc_id").isNotNull())


def token_sets(docs: DataFrame, n: int, threshold: float, bucket_tokens: int = BUCKET_TOKENS, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """(chunk, nth, doc_id, print, size, tokens, n_rare): every document that has a set, with the fingerprint and size of
    it; (chunk, nth) identify the row. ``tokens`` are the n-grams that other sets have too, 6 bytes each, by exact count
    over the table and then by hash, the first ``n_rare`` of them rare; null where there are too few for any partner."""
    buckets, chunk_tokens = exchange_sizes(text_bytes(docs) // 6, bucket_tokens, chunk_tokens)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, rows, held_tokens = TaskContext.get().partitionId(), 0, [], 0, 0

        def flush():
            hashed, number, ids, prints, size = (np.concatenate(x) for x in zip(*held))
            chunk = int(mix(np.array([part << 32 | nth], U))[0] ^ np.bitwise_xor.reduce(mix(ids.view(U) + prints.view(U)))) >> 1
            bucket = (hashed % U(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
            order = np.argsort(bucket, kind="stable")
            token, number, bucket = (hashed // U(buckets))[order], number[order], bucket[order]
            starts = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
            edges = np.append(starts, len(order)).tolist()
            full = bucket[starts].tolist() if len(order) else []
            out = {"bucket": full, "chunk": [chunk] * len(full), "kind": [0] * len(full), "a": [], "b": [], "c": []}
            for i in range(len(full)):
                member, length = runs(number[edges[i] : edges[i + 1]])
                out["a"].append(short(token[edges[i] : edges[i + 1]], 5))
                out["b"].append(member.astype(np.uint32).tobytes())
                out["c"].append(length.astype(np.uint16).tobytes())
            for k, v in zip(out, (chunk % buckets, chunk, 1, ids.tobytes(), prints.tobytes(), size.astype(np.uint32).tobytes())):
                out[k].append(v)
            return pa.RecordBatch.from_pydict({k: pa.array(v, {"bucket": pa.int32(), "chunk": pa.int64(), "kind": pa.int32()}.get(k, pa.binary())) for k, v in out.items()})

        for batch in batches:
            for piece in pieces(batch):
                hashed, row = sets(*utf8(piece.column("text")), n)
                prints, size = fingerprints(hashed, row, piece.num_rows)
                held.append((mix(hashed), row + rows, piece.column("doc_id").to_numpy().astype(np.int64), prints, size))
                rows += piece.num_rows
                held_tokens += len(hashed)
                if held_tokens >= chunk_tokens or rows >= chunk_tokens:
                    yield flush()
                    held, rows, held_tokens, nth = [], 0, 0, nth + 1
        if held:
            yield flush()

    def count(table: pa.Table) -> pa.Table:
        lean()
        bucket = U(table.column("bucket")[0].as_py())
        kind, chunk = table.column("kind").to_numpy(), table.column("chunk").to_numpy()
        a, b, c = (table.column(k) for k in "abc")
        own = np.flatnonzero(kind == 0)
        token = long(b"".join(a[i].as_py() for i in own), 5)
        ends = np.cumsum([len(a[i].as_buffer()) // 5 for i in own], dtype=np.int64)
        order = np.argsort(token)
        ordered = token[order]
        head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(order) else order
        length = np.diff(np.append(head, len(order)))
        code = np.empty(len(order), np.uint8)
        code[order] = np.repeat(rarity(length), length)
        token = mix(token * U(buckets) + bucket)
        out = {k: [] for k in ("chunk", "kind", "a", "b", "c", "d")}
        for i, s, e in zip(own.tolist(), (ends - np.diff(ends, prepend=0)).tolist(), ends.tolist()):
            some = np.flatnonzero(code[s:e] > 1)
            if len(some):
                number = np.repeat(np.frombuffer(b[i].as_py(), np.uint32), np.frombuffer(c[i].as_py(), np.uint16))
                member, length = runs(number[some].astype(np.int64))
                for k, v in zip(out, (chunk[i], 0, short(token[s:e][some], 6), code[s:e][some].tobytes(), member.astype(np.uint32).tobytes(), length.astype(np.uint16).tobytes())):
                    out[k].append(v)
        for i in np.flatnonzero(kind == 1).tolist():
            for k, v in zip(out, (chunk[i], 1, a[i].as_py(), b[i].as_py(), c[i].as_py(), b"")):
                out[k].append(v)
        return pa.table({k: pa.array(v, {"chunk": pa.int64(), "kind": pa.int32()}.get(k, pa.binary())) for k, v in out.items()})

    def gather(table: pa.Table) -> pa.Table:
        lean()
        kind = table.column("kind").to_numpy()
        a, b, c, d = (table.column(k) for k in "abcd")
        meta = np.flatnonzero(kind == 1)
        if len(meta) != 1:
            raise RuntimeError("a chunk came without its documents: the input gave other rows when it was read again")
        ids, prints, size = (np.frombuffer(x[int(meta[0])].as_py(), t) for x, t in ((a, np.int64), (b, np.int64), (c, np.uint32)))
        own = np.flatnonzero(kind == 0).tolist()
        token = long(b"".join(a[i].as_py() for i in own), 6)
        code = np.frombuffer(b"".join(b[i].as_py() for i in own), np.uint8)
        number = np.repeat(np.frombuffer(b"".join(c[i].as_py() for i in own), np.uint32), np.frombuffer(b"".join(d[i].as_py() for i in own), np.uint16)).astype(np.int64)
        left = np.bincount(number, minlength=len(ids))
        may = (size > 0) & (left >= _needed(size.astype(np.int64), threshold))
        some = np.flatnonzero(may[number])
        token, code, number = token[some], code[some], number[some]
        order = np.lexsort((token, code, number))
        token, code, number = token[order], code[order], number[order]
        edges = row_starts(number, len(ids))
        rare = np.bincount(number[code <= OFTEN], minlength=len(ids))
        full = np.flatnonzero(size > 0)
        data = short(token, 6)
        return pa.table(
            {
                "chunk": pa.array(np.full(len(full), table.column("chunk")[0].as_py()), pa.int64()),
                "nth": pa.array(full, pa.int32()),
                "doc_id": pa.array(ids[full], pa.int64()),
                "print": pa.array(prints[full], pa.int64()),
                "size": pa.array(size[full], pa.int64()),
                "tokens": pa.array([data[6 * edges[i] : 6 * edges[i + 1]] if may[i] else None for i in full.tolist()], pa.binary()),
                "n_rare": pa.array(rare[full], pa.int64()),
            }
        )

    packed = docs.mapInArrow(pack, "bucket int, chunk long, kind int, a binary, b binary, c binary")
    counted = by_bucket(packed, buckets).applyInArrow(count, "chunk long, kind int, a binary, b binary, c binary, d binary")
    return counted.groupBy("chunk").applyInArrow(gather, "chunk long, nth int, doc_id long, print long, size long, tokens binary, n_rare long")


def indexed(sets_: DataFrame, threshold: float) -> DataFrame:
    """(print, size, entries): of every set that may have partners its index entries, 6 bytes each, ascending."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                data = part.column("tokens").to_pylist()
                token = mix(long(b"".join(data), 6))
                n = np.array([len(x) // 6 for x in data])
                row = np.repeat(np.arange(len(data)), n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                size, rare = part.column("size").to_numpy(), part.column("n_rare").to_numpy()
                entry, owner = index_entries(token, row, place >= rare[row], size, threshold)
                entry = mix(entry) >> U(16)
                order = np.lexsort((entry, owner))
                entry, owner = entry[order], owner[order]
                new = np.concatenate([[True], (entry[1:] != entry[:-1]) | (owner[1:] != owner[:-1])]) if len(entry) else np.zeros(0, bool)
                edges = (6 * row_starts(owner[new], len(data))).tolist()
                flat = short(entry[new], 6)
                yield pa.RecordBatch.from_pydict({"print": part.column("print"), "size": part.column("size"), "entries": pa.array([flat[a:b] for a, b in zip(edges[:-1], edges[1:])], pa.binary())})

    own = sets_.where("tokens IS NOT NULL").select("print", "size", "tokens", "n_rare")
    entries = own.mapInArrow(index, "print long, size long, entries binary").where(F.octet_length("entries") > 0)
    return entries.groupBy("print").agg(F.max("size").alias("size"), F.max("entries").alias("entries"))


def blocks_of(index: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(print, block): of sets that share one of their least entries mostly the same block. Sets of a label that are many, or have many
    tokens, have blocks of their own; others share blocks that are half full on average."""
    own = index.select("print", "size", F.expr(f"explode(transform(sequence(0, least({LABEL}, cast(octet_length(entries) / 6 as int)) - 1), i -> substring(entries, 6 * i + 1, 6))) AS entry"))
    head = own.groupBy("entry").agg(F.min("print").alias("head"))
    label = stored(own.join(head, "entry").groupBy("print").agg(F.max("size").alias("size"), F.min("head").alias("label")), "jaccard-labels")
    weight = F.greatest(F.count("*") / F.lit(block_docs), F.sum("size") / F.lit(block_docs * BLOCK_TOKENS))
    small = max(1, math.ceil(2 * (label.agg(weight).first()[0] or 0)))
    parts = label.groupBy("label").agg(weight.alias("weight"))
    block = F.when(F.col("weight") > 0.25, F.xxhash64("label", F.pmod("print", F.ceil("weight")))).otherwise(F.pmod(F.xxhash64("label"), F.lit(small)))
    return stored(label.join(parts, "label").select("print", block.alias("block")), "jaccard-blocks")


def index_sizes(entries: int, n_sets: int, bucket: int, chunk: int) -> tuple[int, int]:
    """Number of buckets and entries of a chunk for an index of so many entries of so many sets.

    A set comes to each bucket in which it has entries once, with MEMBER_BYTES. In few buckets it has several in each, in
    many mostly one, so that the bytes of an entry grow from 6 to 64 with the table. Buckets get as many as keep theirs at
    BUCKET_BYTES * ``bucket``; sets of unequal numbers of entries bring less than is counted here."""
    buckets, chunk_entries = exchange_sizes(entries, bucket, chunk)
    each = entries / max(1, n_sets)
    while True:
        met = n_sets * (buckets * -math.expm1(each * math.log1p(-1 / buckets)) if buckets > 1 else 1)
        more, _ = exchange_sizes(max(entries, math.ceil((6 * entries + MEMBER_BYTES * met) / BUCKET_BYTES)), bucket, chunk)
        if more <= buckets:
            return buckets, chunk_entries
        buckets = more


def candidates(index: DataFrame, blocks: DataFrame, threshold: float, bucket_tokens: int = BUCKET_TOKENS, chunk_tokens: int = CHUNK_TOKENS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(block_a, block_b, a, b): pairs of set fingerprints, a < b, that share an index entry, each pair once, and the lesser and the
    greater of their blocks; a and b are null where all sets of two blocks are to be compared, beside some of their pairs."""
    total, n_sets = index.agg(F.sum(F.octet_length("entries") / 6), F.count("*")).first()
    buckets, chunk_tokens = index_sizes(int(total or 0), n_sets, bucket_tokens, chunk_tokens)
    dense = max(1, block_docs**2 // 64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        held, rows, held_entries = [], 0, 0

        def flush():
            entry, number, prints, size, block, sign = (np.concatenate(x) for x in zip(*held))
            bucket = (entry % U(buckets)).astype(np.int64)
            order = np.lexsort((number, bucket))
            entry, number, bucket = entry[order], number[order], bucket[order]
            starts = np.flatnonzero(np.diff(bucket, prepend=-1))
            edges = np.append(starts, len(order)).tolist()
            out = {k: [] for k in ("bucket", "entry", "length", "print", "size", "block", "sign")}
            for i, b in enumerate(bucket[starts].tolist()):
                member, length = runs(number[edges[i] : edges[i + 1]])
                for k, v in zip(out, (b, short(entry[edges[i] : edges[i + 1]], 6), length.astype(np.uint16).tobytes(), prints[member].tobytes(), size[member].astype(np.uint32).tobytes(), block[member].tobytes(), short(sign[member].reshape(-1), 6))):
                    out[k].append(v)
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "bucket" else pa.binary()) for k, v in out.items()})

        for batch in batches:
            for s in range(0, batch.num_rows, 256):
                part = batch.slice(s, 256)
                data = part.column("entries").to_pylist()
                entry = long(b"".join(data), 6)
                owner = np.repeat(np.arange(len(data)), [len(x) // 6 for x in data])
                nth = np.arange(len(owner)) - row_starts(owner, len(data))[owner]
                sign = np.full((len(data), SIGNATURE), _NONE, U)
                sign[owner[nth < SIGNATURE], nth[nth < SIGNATURE]] = entry[nth < SIGNATURE]
                held.append((entry, owner + rows, *(part.column(k).to_numpy() for k in ("print", "size", "block")), sign))
                rows += part.num_rows
                held_entries += len(entry)
                if held_entries >= chunk_tokens:
                    yield from thin(flush())
                    held, rows, held_entries = [], 0, 0
        if held:
            yield from thin(flush())

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean()
        table = pa.Table.from_batches(batches)
        bucket = U(table.column("bucket")[0].as_py())
        entry, length, prints, size, block, sign = (b"".join(table.column(k).to_pylist()) for k in ("entry", "length", "print", "size", "block", "sign"))
        del table
        known, first, number = np.unique(np.frombuffer(prints, np.int64), return_index=True, return_inverse=True)
        size = np.frombuffer(size, np.uint32).astype(np.int64)[first]
        block = np.frombuffer(block, np.int64)[first]
        sign = long(sign, 6).reshape(-1, SIGNATURE)[first]
        whole, parts = pairs_by_block(long(entry, 6), np.repeat(number, np.frombuffer(length, np.uint16)), block, size, threshold, dense)
        none = pa.nulls(len(whole), pa.int64())
        yield pa.RecordBatch.from_pydict({"block_a": pa.array(whole[:, 0]), "block_b": pa.array(whole[:, 1]), "a": none, "b": none})

        def here() -> Iterator[np.ndarray]:
            for found in parts:
                common = least_common(sign[found >> 32], sign[found & 0xFFFFFFFF])
                yield found[(common == _NONE) | (common % U(buckets) == bucket)]

        for found in fewer(here()):
            for s in range(0, len(found), 1 << 16):
                one, two = found[s : s + (1 << 16)] >> 32, found[s : s + (1 << 16)] & 0xFFFFFFFF
                yield pa.RecordBatch.from_pydict({"block_a": np.minimum(block[one], block[two]), "block_b": np.maximum(block[one], block[two]), "a": known[one], "b": known[two]})

    packed = index.join(blocks, "print").mapInArrow(pack, "bucket int, entry binary, length binary, print binary, size binary, block binary, sign binary")
    return by_bucket(packed, buckets).applyInArrow(pair, "block_a long, block_b long, a long, b long").distinct()


def linked_sets(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD, bucket_tokens: int = BUCKET_TOKENS, chunk_tokens: int = CHUNK_TOKENS, block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame]:
    """(doc_id, print) of every document that has a set, and (print, docs, first, root, links): of every set how many
    documents have it, the first of them, the root of its group and how many documents with other sets are similar."""
    if not 0.5 <= threshold <= 1:
        raise ValueError("the threshold must be in [0.5, 1]")
    found = stored(token_sets(_clean(docs), ngram, threshold, bucket_tokens, chunk_tokens), "jaccard-sets")
    members = found.select("doc_id", "print").distinct()
    known = members.groupBy("print").agg(F.count("*").alias("docs"), F.min("doc_id").alias("first"))
    index = stored(indexed(found, threshold), "jaccard-index")
    label = blocks_of(index, block_docs)
    pairs = stored(candidates(index, label, threshold, bucket_tokens, chunk_tokens, block_docs), "jaccard-candidates")
    both = ["block_a", "block_b"]
    whole = pairs.groupBy(*both).agg(F.count("a").alias("n"), F.max(F.col("a").isNull()).alias("all")).where((F.col("n") > block_docs**2 // 16) | F.col("all"))
    whole = stored(whole.select(*both), "jaccard-whole-blocks")
    listed = pairs.where("a IS NOT NULL").join(whole, both, "left_anti")
    wanted = listed.select(*both, F.explode(F.array("a", "b")).alias("print")).distinct()
    wanted = wanted.unionByName(whole.select(*both, F.explode(F.array_distinct(F.array(*both))).alias("block")).join(label, "block").select(*both, "print"))
    # of the rows that have a set, the tokens of one are read
    row = found.where("tokens IS NOT NULL").groupBy("print").agg(F.min(F.struct("doc_id", "chunk", "nth")).alias("row")).join(known, "print").join(label, "print").select("print", "row.chunk", "row.nth", "docs", "block")
    wanted = wanted.groupBy("print").agg(F.collect_set(F.struct(*both)).alias("at")).join(row, "print").drop("print")
    arrays = found.where("tokens IS NOT NULL").select("chunk", "nth", "print", "size", "tokens").join(wanted, ["chunk", "nth"]).select("print", "size", "tokens", "docs", "block", F.explode("at").alias("at")).select("*", "at.*").drop("at")
    placed = listed.unionByName(whole.select(*both, F.lit(None).cast("long").alias("a"), F.lit(None).cast("long").alias("b")))

    def compared(table: pa.Table, block_a: int, block_b: int) -> pa.Table:
        """All sets of two blocks, or of one."""
        block = table.column("block").to_numpy()
        n_one = int((block == block_a).sum())
        table = table.take(pa.array(np.argsort(block != block_a, kind="stable")))
        prints, size, docs_ = (table.column(k).to_numpy() for k in ("print", "size", "docs"))
        data = table.column("tokens").to_pylist()
        token = np.unique(long(b"".join(data), 6), return_inverse=True)[1].astype(np.int32)
        common = shared_tokens(token, np.repeat(np.arange(len(data)), [len(x) // 6 for x in data]), len(data), n_one, block_a == block_b)
        links, root = np.zeros(len(prints), np.int64), np.arange(len(prints))
        for k in range(n_one):
            lo = k + 1 if block_a == block_b else n_one
            shared = common[k, lo - len(prints) :] if lo < len(prints) else common[k, :0]
            shared = shared.astype(np.int64)
            partners = lo + np.flatnonzero(shared / (size[k] + size[lo:] - shared) >= threshold)
            if len(partners):
                links[k] += docs_[partners].sum()
                links[partners] += docs_[k]
                roots = np.unique(root[np.append(partners, k)])
                if len(roots) > 1:
                    root[np.isin(root, roots)] = roots[0]
        some = np.flatnonzero(links)
        return pa.table({"print": prints[some], "root": prints[root[some]], "links": links[some]})

    def verify(left: pa.Table, right: pa.Table) -> pa.Table:
        lean()
        if left.column("a").null_count:
            return compared(right, *(left.column(k)[0].as_py() for k in both))
        a, b = left.column("a").to_numpy(), left.column("b").to_numpy()
        none = pa.table({"print": pa.array([], pa.int64()), "root": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        if not len(a):
            return none
        prints, size, docs_ = (right.column(k).to_numpy() for k in ("print", "size", "docs"))
        data = right.column("tokens").to_pylist()
        token = np.unique(long(b"".join(data), 6), return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum([len(x) // 6 for x in data])])
        where = np.argsort(prints)
        at = lambda x: where[np.minimum(np.searchsorted(prints[where], x), len(prints) - 1)]
        i, j = (at(a), at(b)) if len(prints) else (a, b)
        if not len(prints) or not ((prints[i] == a) & (prints[j] == b)).all():
            raise RuntimeError("a set of a candidate pair is missing: the input gave other rows when it was read again")
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        held = np.zeros(int(token.max()) + 1, bool)
        shared = np.zeros(len(a), np.int64)
        own_size = np.diff(starts)
        edge = np.flatnonzero(np.diff(i, prepend=-1, append=-1))
        for s, e in zip(edge[:-1], edge[1:]):
            own = token[starts[i[s]] : starts[i[s] + 1]]
            held[own] = True
            for f in range(s, e, 1024):
                js = j[f : min(e, f + 1024)]
                n = own_size[js]
                first = np.cumsum(n) - n
                flat = np.arange(n.sum()) + np.repeat(starts[js] - first, n)
                shared[f : min(e, f + 1024)] = np.add.reduceat(held[token[flat]].astype(np.int64), first)
            held[own] = False
        ok = shared / (size[i] + size[j] - shared) >= threshold
        i, j = i[ok], j[ok]
        if not len(i):
            return none
        links = np.bincount(i, docs_[j], len(prints)) + np.bincount(j, docs_[i], len(prints))
        root = prints[group_roots(len(prints), i, j)]
        some = np.flatnonzero(links > 0)
        return pa.table({"print": prints[some], "root": root[some], "links": links[some].astype(np.int64)})

    unlike = stored(placed.groupBy(*both).cogroup(arrays.groupBy(*both)).applyInArrow(verify, "print long, root long, links long"), "jaccard-links")
    links = unlike.groupBy("print").agg(F.sum("links").alias("links"))
    roots = components(unlike.select("print", "root")).toDF("print", "root")
    known = known.join(links, "print", "left").join(roots, "print", "left")
    return members, known.select("print", "docs", "first", F.coalesce("root", "print").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))


def linked(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD, bucket_tokens: int = BUCKET_TOKENS, chunk_tokens: int = CHUNK_TOKENS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(doc_id, class_id, n_links) as said above."""
    members, known = linked_sets(docs, ngram, threshold, bucket_tokens, chunk_tokens, block_docs)
    classes = known.groupBy("root").agg(F.min("first").alias("class_id"))
    known = known.join(classes, "root").select("print", "class_id", (F.col("docs") - 1 + F.col("links")).alias("n_links"))
    own = members.join(known, "print").select("doc_id", "class_id", "n_links")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
    alone = ids.join(members.select("doc_id"), "doc_id", "left_anti").distinct().select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return own.unionByName(alone)


def keep_one(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without those that are linked, directly or through others, to one with a smaller doc_id.

    Rows with the same doc_id stay or go together; rows without doc_id stay.
    """
    gone = linked(docs, ngram, threshold).groupBy("doc_id").agg(F.min("class_id").alias("first")).where("first < doc_id").select(F.col("doc_id").alias("__lexmill_id"))
    return docs.join(gone, docs["doc_id"].cast("long") == gone["__lexmill_id"], "left_anti")


def keep_one_row(docs: DataFrame, ngram: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each group of equal or similar texts, whatever its rows have as doc_id.

    As ``keep_one``, but rows with the same doc_id and text are one row, and those without doc_id, or with a doc_id that
    has several texts, are documents of their own: they get keys after all doc_ids, in the order of doc_id (nulls last)
    and text hash, so that a row with a doc_id of its own stays rather than they. Of equal rows the one with the least
    hash of all columns stays. Where no room is left after the largest doc_id, every row gets such a key.
    """
    id_, one, two, key, rank = (f"__lexmill_{x}" for x in ("id", "hash", "hash2", "key", "rank"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns({id_: F.col("doc_id").cast("long"), one: F.xxhash64(text), two: F.xxhash64(F.lit(1), text)})
    known = stored(marked.groupBy(id_, one, two).agg(F.count("*").alias("rows")), "jaccard-rows")
    most = known.agg(F.max(id_)).first()[0] or 0
    several = known.groupBy(id_).count().where("count > 1").select(id_)
    if most < 1 << 62:
        special = known.where("rows > 1").unionByName(known.where(F.col(id_).isNull())).unionByName(known.join(several, id_, "left_semi")).select(id_, one, two).distinct()
    else:
        special = known.select(id_, one, two)
    # ids of partitions that are in order are in order too; written, they are the same for every reader
    special = special.orderBy(F.col(id_).asc_nulls_last(), one, two).withColumn(key, F.monotonically_increasing_id() + (max(most, 0) + 1 if most < 1 << 62 else 0))
    special = stored(special, "jaccard-keys")
    if special.isEmpty():
        return keep_one(docs, ngram, threshold)
    same = lambda a, b: a[id_].eqNullSafe(b[id_]) & (a[one] == b[one]) & (a[two] == b[two])
    if most < 1 << 62:  # the first text of a doc_id keeps it as its key
        first = F.row_number().over(Window.partitionBy(id_, F.when(F.col(id_).isNull(), F.col(key))).orderBy(key)) == 1
        special = special.withColumn(key, F.when(F.col(id_).isNotNull() & first, F.col(id_)).otherwise(F.col(key)))
        special = stored(special, "jaccard-keys")
    found = marked.join(special, same(marked, special)).select(*[marked[c] for c in docs.columns], special[key])
    order = Window.partitionBy(key).orderBy(F.xxhash64(*[F.col(c) for c in docs.columns]), *[F.col(c) for c in docs.columns])
    found = stored(found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank), "jaccard-special")
    plain = marked.join(special, same(marked, special), "left_anti").select(*docs.columns, F.col(id_).alias(key))
    keyed = plain.unionByName(found)
    gone = linked(keyed.select(F.col(key).alias("doc_id"), "text"), ngram, threshold).where("class_id < doc_id").select(F.col("doc_id").alias(id_))
    return keyed.join(gone, keyed[key] == gone[id_], "left_anti").drop(key)


def sql(ngram: int = NGRAM, threshold: float = THRESHOLD) -> str:
    """The join in DuckDB, by counting the n-grams that each two sets share, and the groups by following the links."""
    return f"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]+') AS ws FROM documents WHERE doc_id IS NOT NULL),
    g AS (SELECT DISTINCT doc_id, list_sort(list_distinct(CASE WHEN len(ws) < {ngram} THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - {ngram - 2}), lambda i: array_to_string(list_slice(ws, i, i + {ngram - 1}), ' ')) END)) AS s FROM d WHERE len(ws) > 0),
    n AS (SELECT s, row_number() OVER () AS k, len(s) AS m, min(doc_id) AS first, count(*) AS docs FROM g GROUP BY s),
    f AS (SELECT k, m, docs, unnest(s) AS t FROM n),
    o AS (SELECT x.k AS a, y.k AS b, any_value(y.docs) AS docs FROM f x JOIN f y ON x.t = y.t AND x.k <> y.k GROUP BY x.k, y.k HAVING count(*)::DOUBLE / (any_value(x.m) + any_value(y.m) - count(*)) >= {threshold}),
    r AS (SELECT k, k AS root FROM n UNION SELECT o.b, r.root FROM r JOIN o ON o.a = r.k),
    c AS (SELECT r.root AS k, min(n.first) AS class_id FROM r JOIN n ON n.k = r.k GROUP BY r.root),
    l AS (SELECT a AS k, sum(docs) AS links FROM o GROUP BY a)
    SELECT g.doc_id, c.class_id, (n.docs - 1 + coalesce(l.links, 0))::BIGINT AS n_links FROM g JOIN n ON g.s = n.s JOIN c ON c.k = n.k LEFT JOIN l ON l.k = n.k
    UNION ALL SELECT DISTINCT doc_id, doc_id, 0::BIGINT FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM g)"""
