"""numpy kernels on Arrow string columns: tokens, hashes, rolling windows.

Texts are handled as one UTF-8 buffer with offsets, a few MB at a time, so that no Python object is
made per token. All hashes are 64-bit and the same on every machine.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
STEP = 0xD6E8FEB86659FD93
SLICE_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~_SPACE
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def lean() -> None:
    """Makes a worker give large arrays back to the system as they are freed: it is used again by other stages and
    otherwise keeps what its largest task needed. Without glibc it does nothing."""
    tune = getattr(ctypes.CDLL(None), "mallopt", None)
    if tune:
        tune(-3, 4 << 20)  # M_MMAP_THRESHOLD, which else grows to 32 MB
        tune(-1, 8 << 20)  # M_TRIM_THRESHOLD


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    """Consecutive slices of a batch holding about ``most`` bytes of text, one row at least."""
    lean()
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def thin(batch: pa.RecordBatch, most: int = 4 << 20):
    """Consecutive slices of a batch of packed values with about ``most`` bytes: the executor reads a batch at once, outside its heap."""
    rows = max(1, batch.num_rows * most // max(1, batch.nbytes))
    for s in range(0, batch.num_rows, rows):
        yield batch.slice(s, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^(n-1) and their inverses modulo 2^64; the base is odd."""
    both = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, U)
        p[:1] = 1
        both.append(np.cumprod(p, dtype=U))
    return both[0], both[1]


def tokens(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE):
    """Start and end byte and row of every maximal run of ``inside`` bytes; no run crosses rows."""
    n = len(data)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    on = inside[data]
    full = np.flatnonzero(np.diff(offsets))
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = on[:-1]
    before[offsets[full]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = on[1:]
    after[offsets[full + 1] - 1] = False
    starts = np.flatnonzero(on & ~before)
    ends = np.flatnonzero(on & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each byte span, from one prefix sum."""
    if len(starts) == 0:
        return np.zeros(0, U)
    power, inverse = powers(BASE, len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))


def windows(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hash of every run of n values within a row, and the index of its first value."""
    m = len(values) - n + 1
    if m <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    power, inverse = powers(STEP, len(values) + 1)
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * power[:-1], out=total[1:])
    first = np.flatnonzero(rows[:m] == rows[n - 1 :])
    return mix((total[first + n] - total[first]) * inverse[first] + U(n)), first


def row_starts(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Index of the first element of each row in a sorted row array, with the length at the end."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def repeated(values: np.ndarray) -> np.ndarray:
    """Marks every element whose value occurs at least twice."""
    marks = np.zeros(len(values), bool)
    if len(values) > 1:
        order = np.argsort(values)
        ordered = values[order]
        same = ordered[1:] == ordered[:-1]
        marks[order[1:][same]] = True
        marks[order[:-1][same]] = True
    return marks


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def group_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least of each connected group of 0..n-1, of which a and b are linked."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if np.array_equal(low, root):
            return root
        root = low


def short(values: np.ndarray, width: int) -> bytes:
    """The low bytes of 64-bit words."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def long(data: bytes, width: int) -> np.ndarray:
    """64-bit words of which these are the low bytes."""
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").reshape(-1)
