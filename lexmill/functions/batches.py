"""Arrow columns in slices: a batch has up to 64 MB of text, and of Python objects made of that only a slice is held at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes and rows that a slice holds about, one row at least.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1 << 12


def slices(column: pa.Array, most: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.Array]:
    """Consecutive parts of a string or binary column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        done = ends[at - 1] if at else 0
        to = min(max(at + 1, int(np.searchsorted(ends, done + most, "right"))), at + rows)
        yield column.slice(at, to - at)
        at = to


def mapped(column: pa.Array, one: Callable, kind: pa.DataType) -> pa.Array:
    """one(value) of every value that is not null; nulls stay."""
    parts = [pa.array([None if x is None else one(x) for x in part.to_pylist()], kind) for part in slices(column)]
    return pa.concat_arrays(parts) if parts else pa.array([], kind)
