"""Prebuilt Bloom filters: little-endian 32-bit number of hashes, 64-bit number of bytes, then the bits.

A line belongs to the filter where the bit at its FNV-1a hash, modulo the number of bits, is set for each of the first
hash seeds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import col

#: Starting values of the hashes, at most eight; part of the file format.
SEEDS = (14695981039346656037, 9425296925403859339, 13716263814064014149, 3525492407291847033, 8607404175481815707, 9818874561736458749, 10026508429719773353, 3560712257386009938)
_PRIME = np.uint64(1099511628211)


def hashes(lines: list[bytes], seed: int) -> np.ndarray:
    """FNV-1a of each line, all lines byte by byte together."""
    return next(all_hashes(lines, [seed]))


def all_hashes(lines: list[bytes], seeds: Sequence[int]) -> Iterator[np.ndarray]:
    """The same for several seeds; the bytes are laid out once, those at one place of all lines together."""
    size = np.array([len(x) for x in lines], np.int64)
    order = np.argsort(-size, kind="stable")
    longest_first = size[order]
    data = np.frombuffer(b"".join(lines), np.uint8)
    start = (np.cumsum(size) - size)[order]
    longer = np.searchsorted(-longest_first, -np.arange(int(size.max(initial=0))), "left")  # lines longer than k bytes
    columns = [data[start[:n] + k] for k, n in enumerate(longer)]
    for seed in seeds:
        state = np.full(len(lines), seed, np.uint64)
        for n, column in zip(longer, columns):
            part = state[:n]
            part ^= column
            part *= _PRIME
        out = np.empty_like(state)
        out[order] = state
        yield out


class BloomFilter:
    def __init__(self, bits: np.ndarray, num_hashes: int):
        if not 0 < num_hashes <= len(SEEDS) or not len(bits):
            raise ValueError("a filter has 1 to 8 hashes and some bits")
        self.bits, self.num_hashes = bits, num_hashes

    @classmethod
    def empty(cls, size_bits: int = 1 << 24, num_hashes: int = 2) -> BloomFilter:
        return cls(np.zeros(size_bits // 8, np.uint8), num_hashes)

    @classmethod
    def load(cls, path: str) -> BloomFilter:
        """The bits are mapped, not read: the workers of a machine share them."""
        with open(path, "rb") as f:
            head = f.read(12)
        n, size = int(np.frombuffer(head, "<i4", 1)[0]), int(np.frombuffer(head, "<u8", 1, 4)[0])
        return cls(np.memmap(path, np.uint8, "r", 12, (size,)), n)

    def to_bytes(self) -> bytes:
        return np.array([self.num_hashes], "<i4").tobytes() + np.array([len(self.bits)], "<u8").tobytes() + self.bits.tobytes()

    def _places(self, lines: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for found in all_hashes([x.encode() for x in lines], SEEDS[: self.num_hashes]):
            at = found % np.uint64(8 * len(self.bits))
            yield (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)

    def get(self, lines: list[str]) -> np.ndarray:
        """Lines that the first hash rules out are not hashed again."""
        own = [x.encode() for x in lines]
        left = np.arange(len(own))
        for some in (SEEDS[:1], SEEDS[1 : self.num_hashes]):
            own = own if len(own) == len(left) else [own[k] for k in left]
            inside = np.ones(len(own), bool)
            for found in all_hashes(own, some) if own else ():
                at = found % np.uint64(8 * len(self.bits))
                inside &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            left = np.flatnonzero(inside) if some == SEEDS[:1] else left[inside]
        out = np.zeros(len(lines), bool)
        out[left] = True
        return out

    def set(self, lines: list[str]) -> None:
        for at, bit in self._places(lines):
            np.bitwise_or.at(self.bits, at, bit)


#: Bytes of a filter that one group of rows makes.
SEGMENT_BYTES = 1 << 20


def build(lines: DataFrame, column: str, size_bits: int, num_hashes: int) -> BloomFilter:
    """A filter of so many bits that has all lines of a column; tasks make its segments, and the driver gets these, no lines."""
    bloom = BloomFilter.empty(size_bits, num_hashes)
    size = len(bloom.bits)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in all_hashes([(x or "").encode() for x in batch.column(0).to_pylist()], SEEDS[:num_hashes]):
                at = (found % np.uint64(8 * size)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((at // (8 * SEGMENT_BYTES)).astype(np.int32)), pa.array((at % (8 * SEGMENT_BYTES)).astype(np.int32))], names=["segment", "bit"])

    def segment(key: tuple, rows: pa.Table) -> pa.Table:
        first = key[0].as_py() * SEGMENT_BYTES
        bits = np.zeros(8 * min(SEGMENT_BYTES, size - first), bool)
        bits[rows.column("bit").to_numpy()] = True
        return pa.table({"first": pa.array([first], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})

    found = lines.select(column).mapInArrow(places, "segment int, bit int").groupBy("segment").applyInArrow(segment, "first long, bits binary").toArrow()
    for first, bits in zip(found.column("first").to_pylist(), found.column("bits")):
        own = np.frombuffer(bits.as_buffer(), np.uint8)
        bloom.bits[first : first + len(own)] = own
    return bloom


def known_lines(spark: SparkSession, path: str, line: Column | str) -> Column:
    """Whether the filter has each line. The file goes to every machine once, and not through the driver's memory."""
    spark.sparkContext.addFile(path)
    name, held = path.rstrip("/").rpartition("/")[2], {}

    @F.pandas_udf("boolean")
    def run(s: pd.Series) -> pd.Series:
        if name not in held:
            held[name] = BloomFilter.load(SparkFiles.get(name))
        return pd.Series(held[name].get(s.fillna("").tolist()))

    return run(col(line))
