"""Web archives: one partition per file, one row per record, in Arrow batches."""

from __future__ import annotations

import gzip
import re
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import WARC_RECORD
from .files import DELAY, TRIES, found, open_stream

#: Rows and bytes of payload that a batch holds about.
BATCH_ROWS, BATCH_BYTES = 500, 32 << 20
FAILED = "failed"

_ARROW = pa.schema([("warc_type", pa.string()), ("warc_id", pa.string()), ("date", pa.string()), ("url", pa.string()), ("group_idx", pa.int32()), ("warc_file", pa.string()), ("record_idx", pa.int64()), ("payload", pa.binary())])


def group_of(path: str) -> int | None:
    """Number of the group that the fourth part of a crawl path ends in."""
    found = re.search(r"/segments/[^/]*?\.(\d+)/", path)
    return int(found[1]) if found else None


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-cased names, body) of each record; the HTTP head of a captured response is not part of the body."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no archive record begins with {line[:40]!r}")
        head = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            head[name.strip().lower()] = value.strip()
        body = stream.read(int(head.get("content-length", 0)))
        if head.get("content-type", "").startswith("application/http"):
            body = re.split(rb"\r?\n\r?\n", body, maxsplit=1)[-1]
        yield head, body


def steady_records(path: str, tries: int = TRIES, delay: float = DELAY) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(ordinal, headers, body); where the stream breaks off it is opened again and goes on after the last record."""
    following, left = 0, tries
    while True:
        try:
            with open_stream(path, tries, delay) as raw:
                for n, (head, body) in enumerate(records(gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw)):
                    if n >= following:
                        yield n, head, body
                        following, left = n + 1, tries
            return
        except (OSError, EOFError):
            left -= 1
            if left <= 0:
                raise
            time.sleep(delay if path.startswith("http") else 0)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.options = options

    def partitions(self):
        return [_File(p) for path in self.options["path"].split(",") for p in found(path, "*.warc*")]

    def read(self, partition):
        kinds = {t for t in self.options.get("types", "").split(",") if t}
        path, last = partition.path, -1
        group, rows, held = group_of(path), [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)
        try:
            for last, head, body in steady_records(path):
                if not kinds or head.get("warc-type") in kinds:
                    rows.append((head.get("warc-type"), head.get("warc-record-id"), head.get("warc-date"), head.get("warc-target-uri"), group, path, last, body))
                    held += len(body)
                    if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield batch()
                        rows, held = [], 0
        except Exception as error:  # noqa: BLE001 - any fault of an archive is its own, and is told
            if self.options.get("onerror", "fail") != "keep":
                raise
            rows.append((FAILED, None, None, None, group, path, last + 1, f"{type(error).__name__}: {error}".encode()))
        if rows:
            yield batch()


class WarcSource(DataSource):
    """Options: path (file, folder, pattern or list with commas, anywhere ``files`` reaches), types (record types to keep, all by
    default), onerror ("fail", or "keep": an archive that cannot be read to its end gives the records before the fault
    and one of type ``failed`` with the message)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return WARC_RECORD

    def reader(self, schema):
        return _Reader(self.options)


def read_warc(spark: SparkSession, path: str, types: str = "response", on_error: str = "fail"):
    """Records of the wanted types, all if empty; no archives give no rows, an empty one none. A record without a header has a null
    there; bodies are not decoded."""
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("types", types).option("onerror", on_error).load(path)
