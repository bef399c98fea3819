"""Compressed JSON lines: a source with one partition per file, and files of groups, each whole or not there."""

from __future__ import annotations

import io
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import DOCUMENT
from .files import found, join_files, open_stream, place, remove_files

SUFFIX = ".jsonl.zstd"
#: Lines and characters that a batch holds about.
BATCH_LINES, BATCH_CHARS = 2000, 16 << 20
_LINES = T.StructType([T.StructField("file", T.StringType()), T.StructField("line", T.StringType())])


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        return [_File(p) for p in found(self.path, "*" + SUFFIX)]

    def read(self, partition):
        lines, held = [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([partition.path] * len(lines), pa.string()), pa.array(lines, pa.string())], names=["file", "line"])
        with open_stream(partition.path) as raw:
            for line in io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True), "utf-8", newline="\n"):
                if line.strip():
                    lines.append(line.rstrip("\n"))
                    held += len(line)
                    if len(lines) >= BATCH_LINES or held >= BATCH_CHARS:
                        yield batch()
                        lines, held = [], 0
        if lines:
            yield batch()


class JsonlSource(DataSource):
    @classmethod
    def name(cls):
        return "jsonl_zstd"

    def schema(self):
        return _LINES

    def reader(self, schema):
        return _Reader(self.options)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT) -> DataFrame:
    """Documents of all files; a bad line fails the job, blank lines are passed over, no files give no rows."""
    spark.dataSource.register(JsonlSource)
    stored_as = T.StructType([T.StructField("warc-id" if f.name == "warc_id" else f.name, f.dataType) for f in schema])
    row = F.from_json("line", stored_as, {"mode": "FAILFAST"})
    lines = spark.read.format("jsonl_zstd").load(path)
    return lines.select(row.alias("row")).select([F.col("row").getField(s.name).alias(f.name) for s, f in zip(stored_as, schema)])


def committed_groups(path: str) -> list[int]:
    """Groups whose file is there, and complete."""
    return sorted(int(p.rpartition("/")[2].removesuffix(SUFFIX)) for p in found(path, "*" + SUFFIX))


def _parts(folder: str, run: str):
    """A function that writes lines, group after group, to a part of each group's file: whole frames, under another name."""

    def write(batches):
        where, base = place(folder)
        where.create_dir(base, recursive=True)
        current, name, sink, stream = None, None, None, None

        def close():
            stream.close()
            sink.close()
            return pa.RecordBatch.from_pylist([{"file": current, "part": f"{folder}/{name}"}])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for file, line in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    if file != current:
                        if stream:
                            yield close()
                        current, name = file, f"{file}{SUFFIX}.{run}.{uuid.uuid4().hex}.tmp"
                        sink = where.open_output_stream(f"{base}/{name}", compression=None)
                        stream = zstandard.ZstdCompressor().stream_writer(sink, closefd=False)
                    stream.write(line.encode() + b"\n")
        if stream:
            yield close()

    return write


def write_jsonl(docs: DataFrame, path: str, group: str = "group_idx") -> None:
    """A file for each group that has none yet. A null group is written as ``null``; no rows write no file.

    Tasks write parts of groups, some dozens of MB each as adaptive execution deals rows out (without it, a group is one part); then the
    parts of each group are joined to its file, which is whole or not there. Parts of a run that fails are removed."""
    spark, path, run = docs.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    done = committed_groups(path)
    todo = docs.where(~F.coalesce(F.col(group).isin(done), F.lit(False))) if done else docs
    fields = [F.col(c).alias("warc-id" if c == "warc_id" else c) for c in docs.columns]
    line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    lines = todo.select(F.coalesce(F.col(group).cast("string"), F.lit("null")).alias("file"), line.alias("line")).hint("rebalance", "file").sortWithinPartitions("file")
    try:
        parts: dict[str, list[str]] = {}
        for r in lines.mapInArrow(_parts(path, run), "file string, part string").collect():
            parts.setdefault(r["file"], []).append(r["part"])
        files = sorted(parts)

        def join(batches):
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    join_files(parts[files[k]], f"{path}/{files[k]}{SUFFIX}")
                yield batch

        if files:
            spark.range(0, len(files), 1, len(files)).mapInArrow(join, "id long").count()
    finally:
        remove_files(found(path, f"*.{run}.*"))

