"""Resuming: what earlier runs wrote, and what is left."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import found, open_stream, write_bytes


def progress(written: DataFrame, archives: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """(warc_file, last_record_seen, done): for each archive the highest record written, -1 where there is none.

    ``archives`` and ``done`` have a column warc_file."""
    last = written.groupBy("warc_file").agg(F.max("record_idx").alias("last"))
    out = archives.select("warc_file").distinct().join(last, "warc_file", "left")
    if done is not None:
        out = out.join(done.select("warc_file", F.lit(True).alias("is_done")).distinct(), "warc_file", "left")
    else:
        out = out.withColumn("is_done", F.lit(None).cast("boolean"))
    return out.select("warc_file", F.coalesce("last", F.lit(-1)).cast("long").alias("last_record_seen"), F.coalesce("is_done", F.lit(False)).alias("done"))


def records_seen(state: DataFrame) -> DataFrame:
    """(records_seen): sum of the highest records; an archive not yet begun counts -1."""
    return state.agg(F.coalesce(F.sum("last_record_seen"), F.lit(0)).alias("records_seen"))


def save(state: DataFrame, path: str) -> None:
    """Replaces the progress of a group by (warc_file, last_record_seen, done), as JSON; the old file stays until the new one is
    whole. One row per archive, so that a file is as small as the archive list."""
    rows = {r["warc_file"]: {"last_record_seen": r["last_record_seen"], "done": r["done"]} for r in state.collect()}
    write_bytes(path, json.dumps({"persistent_path": path, "warcs_progress": rows}, indent=4).encode())


def load(spark: SparkSession, path: str) -> DataFrame:
    """(warc_file, last_record_seen, done) as saved; no rows where nothing was."""
    rows = []
    if found(path, "*"):
        with open_stream(path) as f:
            rows = [(k, v["last_record_seen"], v["done"]) for k, v in json.loads(f.read())["warcs_progress"].items()]
    return spark.createDataFrame(rows, "warc_file string, last_record_seen long, done boolean")


def remaining(records: DataFrame, state: DataFrame) -> DataFrame:
    """Records of archives that are not done, beyond the last one seen."""
    known = state.select(F.col("warc_file").alias("__file"), F.col("last_record_seen").alias("__last"), F.col("done").alias("__done"))
    joined = records.join(known, F.col("warc_file") == F.col("__file"), "left")
    return joined.where(~F.coalesce("__done", F.lit(False)) & (F.col("record_idx") > F.coalesce("__last", F.lit(-1)))).select(records.columns)


def unwritten(records: DataFrame, written: DataFrame) -> DataFrame:
    """Records that no earlier run wrote, by (warc_file, record_idx)."""
    return records.join(written.select("warc_file", "record_idx"), ["warc_file", "record_idx"], "left_anti").select(records.columns)
