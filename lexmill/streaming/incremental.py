"""Incremental line dedup: a stream of documents against all lines that earlier batches brought to their group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.line_dedup import dedup_lines, line_keys
from ..storage import stored

_SEEN = "scope int, x long, y long, n int, batch long"


def _batches_before(spark, seen: str, batch: int) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(seen)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(_SEEN).parquet(seen).where(F.col("batch") < batch)


def dedup_stream(docs: DataFrame, out: str, seen: str, checkpoint: str, threshold: float = 0.2):
    """A writer of a stream of documents; ``out`` and ``seen`` have a folder for each batch, so that a batch that is
    run again replaces what it wrote. Seen lines never expire; they are kept as hashes, and each counts in its own group only, as
    when all batches are deduplicated at once. Within a batch the order is that of record_idx. Empty batches write empty
    folders; null texts stay null and bring no lines. A batch reads the hashes of all earlier ones, 28 bytes a line."""

    def step(batch_docs: DataFrame, batch: int) -> None:
        spark = batch_docs.sparkSession
        batch_docs = stored(batch_docs, "stream-batch")
        known = _batches_before(spark, seen, batch)
        dedup_lines(batch_docs, threshold, seen=known).write.mode("overwrite").parquet(f"{out}/batch={batch}")
        fresh = line_keys(batch_docs)
        if known is not None:
            same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("scope", "x", "y", "n")]
            fresh = fresh.alias("a").join(known.alias("b"), same[0] & same[1] & same[2] & same[3], "left_anti")
        fresh.write.mode("overwrite").parquet(f"{seen}/batch={batch}")

    return docs.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
