"""Durable intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SPREAD_BYTES = 4 << 20

_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where the setting is unset, a temporary one on a local master, as in tests; on a cluster,
    whose executors would not share it, an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = tempfile.mkdtemp(prefix="lexmill-")
        path = _OWN[app]
    return path.rstrip("/")


def table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table. One with less than SPREAD_BYTES for each core is dealt out to all of them: it may be a single row group,
    which one task would read and work on alone. What moves is bounded by that size."""
    df, cores = spark.read.parquet(path), spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if cores > 1 and size < cores * SPREAD_BYTES else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: cuts lineage, survives lost executors. The table goes when the
    session ends."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used, deleted when the session ends."""
    path = f"{shared_dir(spark)}/lexmill/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def delete_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
