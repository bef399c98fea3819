"""Lines of the older tools and of published source code: JSON, every file with a given schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CODE, LEGACY, code_documents


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    """Legacy documents. ``lid`` is a score, a [label, score] pair or absent, and is kept as its JSON text. A bad line, or one
    without text, fails the job."""
    rows = spark.read.schema(LEGACY).option("mode", "FAILFAST").json(path).withColumnRenamed("warc-id", "warc_id")
    return rows.withColumn("text", F.when(F.col("text").isNull(), F.raise_error(F.lit("a line has no text"))).otherwise(F.col("text")))


def write_legacy(docs: DataFrame, path: str) -> None:
    """A folder of JSON lines, with null fields."""
    docs.withColumnsRenamed({"warc_id": "warc-id"}).write.option("ignoreNullFields", "false").json(path)


def read_code(spark: SparkSession, path: str) -> DataFrame:
    """Source-code lines under their short names; a bad line fails the job."""
    return code_documents(spark.read.schema(CODE).option("mode", "FAILFAST").json(path))
