"""Shared helpers of the operators: input columns, sizes of exchanges and connected groups."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from ..storage import new_folder, stored  # noqa: F401 - for the operators


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns that most operators need; other columns never travel."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of text over all rows; sizes the numbers of buckets so that a bucket fits a worker at any scale."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def hashed_sample(df: DataFrame, most: int, *keys: str, seed: int = 0) -> DataFrame:
    """At most ``most`` rows, the first in the order of a hash of the keys, then by the keys.

    Rows beyond twice the share that is wanted are left out before the sort, so that all tasks together send the driver some
    2 * ``most`` rows instead of so many each."""
    cells = 1 << 40
    at = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(cells))
    n = df.count()
    some = df.where(at < int(2 * most / n * cells)) if n > 2 * most else df
    return some.orderBy(at, *keys).limit(most)


def exchange_sizes(items: int, bucket: int, chunk: int, most_rows: int = 32) -> tuple[int, int]:
    """Number of buckets and items of a chunk for a packed exchange of so many items.

    A chunk is cut into a value for each bucket, so that these get small where there are many of both. Beyond the least sizes
    ``bucket`` and ``chunk`` both grow with the square root of the table, and a value holds ``most_rows`` items on average at any
    size: 30 million items for a bucket and a chunk at 3e13 items."""
    both = math.isqrt(most_rows * max(0, items))
    return max(1, -(-items // max(bucket, both))), max(chunk, both)


def by_bucket(df: DataFrame, buckets: int) -> GroupedData:
    """Groups by the column ``bucket``, 0 to buckets - 1. Buckets are dealt out evenly, one to a task as long as that is at most four
    times the number of shuffle partitions; by hash some tasks would get several."""
    tasks = min(buckets, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.withColumn("task", F.col("bucket") % F.lit(tasks)).repartitionById(tasks, F.col("task")).groupBy("task", "bucket")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes that have edges to others, roots excepted: the least node of each connected group, by
    alternating large-star and small-star rounds."""
    edges = stored(edges.toDF("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "groups-0")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = stored(small, "groups")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
