"""Statistics of corpora, archives and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def language_stats(docs: DataFrame, language: str = "language") -> DataFrame:
    """(language, documents, percent): rows per language and their share of all, in percent."""
    counted = docs.groupBy(F.col(language).alias("language")).agg(F.count("*").alias("documents"))
    return counted.withColumn("percent", F.col("documents") / F.sum("documents").over(Window.partitionBy()) * 100)


def throughput(docs: DataFrame, text: str = "text") -> DataFrame:
    """(documents, text_bytes): what a timed pass is divided by."""
    return docs.agg(F.count("*").alias("documents"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("text_bytes"))


def archive_stats(records: DataFrame) -> DataFrame:
    """(warc_file, processed, failed, failed_percent) from one row per record with ``kept``."""
    return records.groupBy("warc_file").agg(
        F.count_if("kept").alias("processed"), F.count_if(~F.col("kept")).alias("failed"), (F.count_if(~F.col("kept")) / F.count("*") * 100).alias("failed_percent")
    )


def archive_results(records: DataFrame, kept: DataFrame) -> DataFrame:
    """(warc_file, success, processed, failed, error), one row per archive, from all records read with faults kept, and the documents
    made of them. An archive that broke off has success false and the message; its records before that count."""
    failed = F.col("warc_type") == "failed"
    seen = records.groupBy("warc_file").agg(F.count_if(~failed).alias("seen"), F.max(F.when(failed, F.decode("payload", "UTF-8"))).alias("error"))
    made = kept.groupBy("warc_file").agg(F.count("*").alias("processed"))
    out = seen.join(made, "warc_file", "left").withColumn("processed", F.coalesce("processed", F.lit(0)))
    return out.select("warc_file", F.col("error").isNull().alias("success"), "processed", (F.col("seen") - F.col("processed")).alias("failed"), "error")


def run_stats(archives: DataFrame) -> DataFrame:
    """One row over all archives: archives, failed archives, and records with shares in percent.

    ``archives`` has warc_file, success, processed and failed."""
    seen = F.sum(F.col("processed") + F.col("failed"))
    return archives.agg(
        F.count("*").alias("archives"),
        F.count_if(~F.col("success")).alias("failed_archives"),
        F.coalesce(F.try_divide(F.count_if(~F.col("success")) * 100.0, F.count("*").cast("double")), F.lit(0.0)).alias("failed_archives_percent"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
        F.coalesce(F.try_divide(F.sum("failed") * 100.0, seen.cast("double")), F.lit(0.0)).alias("failed_percent"),
    )
