"""A whole run: archives of a crawl to curated, compressed files, one for each group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import progress
from ..operators.stats import archive_results
from ..sources.jsonl import committed_groups, write_jsonl
from ..sources.warc import read_warc
from ..storage import stored
from .curate import CurateConfig, curate, extract


def create(spark: SparkSession, archives: str, destination: str, config: CurateConfig = CurateConfig(), groups: list[int] | None = None) -> DataFrame:
    """Curates the archives of the wanted groups, all by default, that have no file in ``destination`` yet; returns
    (warc_file, success, processed, failed, error) of this run.

    A group is written when all its archives were read to their end. One with a faulty archive gets a progress file instead, and is
    tried again by the next run, which begins it anew: line and near-duplicate decisions need all of a group."""
    done = committed_groups(destination)
    records = read_warc(spark, archives, types="response", on_error="keep")
    records = records.where(~F.col("group_idx").isin(done)) if done else records
    records = records if groups is None else records.where(F.col("group_idx").isin(list(groups)))
    docs = stored(extract(records, config), "create-documents")
    results = stored(archive_results(records, docs).join(records.select("warc_file", "group_idx").distinct(), "warc_file"), "create-results")
    faulty = [r["group_idx"] for r in results.where(~F.col("success")).select("group_idx").distinct().collect()]
    write_jsonl(curate(docs.where(~F.col("group_idx").isin(faulty)) if faulty else docs, config), destination)
    for group in faulty:
        own = results.where(F.col("group_idx") == group)
        state = progress.progress(docs.where(F.col("group_idx") == group), own, own.where("success"))
        progress.save(state, f"{destination}/{group}.progress.json")
    return results.drop("group_idx")
