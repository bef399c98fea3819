"""The list of a crawl's archives, in groups, and the selection of groups and languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Languages that a run takes by default.
DEFAULT_LANGUAGES = tuple("bg cs da de el en es et fi fr ga hr hu it lt lv mt nl pl pt ro sk sl sv".split())


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path) of a text file with one archive path per line, compressed or not."""
    return spark.read.text(path).where("value <> ''").withColumnRenamed("value", "path")


def group_index(path="path"):
    """The number after the full stop in the fourth part of the path."""
    return F.split_part(F.split_part(F.col(path), F.lit("/"), F.lit(4)), F.lit("."), F.lit(2)).cast("int")


def archive_groups(paths: DataFrame, check: bool = True) -> DataFrame:
    """(group_idx, files): sorted archives of each group. Groups that don't count up from 0 are an error."""
    groups = paths.select(group_index().alias("group_idx"), "path").groupBy("group_idx").agg(F.sort_array(F.collect_list("path")).alias("files"))
    if check:
        low, high, n = groups.agg(F.min("group_idx"), F.max("group_idx"), F.count("*")).first()
        if n and (low != 0 or high + 1 != n):
            raise ValueError(f"{n} groups from {low} to {high} are not contiguous")
    return groups


def parse_groups(wanted: str, n_groups: int) -> list[int]:
    """ALL, a list with commas, a range whose end is left out, or one number."""
    if wanted == "ALL":
        return list(range(n_groups))
    if "," in wanted:
        return [int(x) for x in wanted.split(",")]
    if "-" in wanted:
        start, end = wanted.split("-")
        return list(range(int(start), int(end)))
    return [int(wanted)]


def parse_languages(wanted: str, known: list[str]) -> list[str]:
    """ALL of the model's labels, or a list with commas; none is an error."""
    out = list(known) if wanted == "ALL" else [x for x in wanted.split(",") if x]
    if not out:
        raise ValueError("no languages are wanted")
    return out
