"""Commands: create, list-languages, stats.

Models are given as ``module:function``, a loader of the language model without arguments, of scoring models with the
language as its argument.
"""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators.stats import language_stats, run_stats
from .plans.create import create
from .plans.curate import CurateConfig
from .sources.jsonl import read_jsonl
from .sources.manifest import DEFAULT_LANGUAGES, archive_groups, parse_groups, parse_languages, read_manifest


def loader(name: str | None):
    if name is None or name.lower() == "none":
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def _create(spark: SparkSession, args) -> None:
    paths, groups = args.archives, None
    if args.manifest:
        found = archive_groups(read_manifest(spark, args.manifest))
        groups = parse_groups(args.groups, found.count())
        own = found.where(F.col("group_idx").isin(groups)).select(F.explode("files").alias("f"))
        paths = ",".join(f"{args.archives.rstrip('/')}/{r['f']}" for r in own.collect())
    elif args.groups != "ALL":
        groups = parse_groups(args.groups, 0)
    model = loader(args.lang_detection_model)
    config = CurateConfig(
        min_length=args.min_length, languages=tuple(parse_languages(args.languages, languages(model))) if model else None, language_model=model, dedup_lines=args.bloom_filter != "none",
        bloom=None if args.bloom_filter in ("none", "empty") else args.bloom_filter, min_new_bytes=args.min_bloom_threshold, scoring_models=loader(args.scoring_models), max_rand_score=args.max_rand_score,
        gopher=args.enable_gopher_filters, minhash=args.enable_minhash_dedup, minhash_threshold=args.minhash_threshold, minhash_num_perm=args.minhash_num_perm, quality_model=loader(args.quality_classifier), max_low_quality=args.max_dclm_low_score,
    )
    results = create(spark, paths, args.destination, config, groups)
    if not args.quiet:
        for r in results.where(~F.col("success")).collect():
            print(f"failed: {r['warc_file']}: {r['error']}")
        print(run_stats(results).first().asDict())


def languages(load) -> list[str]:
    """The labels of a language model, without prefix."""
    return sorted(x.removeprefix("__label__") for x in load().labels())


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m lexmill")
    commands = parser.add_subparsers(dest="command", required=True)
    c = commands.add_parser("create", help="archives to curated files")
    c.add_argument("destination")
    c.add_argument("--archives", required=True, help="folder, files or address that the paths of the manifest follow")
    c.add_argument("--manifest", help="file with one archive path per line")
    c.add_argument("--groups", default="ALL", help="ALL, 28, 10-50 or 1,8,13")
    c.add_argument("--min-length", type=int, default=500)
    c.add_argument("--lang-detection-model", default="none")
    c.add_argument("--languages", default=",".join(DEFAULT_LANGUAGES))
    c.add_argument("--bloom-filter", default="empty", help="a prebuilt filter, empty, or none for no line dedup")
    c.add_argument("--min-bloom-threshold", type=float, default=0.2)
    c.add_argument("--scoring-models", default="none")
    c.add_argument("--max-rand-score", type=float, default=0.9)
    c.add_argument("--enable-gopher-filters", action="store_true")
    c.add_argument("--enable-minhash-dedup", action="store_true")
    c.add_argument("--minhash-threshold", type=float, default=0.8)
    c.add_argument("--minhash-num-perm", type=int, default=128)
    c.add_argument("--quality-classifier", default="none")
    c.add_argument("--max-dclm-low-score", type=float, default=0.5)
    c.add_argument("--quiet", "-q", action="store_true")
    commands.add_parser("list-languages").add_argument("--lang-detection-model", required=True)
    commands.add_parser("stats", help="documents and share of each language").add_argument("path")
    args = parser.parse_args(argv)
    if args.command == "list-languages":
        print("\n".join(languages(loader(args.lang_detection_model))))
        return
    own = spark or SparkSession.builder.getOrCreate()
    if args.command == "create":
        _create(own, args)
    else:
        rows = language_stats(read_jsonl(own, args.path)).orderBy(F.desc("documents"), "language").collect()
        print(f"Number of documents: {sum(r['documents'] for r in rows)}")
        for r in rows:
            print(f"{r['language']}: {r['percent']:.2f}%")


if __name__ == "__main__":
    main()
