"""Registered queries of the core engine and their SQL.

``documents`` stands for extracted text: lang is the language, doc_id the place in the one group 0.
"""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import gopher, metrics
from .functions.bloom import build
from .functions.html import plain_text
from .functions.stop_words import STOP_WORDS
from .operators import filters, progress, stats
from .operators.line_dedup import dedup_lines, filtered_lines, repeated_lines
from .operators.minhash import near_duplicate_ids, seeds, signature
from .operators.scoring import lexical_scores, top_label, train_classifier, with_scores
from .plans.curate import CurateConfig, curate, extract
from .plans.create import create
from .plans.legacy import legacy_filter
from .schema import code_documents, with_document_columns
from .sources.files import join_files, place, remove_files, write_bytes
from .sources.jsonl import read_jsonl, write_jsonl
from .sources.manifest import archive_groups, parse_languages
from .sources.warc import read_warc
from .storage import new_folder, stored, table
from .streaming.incremental import dedup_stream

STOP_LANGS = ("en", "fr", "de", "es")
SIGNATURE_VALUES = 2


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, f"{sf_dir}/documents.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as documents of one group; an archive is a source."""
    named = _docs(spark, sf_dir).select("text", F.col("lang").alias("language"), F.col("doc_id").alias("record_idx"), F.col("source").alias("warc_file"), F.lit(0).alias("group_idx"))
    return with_document_columns(named)


def _metrics(spark, sf_dir, min_length: int | None = None) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", "lang", "text")
    if min_length is not None:
        docs = docs.where(filters.long_enough("text", min_length))
    return gopher.with_metrics(docs, "text", "lang").select("doc_id", "lang", "gopher.*")


def gate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over 500 characters that the gate keeps and drops, per language."""
    m = _metrics(spark, sf_dir, 500)
    ok = gopher.first_failed_rule({n: F.col(n) for n in gopher.METRICS}).isNull()
    return m.groupBy("lang").agg(F.count_if(ok).alias("kept"), F.count_if(~ok).alias("dropped"))


def gopher_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _metrics(spark, sf_dir)
    return m.withColumn("failed", gopher.first_failed_rule({n: F.col(n) for n in gopher.METRICS})).drop("lang")


def pre_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).where(filters.long_enough("text")).select("doc_id")


def repetitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", metrics.repetitions("text").alias("repetitions"), metrics.repetition_count("text").alias("repeated_windows"))


def word_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).select("doc_id", metrics.text_stats("text").alias("s"), metrics.long_words("text").alias("long_words"), metrics.long_word_share("text").alias("long_word_share"), metrics.numpunc_share("text").alias("pnum"), metrics.numeric_share("text").alias("numeric_share"))
    return docs.select("doc_id", "s.*", "long_words", "long_word_share", "pnum", "numeric_share")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup and the length filter after it."""
    return dedup_lines(_documents(spark, sf_dir)).where(filters.still_long_enough("text")).select(F.col("record_idx").alias("doc_id"), "text")


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with a paragraph for each line."""
    return _documents(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))


def paragraph_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of repeated sentences and paragraphs where every line is a paragraph."""
    found = gopher.with_metrics(_paragraphs(spark, sf_dir))
    return found.select(F.col("record_idx").alias("doc_id"), "gopher.frac_duplicate_sentences", "gopher.frac_duplicate_paragraphs")


def paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of documents of several paragraphs that keeps a paragraph with anything new; no document goes."""
    return dedup_lines(_paragraphs(spark, sf_dir), 0.0).select(F.col("record_idx").alias("doc_id"), "text")


def duplicate_line_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(_documents(spark, sf_dir)).select(F.col("ord").alias("doc_id"), F.col("l").cast("long").alias("line_no"), "line")


def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first values of each signature."""
    sig = _docs(spark, sf_dir).select("doc_id", signature("text", SIGNATURE_VALUES).alias("s"))
    return sig.select("doc_id", *[F.col("s")[i].alias(f"value_{i}") for i in range(SIGNATURE_VALUES)])


def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_ids(_documents(spark, sf_dir)).select(F.col("ord").alias("doc_id"))


def lexical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = top_label(lexical_scores("text", list(STOP_LANGS)))
    return _docs(spark, sf_dir).select("doc_id", best.alias("b")).select("doc_id", "b.label", "b.score")


class LengthModel:
    """A model that SQL can follow: the probability of ``rand`` comes from the bytes of the line."""

    def labels(self):
        return ["__label__rand"]

    def predict(self, texts):
        return [{"__label__rand": len(t.encode()) % 97 / 97.0} for t in texts]


def line_weighted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document scores as byte-weighted means over lines, and the filter on ``rand``."""
    scored = with_scores(_documents(spark, sf_dir), lambda lang: LengthModel())
    return scored.where(F.map_contains_key("scores", "rand")).where(filters.not_random("scores", 0.6)).select(F.col("record_idx").alias("doc_id"), F.element_at("scores", "rand").alias("rand"))


#: Labelled documents that the quality classifier is fitted on, the first in hash order.
TRAIN_DOCUMENTS = 2000


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a classifier fitted on labelled documents, and the filter on low quality."""
    docs = _documents(spark, sf_dir)
    labels = table(spark, f"{sf_dir}/labels.parquet").where("quality IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCUMENTS)
    rows = docs.join(labels, F.col("record_idx") == F.col("doc_id")).orderBy("doc_id").select("text", F.when(F.col("quality") > 0, "high").otherwise("low").alias("label"))
    model = train_classifier(rows.toPandas())
    scored = with_scores(docs, lambda lang: model, prefix="dclm_")
    return scored.select(F.col("record_idx").alias("doc_id"), F.try_element_at("scores", F.lit("dclm_low")).alias("low"), filters.not_low_quality("scores").alias("kept"))


def language_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.language_stats(_docs(spark, sf_dir), "lang")


def corpus_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.throughput(_docs(spark, sf_dir))


def code_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of the code gate on every document and its text with Unix newlines; a star for each 100 characters."""
    raw = _docs(spark, sf_dir).select("doc_id", F.col("text").alias("content"), (F.col("n_chars") / 100.0).cast("float").alias("max_stars_count"))
    return code_documents(raw).select("doc_id", filters.code_gate().alias("kept"), filters.not_generated().alias("hand_made"), filters.unix_newlines().alias("text"))


def _language_score(n_chars="n_chars"):
    """A stand-in for a detector's score: ascends with the length up to 1."""
    return F.least(F.col(n_chars) / 2000.0, F.lit(1.0))


def legacy_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the older filters on every document: language of the pair, bytes, the gate and ``rand``, with
    scores made from the length."""
    lid = F.concat(F.lit('["'), "lang", F.lit('", '), _language_score().cast("string"), F.lit("]"))
    rows = _docs(spark, sf_dir).select("doc_id", "text", lid.alias("lid"), F.create_map(F.lit("rand"), F.least(F.col("n_chars") / 8000.0, F.lit(1.0))).alias("scores"))
    return rows.select("doc_id", filters.legacy_language("lid", "en").alias("language"), filters.long_enough_bytes("text", 200).alias("bytes"), filters.legacy_gate().alias("gate"), filters.not_random("scores", filters.LEGACY_MAX_RAND).alias("rand"))


def language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on every document: language wanted, sure enough (French taken for Croatian, whose score counts twice), and not of low
    quality."""
    label = F.when(F.col("lang") == "fr", "hr").otherwise(F.col("lang"))
    rows = _docs(spark, sf_dir).select("doc_id", label.alias("language"), _language_score().alias("score"), F.when(F.col("lang") != "de", F.create_map(F.lit("dclm_low"), _language_score())).otherwise(F.create_map().cast("map<string,double>")).alias("scores"))
    score = filters.language_score("language", "score")
    return rows.select("doc_id", score.alias("language_score"), filters.wanted_language("language", parse_languages("en,hr", ["en"])).alias("wanted"), filters.confident(score).alias("confident"), filters.not_low_quality("scores").alias("quality"))


def legacy_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English documents through the older tools' chain: lines, bytes, scores, ``rand``."""
    rows = _docs(spark, sf_dir).select("text", F.concat(F.lit('["'), "lang", F.lit('", 0.5]')).alias("lid"), F.col("doc_id").alias("record_idx"))
    return legacy_filter(rows, "en", lambda lang: LengthModel(), threshold=0.2, min_bytes=300, max_rand=0.6).select(F.col("record_idx").alias("doc_id"), "text", F.element_at("scores", "rand").alias("rand"))


def stream_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in two groups, English and others, that come in four batches by doc_id through the stream."""
    docs = _documents(spark, sf_dir).withColumn("group_idx", F.when(F.col("language") == "en", 0).otherwise(1))
    most = docs.agg(F.max("record_idx")).first()[0] or 0
    folder = new_folder(spark, "stream")
    for k in range(4):  # all that has come since the last batch is one batch, in as many files as there are tasks
        docs.where(F.floor(F.col("record_idx") * 4 / F.lit(most + 1)) == k).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", (1 << 31) - 1).parquet(f"{folder}/in")
        dedup_stream(source, f"{folder}/out", f"{folder}/seen", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(docs.schema).parquet(f"{folder}/out/*").select(F.col("record_idx").alias("doc_id"), "group_idx", "text")


def bloom_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup where a prebuilt filter already has all lines of the German documents."""
    docs = _documents(spark, sf_dir)
    known = docs.where("language = 'de'").select(F.explode(F.split("text", "\n", -1)).alias("line")).distinct()
    path = new_folder(spark, "bloom") + "/lines.bin"
    write_bytes(path, build(known, "line", max(1 << 16, 64 * known.count()), 8).to_bytes())  # so large that no other line is taken for one of them
    return dedup_lines(docs, seen=filtered_lines(docs, path)).select(F.col("record_idx").alias("doc_id"), "text")


def archive_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run that got through the first half of each archive's records has left to do."""
    docs = _documents(spark, sf_dir).select("warc_file", "record_idx")
    half = docs.agg(F.floor(F.max("record_idx") / 2).alias("half"))
    written = docs.crossJoin(F.broadcast(half)).where("record_idx <= half").drop("half")
    state = progress.progress(written, docs.select("warc_file"))
    left = progress.remaining(docs, state).groupBy("warc_file").agg(F.count("*").alias("records_left"))
    return state.join(left, "warc_file", "left").select("warc_file", "last_record_seen", F.coalesce("records_left", F.lit(0)).alias("records_left"))


def archive_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _docs(spark, sf_dir).select(F.col("source").alias("warc_file"), filters.long_enough("text").alias("kept"))
    return stats.archive_stats(rows)


def manifest_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _docs(spark, sf_dir).select(F.concat(F.lit("crawl-data/C-1/segments/1700000000."), F.pmod("doc_id", F.lit(10)).cast("string"), F.lit("/warc/f-"), F.col("doc_id").cast("string"), F.lit(".warc.gz")).alias("path"))
    return archive_groups(paths).select("group_idx", F.size("files").cast("long").alias("n_files"), F.element_at("files", 1).alias("first_file"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, f"{sf_dir}/pages.parquet").select("page_id", plain_text("html").alias("text"))


def write_pages_as_archives(spark: SparkSession, sf_dir: str, archives: int = 8) -> str:
    """A folder of archives with the pages as responses, each after a request record.

    A task writes consecutive pages of an archive, streaming, as a gzip member of its own; the members are then joined to the archive."""
    folder = f"{new_folder(spark, 'archives')}/segments/1700000000.0/warc"

    def write(batches):
        where, base = place(folder)
        where.create_dir(base, recursive=True)
        current, part, sink, stream = None, None, None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    if r["archive"] != current:
                        if current is not None:
                            stream.close()
                            sink.close()
                            yield pa.RecordBatch.from_pylist([part])
                        current = r["archive"]
                        part = {"archive": current, "first": r["page_id"], "part": f"{folder}/{current:05d}.{uuid.uuid4().hex}.tmp"}
                        sink = where.open_output_stream(place(part["part"])[1], compression=None)
                        stream = gzip.GzipFile(fileobj=sink, mode="wb", compresslevel=1)
                    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + r["html"].encode()
                    for kind, data in (("request", b"GET / HTTP/1.1\r\n\r\n"), ("response", body)):
                        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{r['page_id']}>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: {r['url']}\r\nContent-Type: application/http; msgtype={kind}\r\nContent-Length: {len(data)}\r\n\r\n"
                        stream.write(head.encode() + data + b"\r\n\r\n")
        if current is not None:
            stream.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([part])

    pages = table(spark, f"{sf_dir}/pages.parquet").select(F.pmod("page_id", F.lit(archives)).cast("long").alias("archive"), F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = pages.repartitionByRange("archive", "page_id").sortWithinPartitions("archive", "page_id").mapInArrow(write, "archive long, first long, part string").collect()
    parts = [(k, [r["part"] for r in sorted(found, key=lambda r: r["first"]) if r["archive"] == k]) for k in sorted({r["archive"] for r in found})]

    def join(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                join_files(parts[k][1], f"{folder}/{parts[k][0]:05d}.warc.gz")
            yield batch

    if parts:
        spark.range(0, len(parts), 1, len(parts)).mapInArrow(join, "id long").count()
    remove_files([r["part"] for r in found])
    return folder.partition("/segments/")[0]


def warc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back."""
    found = read_warc(spark, write_pages_as_archives(spark, sf_dir))
    return found.select("url", F.octet_length("payload").cast("long").alias("n_bytes"), "group_idx", "record_idx")


def extracted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives through extraction to documents."""
    return extract(read_warc(spark, write_pages_as_archives(spark, sf_dir)), CurateConfig(min_length=100)).select("url", "warc_id", "record_idx", "text")


def archive_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of a run over the pages as archives, one of which is broken off."""
    folder = write_pages_as_archives(spark, sf_dir)
    write_bytes(f"{folder}/segments/1700000000.0/warc/99999.warc.gz", gzip.compress(b"WARC/1.0\r\nWARC-Type: request\r\nContent-Length: 2\r\n\r\nab\r\n\r\n")[:-9])
    records = stored(read_warc(spark, folder, types="", on_error="keep"), "run-records")
    return stats.run_stats(stats.archive_results(records, extract(records, CurateConfig(min_length=0))))


def curated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole of it: pages as archives, extracted, curated and written as compressed lines, and those read back."""
    folder = new_folder(spark, "curated")
    create(spark, write_pages_as_archives(spark, sf_dir), folder, CurateConfig(min_length=100, gopher=True))
    return read_jsonl(spark, folder).select("url", "warc_id", "record_idx", "group_idx", F.length("text").alias("n_chars"), "repetitions", "long_words")


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as compressed lines, a file per language group, and read back."""
    path = new_folder(spark, "lines")
    write_jsonl(_documents(spark, sf_dir).withColumn("group_idx", F.pmod("record_idx", F.lit(4)).cast("int")), path)
    return read_jsonl(spark, path).select(F.col("record_idx").alias("doc_id"), "group_idx", "language", "warc_file", "text")


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps that need no published model: lines, near-duplicates, metrics, gate and scores."""
    config = CurateConfig(gopher=True, minhash=True, scoring_models=lambda lang: LengthModel(), max_rand_score=0.9)
    return curate(_documents(spark, sf_dir), config).select(F.col("record_idx").alias("doc_id"), "language", "repetitions", "long_words", F.length("text").alias("n_chars"), F.element_at("scores", "rand").alias("rand"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        gate_summary, gopher_metrics, pre_length_filter, repetitions, word_statistics, line_dedup, duplicate_line_report, minhash_signatures, minhash_dedup, lexical_language,
        line_weighted_scores, language_statistics, corpus_bytes, code_filter, legacy_filters, archive_progress, archive_statistics, manifest_groups, html_text, warc_scan, extracted_pages,
        jsonl_roundtrip, curated, language_filters, legacy_pipeline, stream_line_dedup, bloom_line_dedup, archive_run, curated_files, quality_scores, paragraph_metrics, paragraph_dedup,
    )
    return {f.__name__: f for f in own}


_WS = r"\s\x0B\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_TRIM = rf"^[{_WS}]+|[{_WS}]+$"


def _ratio(a: str, b: str) -> str:
    return f"coalesce((({a})::DOUBLE / nullif({b}, 0))::FLOAT::DOUBLE, 0.0)"


def _bytes(items: str) -> str:
    return f"coalesce(list_sum(list_transform({items}, lambda x: strlen(x))), 0)::BIGINT"


def _share(items: str, test: str) -> str:
    return _ratio(f"len(list_filter({items}, lambda x: {test}))", f"len({items})")


def _round2(x: str) -> str:
    return f"(round((({x})::FLOAT * 100::FLOAT)::FLOAT::DOUBLE)::FLOAT / 100.0)::FLOAT::DOUBLE"


def _metrics_sql(source: str = "documents") -> str:
    stop = " ".join(f"WHEN '{lang}' THEN [{', '.join(f"'{w}'" for w in ws)}]" for lang, ws in STOP_WORDS.items())
    dup = lambda c: _ratio(f"{_bytes(c)} - {_bytes(f'list_distinct({c})')}", _bytes(c))
    chunks = lambda parts: f"list_filter(list_transform({parts}, lambda x: regexp_replace(x, '{_TRIM}', '', 'g')), lambda x: x <> '')"
    return f"""
    p AS (SELECT doc_id, lang, text, regexp_extract_all(text, '[^{_WS}]+') AS ws, regexp_extract_all(lower(text), '[^{_WS}]+') AS lw,
            CASE WHEN text = '' THEN [] ELSE string_split(CASE WHEN ends_with(text, chr(10)) THEN left(text, length(text) - 1) ELSE text END, chr(10)) END AS ls,
            CASE lang {stop} END AS sw,
            {chunks("string_split(regexp_replace(text, '([.!?;:])([ \\t\\n\\f\\r])', '\\1' || chr(1) || '\\2', 'g'), chr(1))")} AS se,
            {chunks("string_split(text, chr(10) || chr(10))")} AS pa FROM {source}),
    m AS (SELECT doc_id, lang, text, {_ratio(_bytes("ws"), "len(ws)")} AS mean_word_length,
            {_share("ws", r"regexp_matches(x, '\p{L}')")} AS frac_words_with_alpha,
            {_share("ls", f"regexp_matches(x, '[.!?;:][{_WS}]*$')")} AS frac_lines_end_punctuation,
            {_share("ls", f"regexp_matches(x, '^[{_WS}]*([-*+]|[0-9]+[.])')")} AS frac_lines_start_bullet,
            {_ratio(r"length(regexp_replace(text, '[^\p{L}]+', '', 'g'))", "length(text)")} AS frac_alphabetic_chars,
            CASE WHEN sw IS NULL OR len(list_filter(sw, lambda x: list_contains(lw, x))) >= 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_stop_words,
            {dup("se")} AS frac_duplicate_sentences, {dup("pa")} AS frac_duplicate_paragraphs FROM p),
    r AS (SELECT *, CASE WHEN mean_word_length < 3.0 THEN 'mean_word_length_low' WHEN mean_word_length > 10.0 THEN 'mean_word_length_high'
            WHEN frac_words_with_alpha < 0.8 THEN 'words_with_alpha' WHEN frac_lines_end_punctuation < 0.1::DOUBLE THEN 'end_punctuation'
            WHEN frac_lines_start_bullet > 0.9::DOUBLE THEN 'bullets' WHEN frac_alphabetic_chars < 0.7::DOUBLE THEN 'alphabetic_chars' WHEN has_stop_words < 0.5 THEN 'stop_words'
            WHEN frac_duplicate_sentences > 0.3::DOUBLE THEN 'duplicate_sentences' WHEN frac_duplicate_paragraphs > 0.3::DOUBLE THEN 'duplicate_paragraphs' END AS failed FROM m)"""


def _lines_sql(last: str, scope: str = "0", known: str | None = None, source: str = "documents", threshold: float = 0.2) -> str:
    """Line dedup as common tables, the last of which is t (doc_id, text) of documents with some text left."""
    new = "nth = 1" if known is None else f"nth = 1 AND line NOT IN ({known})"
    return f"""WITH a AS (SELECT doc_id, sc, p, list_extract(ps, p) AS para FROM (SELECT doc_id, sc, ps, unnest(range(1, len(ps) + 1)) AS p FROM (SELECT doc_id, {scope} AS sc, regexp_split_to_array(text, '\\n\\n+') AS ps FROM {source}))),
            l AS (SELECT doc_id, sc, p, para, l, list_extract(ls, l) AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS l FROM (SELECT *, string_split(para, chr(10)) AS ls FROM a))),
            f AS (SELECT *, row_number() OVER (PARTITION BY sc, line ORDER BY doc_id, p, l) AS nth FROM l),
            k AS (SELECT doc_id, p, para FROM f GROUP BY doc_id, p, para HAVING strlen(para) > 0 AND (sum(CASE WHEN {new} THEN strlen(line) ELSE 0 END)::DOUBLE / strlen(para))::FLOAT > {threshold}::FLOAT),
            t AS (SELECT doc_id, string_agg(para || chr(10) || chr(10), '' ORDER BY p) AS text FROM k GROUP BY doc_id) {last}"""


def _fnv_sql(seed: int, size: int) -> str:
    """FNV-1a of the bytes b0, b1, .. in 128-bit arithmetic."""
    h = f"{seed}::UHUGEINT"
    for k in range(size):
        h = f"((xor({h}, b{k}) * 1099511628211::UHUGEINT) & 18446744073709551615::UHUGEINT)"
    return h


def oracle_sql() -> dict[str, str]:
    np = r"'[\p{N}!-/:-@\[-`{-~]'"
    count = lambda pattern: f"len(regexp_extract_all(text, {pattern}))"
    lexical = ", ".join(f"{_share('lw', f'list_contains({sorted(set(STOP_WORDS[lang]))}, x)')} AS {lang}" for lang in STOP_LANGS)
    first, *rest = sorted(STOP_LANGS)
    best = f"greatest({', '.join(sorted(STOP_LANGS))})"
    paragraphs = "(SELECT doc_id, lang, replace(text, chr(10), chr(10) || chr(10)) AS text FROM documents)"
    windows = "FROM (SELECT doc_id, encode(text) AS b, strlen(text) AS n FROM documents)"
    return {
        "gate_summary": f"WITH {_metrics_sql()} SELECT lang, count(*) FILTER (failed IS NULL) AS kept, count(*) FILTER (failed IS NOT NULL) AS dropped FROM r WHERE length(text) > 500 GROUP BY lang",
        "gopher_metrics": f"WITH {_metrics_sql()} SELECT doc_id, {', '.join(gopher.METRICS)}, failed FROM r",
        "pre_length_filter": "SELECT doc_id FROM documents WHERE length(text) > 500",
        "repetitions": f"""WITH g AS (SELECT doc_id, n, i, substr(h, 2 * i + 1, 40) AS w FROM (SELECT doc_id, n, hex(b) AS h, unnest(range(0, greatest(n - 19, 0))) AS i {windows})),
            c AS (SELECT doc_id, count(*) FILTER (i > 0) - count(DISTINCT w) FILTER (i > 0) AS a, count(*) FILTER (i < n - 20) - count(DISTINCT w) FILTER (i < n - 20) AS z FROM g GROUP BY doc_id)
            SELECT d.doc_id, CASE WHEN strlen(text) > 20 THEN (a::DOUBLE / strlen(text))::FLOAT::DOUBLE ELSE 0.0 END AS repetitions, CASE WHEN strlen(text) > 20 THEN z ELSE 0 END AS repeated_windows FROM documents d LEFT JOIN c USING (doc_id)""",
        "word_statistics": f"""WITH p AS (SELECT doc_id, text, regexp_extract_all(text, '[^{_WS}]+') AS ws FROM documents)
            SELECT doc_id, len(ws) AS n_words, len(list_filter(ws, lambda x: strlen(x) > 15)) AS n_long_words, {_bytes("ws")} AS total_length, {_bytes("ws")} // greatest(len(ws), 1) AS avg_length, length(text) AS n_chars,
            {count(np)} AS n_numpunc, {_ratio(_bytes("list_filter(ws, lambda x: strlen(x) >= 15)"), "strlen(text)")} AS long_words,
            {_round2("len(list_filter(ws, lambda x: strlen(x) > 15))::DOUBLE / nullif(len(ws), 0)")} AS long_word_share, {_round2(f"{count(np)}::DOUBLE / nullif(length(text), 0)")} AS pnum,
            ({count(r"'\p{N}'")}::DOUBLE / nullif(length(text), 0))::FLOAT::DOUBLE AS numeric_share FROM p""",
        "line_dedup": _lines_sql("SELECT doc_id, text FROM t WHERE length(text) >= 500"),
        "paragraph_metrics": f"WITH {_metrics_sql(paragraphs)} SELECT doc_id, frac_duplicate_sentences, frac_duplicate_paragraphs FROM m",
        "paragraph_dedup": _lines_sql("SELECT doc_id, coalesce(t.text, '') AS text FROM documents LEFT JOIN t USING (doc_id)", source=paragraphs, threshold=0.0),
        "stream_line_dedup": _lines_sql("SELECT doc_id, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS group_idx, coalesce(t.text, '') AS text FROM documents LEFT JOIN t USING (doc_id)", scope="CASE WHEN lang = 'en' THEN 0 ELSE 1 END"),
        "bloom_line_dedup": _lines_sql("SELECT doc_id, coalesce(t.text, '') AS text FROM documents LEFT JOIN t USING (doc_id)", known="SELECT DISTINCT unnest(string_split(text, chr(10))) FROM documents WHERE lang = 'de'"),
        "legacy_pipeline": _lines_sql(f"""SELECT doc_id, text, rand FROM (SELECT doc_id, text, round_even({_round2("sum((w % 97 / 97.0::DOUBLE)::FLOAT::DOUBLE * w) / sum(w)")}, 3) AS rand
            FROM (SELECT doc_id, text, strlen(line) + 1 AS w FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line FROM t WHERE strlen(text) >= 300) WHERE line <> '') GROUP BY doc_id, text) WHERE rand <= 0.6::DOUBLE""", source="documents WHERE lang = 'en'"),
        "minhash_signatures": f"""WITH g AS (SELECT DISTINCT doc_id, substr(h, 2 * i + 1, 10) AS g FROM (SELECT doc_id, hex(encode(text)) AS h, unnest(range(0, strlen(text) - 4)) AS i FROM documents)),
            b AS (SELECT doc_id, {", ".join(f"('0x' || substr(g, {2 * k + 1}, 2))::UHUGEINT AS b{k}" for k in range(5))} FROM g),
            v AS (SELECT doc_id, {", ".join(f"min({_fnv_sql(int(s), 5)}) AS v{i}" for i, s in enumerate(seeds(SIGNATURE_VALUES)))} FROM b GROUP BY doc_id)
            SELECT d.doc_id, {", ".join(f"(CASE WHEN v{i} IS NULL THEN -1::HUGEINT WHEN v{i} >= 9223372036854775808 THEN v{i}::HUGEINT - 18446744073709551616 ELSE v{i}::HUGEINT END)::BIGINT AS value_{i}" for i in range(SIGNATURE_VALUES))} FROM documents d LEFT JOIN v USING (doc_id)""",
        "language_filters": """SELECT doc_id, language_score, lang IN ('en', 'fr') AS wanted, language_score >= 0.8::DOUBLE AS confident, lang = 'de' OR s <= 0.5::DOUBLE AS quality
            FROM (SELECT doc_id, lang, s, CASE WHEN lang = 'fr' THEN 2 * s ELSE s END AS language_score FROM (SELECT doc_id, lang, least(n_chars / 2000.0::DOUBLE, 1.0::DOUBLE) AS s FROM documents))""",
        "archive_run": "SELECT count(DISTINCT page_id % 8) + 1 AS archives, 1::BIGINT AS failed_archives, 100.0::DOUBLE / (count(DISTINCT page_id % 8) + 1) AS failed_archives_percent, count(*) AS processed, count(*) + 1 AS failed, (count(*) + 1) * 100.0::DOUBLE / (2 * count(*) + 1) AS failed_percent FROM pages",
        "duplicate_line_report": """SELECT doc_id, l - 1 AS line_no, line FROM (SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, l) AS nth FROM
            (SELECT doc_id, l, list_extract(ls, l) AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS l FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)))) WHERE nth > 1""",
        "lexical_language": f"""WITH p AS (SELECT doc_id, regexp_extract_all(lower(text), '[^{_WS}]+') AS lw FROM documents), s AS (SELECT doc_id, {lexical} FROM p)
            SELECT doc_id, CASE {' '.join(f"WHEN {x} = {best} THEN '{x}'" for x in (first, *rest))} END AS label, {best} AS score FROM s""",
        "line_weighted_scores": f"""WITH l AS (SELECT doc_id, strlen(line) + 1 AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''),
            s AS (SELECT doc_id, {_round2("sum((w % 97 / 97.0::DOUBLE)::FLOAT::DOUBLE * w) / sum(w)")} AS x FROM l GROUP BY doc_id), r AS (SELECT doc_id, round_even(x, 3) AS rand FROM s) SELECT doc_id, rand FROM r WHERE rand <= 0.6::DOUBLE""",
        "language_statistics": "SELECT lang AS language, count(*) AS documents, count(*)::DOUBLE / (SELECT count(*) FROM documents) * 100 AS percent FROM documents GROUP BY lang",
        "corpus_bytes": "SELECT count(*) AS documents, sum(strlen(text))::BIGINT AS text_bytes FROM documents",
        "code_filter": f"""SELECT doc_id, hand_made AND coalesce(share < 0.2::DOUBLE, false) AND (n_chars / 100.0::DOUBLE)::FLOAT > 10 AS kept, hand_made, replace(text, chr(13) || chr(10), chr(10)) AS text FROM (SELECT doc_id, n_chars, text,
            ({count(r"'\p{N}'")}::DOUBLE / nullif(length(text), 0))::FLOAT::DOUBLE AS share, NOT (regexp_matches(text, '[Gg]enerated by') AND strlen(list_extract(regexp_split_to_array(text, '[Gg]enerated by'), 1)) < 400) AS hand_made FROM documents)""",
        "legacy_filters": """SELECT doc_id, lang = 'en' AS language, strlen(text) >= 200 AS bytes, least(n_chars / 2000.0::DOUBLE, 1)::FLOAT >= 0.85::FLOAT AND least(n_chars / 8000.0::DOUBLE, 1)::FLOAT <= 0.8::FLOAT AS gate,
            least(n_chars / 8000.0::DOUBLE, 1) <= 1.0 AS rand FROM documents""",
        "archive_progress": """WITH h AS (SELECT max(doc_id) // 2 AS half FROM documents), s AS (SELECT source, coalesce(max(doc_id) FILTER (doc_id <= half), -1) AS last FROM documents, h GROUP BY source)
            SELECT source AS warc_file, last AS last_record_seen, count(*) FILTER (doc_id > last) AS records_left FROM documents JOIN s USING (source) GROUP BY source, last""",
        "archive_statistics": "SELECT source AS warc_file, count(*) FILTER (length(text) > 500) AS processed, count(*) FILTER (length(text) <= 500) AS failed, count(*) FILTER (length(text) <= 500)::DOUBLE / count(*) * 100 AS failed_percent FROM documents GROUP BY source",
        "manifest_groups": "SELECT (doc_id % 10)::INT AS group_idx, count(*) AS n_files, min('crawl-data/C-1/segments/1700000000.' || doc_id % 10 || '/warc/f-' || doc_id || '.warc.gz') AS first_file FROM documents GROUP BY 1",
        "warc_scan": "SELECT url, strlen(html) AS n_bytes, 0 AS group_idx, 2 * row_number() OVER (PARTITION BY page_id % 8 ORDER BY page_id) - 1 AS record_idx FROM pages",
        "jsonl_roundtrip": "SELECT doc_id, (doc_id % 4)::INT AS group_idx, lang AS language, source AS warc_file, text FROM documents",
    }
