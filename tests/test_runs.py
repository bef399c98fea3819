"""Whole runs, commands, prebuilt filters, older formats, faults of archives, and odd tables."""

import gzip
import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lexmill import __main__ as cli
from lexmill import queries, storage
from lexmill.functions import gopher
from lexmill.functions.bloom import SEEDS, BloomFilter, hashes
from lexmill.functions.html import decode_bytes
from lexmill.operators import filters, minhash, progress, scoring, stats
from lexmill.operators.line_dedup import dedup_lines, filtered_lines, repeated_lines
from lexmill.plans.create import create
from lexmill.plans.curate import CurateConfig, curate
from lexmill.plans.legacy import annotate, legacy_filter
from lexmill.schema import DOCUMENT, with_document_columns
from lexmill.sources import files, jsonl, legacy, manifest, warc
from lexmill.streaming.incremental import dedup_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import it
DOC = "record_idx long, text string, group_idx int"
PAGE = "<p>" + "Some words of a page that is long enough to stay. " * 20 + "</p>"


class Labels:
    def labels(self):
        return ["__label__fr", "__label__en", "__label__hr"]

    def predict(self, texts):
        assert all("\n" not in t for t in texts)
        return [{"__label__hr": 0.45} if "hr" in t.split() else {"__label__en": 0.9, "__label__fr": 0.05} for t in texts]


def load_labels():
    return Labels()


def archive(path, *pages, broken=False, group=0):
    folder = path / "segments" / f"17.{group}" / "warc"
    folder.mkdir(parents=True, exist_ok=True)
    name = folder / f"{len(list(folder.iterdir()))}.warc.gz"
    data = b""
    for i, html in enumerate(pages):
        for kind in ("request", "response"):
            body = b"HTTP/1.1 200 OK\r\n\r\n" + html.encode()
            data += f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: u{i}\r\nContent-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    data = gzip.compress(data)
    name.write_bytes(data[:-20] if broken else data)
    return str(name)


def test_a_faulty_archive_is_told_and_its_group_tried_again(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    archive(source, PAGE, PAGE + "other", group=0)
    bad = archive(source, PAGE, broken=True, group=1)
    with pytest.raises(Exception, match="EOFError|Compressed"):
        warc.read_warc(spark, str(source)).count()
    got = {r.warc_file: r for r in create(spark, str(source), out, CurateConfig(min_length=20, dedup_lines=False)).collect()}
    assert not got[bad].success and got[bad].error and sum(r.success for r in got.values()) == 1
    assert [(r.processed, r.failed) for r in got.values() if r.success] == [(2, 0)]
    assert jsonl.committed_groups(out) == [0]
    assert [(r.warc_file, r.done) for r in progress.load(spark, f"{out}/1.progress.json").collect()] == [(bad, False)]
    (tmp_path / "in" / "segments" / "17.1" / "warc" / "0.warc.gz").unlink()
    archive(source, PAGE, group=1)
    create(spark, str(source), out, CurateConfig(min_length=20, dedup_lines=False))
    assert jsonl.committed_groups(out) == [0, 1] and jsonl.read_jsonl(spark, out).count() == 3
    whole = stats.run_stats(spark.createDataFrame([("a", True, 3, 1), ("b", False, 0, 0)], "warc_file string, success boolean, processed long, failed long")).first()
    assert whole.failed_archives_percent == 50.0 and whole.failed_percent == 25.0


def test_a_stream_that_breaks_off_goes_on_after_the_last_record(monkeypatch, tmp_path):
    path = archive(tmp_path, PAGE, PAGE, PAGE)
    whole = list(warc.steady_records(path))
    opened, calls = warc.open_stream, []

    class Breaks:
        def __init__(self, raw, most):
            self.raw, self.left = raw, most

        def read(self, n=-1):
            if self.left <= 0:
                raise ConnectionResetError("lost")
            data = self.raw.read(min(n, 64) if n > 0 else 64)
            self.left -= len(data)
            return data

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.raw.close()

    def flaky(p, tries, delay):
        calls.append(p)
        return Breaks(opened(p, tries, delay), 150 if len(calls) == 1 else 10**9)

    monkeypatch.setattr(warc, "open_stream", flaky)
    assert list(warc.steady_records(path)) == whole and len(calls) == 2


def test_commands(spark, tmp_path, capsys):
    archive(tmp_path / "in", PAGE, PAGE.replace("page", "hr"), "short")
    out = str(tmp_path / "out")
    cli.main(["create", out, "--archives", str(tmp_path / "in"), "--min-length", "100", "--lang-detection-model", f"{__name__}:load_labels", "--languages", "en,hr", "--bloom-filter", "none"], spark)
    assert "'archives': 1, 'failed_archives': 0" in capsys.readouterr().out
    rows = {r.language: r for r in jsonl.read_jsonl(spark, out).collect()}
    assert {k: r.language_score for k, r in rows.items()} == {"en": 0.9, "hr": 0.9}
    cli.main(["stats", out], spark)
    assert capsys.readouterr().out.split("\n")[:3] == ["Number of documents: 2", "en: 50.00%", "hr: 50.00%"]
    cli.main(["list-languages", "--lang-detection-model", f"{__name__}:load_labels"])
    assert capsys.readouterr().out.split() == ["en", "fr", "hr"]
    paths = tmp_path / "paths.gz"
    paths.write_bytes(gzip.compress("\n".join(str(p.relative_to(tmp_path / "in" / "segments")) for p in (tmp_path / "in").rglob("*.gz")).replace("17.0", "a/b/c/1.0").encode()))
    assert [r.path for r in manifest.read_manifest(spark, str(paths)).collect()] == ["a/b/c/1.0/warc/0.warc.gz"]


def test_files_below_a_folder_and_by_pattern(tmp_path):
    for n in ("b.x", "sub/a.x", "c.y"):
        files.write_bytes(f"{tmp_path}/{n}", b"1")
    assert [p.removeprefix(f"{tmp_path}/") for p in files.found(f"file://{tmp_path}", "*.x")] == ["b.x", "sub/a.x"]
    assert files.found(f"{tmp_path}/*.y", "") == [f"{tmp_path}/c.y"] and files.found(f"{tmp_path}/none", "*") == []


def test_selectors():
    assert manifest.parse_languages("ALL", ["a", "b"]) == ["a", "b"] and manifest.parse_languages("x,y", []) == ["x", "y"] and len(manifest.DEFAULT_LANGUAGES) == 24
    with pytest.raises(ValueError):
        manifest.parse_languages("", ["a"])


def test_bloom_filter_file_and_hashes(spark, tmp_path):
    lines = ["", "a", "été", "a longer line", "x" * 300]
    for seed in SEEDS[:2]:
        assert hashes([x.encode() for x in lines], seed).tolist() == [minhash.fnv1a(x.encode(), seed) for x in lines]
    bloom = BloomFilter.empty(1 << 12, 3)
    bloom.set(lines[1:])
    path = str(tmp_path / "f.bin")
    files.write_bytes(path, bloom.to_bytes())
    raw = (tmp_path / "f.bin").read_bytes()
    assert raw[:12] == (3).to_bytes(4, "little") + (512).to_bytes(8, "little") and len(raw) == 524
    for x in lines[1:]:
        for seed in SEEDS[:3]:
            at = minhash.fnv1a(x.encode(), seed) % 4096
            assert raw[12 + at // 8] >> at % 8 & 1
    read = BloomFilter.load(path)
    assert read.get(lines).tolist()[1:] == [True] * 4 and not read.get([f"other {i}" for i in range(50)]).any()
    docs = spark.createDataFrame([(1, "a\nnew line", 0), (2, "été", 0)], DOC)
    got = {r.record_idx: r.text for r in dedup_lines(docs, seen=filtered_lines(docs, path)).collect()}
    assert got == {1: "a\nnew line\n\n", 2: ""}
    assert dedup_lines(docs, seen=spark.createDataFrame([("new line",)], "line string")).where("text <> ''").count() == 1


def test_older_tools(spark, tmp_path):
    rows = [{"text": "one line\nmore", "lid": ["en", 0.7], "scores": {"q": 0.5}}, {"text": "one line", "lid": ["en", 0.9]}, {"text": "bare", "lid": 0.4, "warc-id": "w"}, {"text": "none"}]
    (tmp_path / "l.json").write_text("\n".join(map(json.dumps, rows)))
    docs = legacy.read_legacy(spark, str(tmp_path / "l.json")).withColumn("record_idx", F.monotonically_increasing_id())
    got = {r.text: r for r in legacy_filter(docs, "en", lambda lang: queries.LengthModel(), threshold=0.2).collect()}
    assert set(got) == {"one line\nmore\n\n"} and got["one line\nmore\n\n"].language_score == 0.7 and set(got["one line\nmore\n\n"].scores) == {"q", "rand"}
    assert {r.text for r in legacy_filter(docs, "unk", lambda lang: queries.LengthModel()).collect()} == {"bare\n\n", "none\n\n"}
    assert annotate(docs, lambda lang: queries.LengthModel()).where(F.map_contains_key("scores", "rand")).count() == 4
    legacy.write_legacy(docs.drop("record_idx"), str(tmp_path / "out"))
    assert legacy.read_legacy(spark, str(tmp_path / "out")).where("warc_id = 'w'").count() == 1
    for line in ("{bad", json.dumps({"lid": 1})):
        (tmp_path / "bad.json").write_text(line)
        with pytest.raises(Exception):
            legacy.read_legacy(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "c.json").write_text(json.dumps({"content": "xy = 1", "lang": "py", "max_stars_count": 12}))
    assert legacy.read_code(spark, str(tmp_path / "c.json")).where(filters.code_gate()).first().text == "xy = 1"


def test_a_stream_keeps_groups_apart_like_one_batch(spark, tmp_path):
    rows = [(0, "same\nline", 0), (1, "same\nline", 1), (2, "same\nother", 0), (3, None, 1), (4, "line", 1), (5, "same", None), (6, "same", None)]
    source = tmp_path / "in"
    for r in rows:
        spark.createDataFrame([r], DOC).coalesce(1).write.mode("append").parquet(str(source))
        dedup_stream(spark.readStream.schema(DOC).parquet(str(source)), *(str(tmp_path / x) for x in ("out", "seen", "check"))).trigger(availableNow=True).start().awaitTermination()
    got = {r.record_idx: r.text for r in spark.read.schema(DOC).parquet(f"{tmp_path}/out/batch=*").collect()}
    want = {r.record_idx: r.text for r in dedup_lines(spark.createDataFrame(rows, DOC)).collect()}
    assert got == want and want[1] == "same\nline\n\n" and want[4] == want[6] == "" and want[3] is None


def test_odd_rows_of_the_core(spark):
    clash = "record_idx long, text string, group_idx int, scope int, ord long, own string, line string, h string, s int, labels string, means double, language string"
    docs = spark.createDataFrame([(1, None, 0, *[None] * 9), (2, "", 0, *[None] * 9), (3, "a\na", 0, *[None] * 9), (3, "a\na", 0, *[None] * 9), (4, "é" * 100_000, None, *[None] * 9)], clash)
    assert dedup_lines(docs).columns == docs.columns and dedup_lines(docs).count() == 5
    assert sorted(r.ord for r in repeated_lines(docs).collect()) == [3, 3]
    assert scoring.with_scores(docs, lambda lang: queries.LengthModel()).where("size(scores) = 0").count() == 2
    assert gopher.with_metrics(docs, language="language").columns == [*docs.columns, "gopher"]
    whole = with_document_columns(docs)
    assert curate(whole, CurateConfig(min_length=0, gopher=True, minhash=True, scoring_models=lambda lang: queries.LengthModel())).columns == [f.name for f in DOCUMENT]
    empty = whole.limit(0)
    for out in (dedup_lines(empty), repeated_lines(empty), curate(empty, CurateConfig(gopher=True, minhash=True, scoring_models=lambda lang: queries.LengthModel())), minhash.near_duplicate_ids(empty), scoring.with_scores(empty, lambda lang: queries.LengthModel())):
        assert out.count() == 0


def test_stop_words_that_are_listed_twice_pass_alone(spark):
    df = spark.createDataFrame([("They HAVE gone", "en"), ("byl", "cs"), ("ach", "ga"), ("the", "en"), (None, "en"), ("x", None)], "text string, language string")
    assert [r.x for r in df.select(gopher.has_stop_words("text", "language").alias("x")).collect()] == [1.0, 1.0, 1.0, 0.0, 0.0, 1.0]


def test_scores_by_language_and_training(spark):
    loaded = spark.sparkContext.accumulator(0)

    class One:
        def __init__(self, lang):
            self.lang = lang

        def labels(self):
            return ["__label__rand"]

        def predict(self, texts):
            return [{"__label__rand": {"en": 0.25, "fr": 0.5}[self.lang]} for _ in texts]

    def load(lang):
        loaded.add(1)
        return One(lang)

    docs = spark.createDataFrame([(i, "a line\nor two", "en" if i % 2 else "fr", {"rand": 1.0, "q": 0.125}) for i in range(40)], "key long, text string, language string, scores map<string,double>").coalesce(1)
    rows = scoring.with_scores(docs, load).collect()
    assert all(r.scores == {"q": 0.125, "rand": 0.25 if r.key % 2 else 0.5} for r in rows) and len(rows) == 40
    assert loaded.value == 2  # rows come sorted by language
    with pytest.raises(Exception, match="unsupported language fr"):
        scoring.with_scores(docs, load, supported=["en"]).collect()
    import pandas as pd

    model = scoring.train_classifier(pd.DataFrame({"text": ["good fine nice", "bad poor ugly"] * 10, "label": ["hi", "low"] * 10}), cells=1 << 10)
    best = [max(p, key=p.get) for p in model.predict(["fine", "ugly", ""])]
    assert best[:2] == ["__label__hi", "__label__low"] and set(model.labels()) == {"__label__hi", "__label__low"}


def test_resume_from_what_was_written(spark, tmp_path):
    state = spark.createDataFrame([("a", 3, False), ("b", -1, True)], "warc_file string, last_record_seen long, done boolean")
    path = str(tmp_path / "p.json")
    assert progress.load(spark, path).count() == 0
    progress.save(state, path)
    assert sorted(map(tuple, progress.load(spark, path).collect())) == [("a", 3, False), ("b", -1, True)]
    records = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "warc_file string, record_idx long")
    assert sorted(map(tuple, progress.unwritten(records, records.where("record_idx = 1")).collect())) == [("a", 2)]


def test_character_sets():
    late = b" " * 9000 + b"<meta charset=iso-8859-2>\xb1"
    assert decode_bytes(late)[-1] == "ą"
    assert decode_bytes("﻿žluť".encode("utf-16-le")) == "žluť" and decode_bytes("abcdé".encode("utf-16-le")) == "abcdé"
    assert decode_bytes(b"\x93quoted\x94") == "“quoted”" and decode_bytes(b"charset=nonsense \xe9") == "charset=nonsense é"


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Session:
        conf = {}
        sparkContext = type("C", (), {"master": "local-cluster[2,1,1024]", "applicationId": "none"})

    with pytest.raises(RuntimeError):
        storage.shared_dir(Session)


def test_signed_shares_equal_plain_python(spark):
    """The metrics of a struct are those of the single functions."""
    docs = spark.createDataFrame([("One two. One two. - x\n\nOne two", "en"), ("", "en"), ("- a\n* b\n1. c", "xx")], "text string, language string")
    single = docs.select(gopher.mean_word_length("text").alias("mean_word_length"), gopher.frac_words_with_alpha("text").alias("frac_words_with_alpha"), gopher.frac_lines_end_punctuation("text").alias("frac_lines_end_punctuation"), gopher.frac_lines_start_bullet("text").alias("frac_lines_start_bullet"), gopher.frac_alphabetic_chars("text").alias("frac_alphabetic_chars"), gopher.has_stop_words("text", "language").alias("has_stop_words"), gopher.frac_duplicate_sentences("text").alias("frac_duplicate_sentences"), gopher.frac_duplicate_paragraphs("text").alias("frac_duplicate_paragraphs"))
    assert [tuple(r) for r in gopher.with_metrics(docs).select("gopher.*").collect()] == [tuple(r) for r in single.collect()]
    assert np.isfinite([x for r in single.collect() for x in r]).all()
