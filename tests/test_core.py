"""Text metrics, filters, sources, dedup, scores and streams on literal cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill import queries
from lexmill.functions import gopher, metrics
from lexmill.functions.html import decode_bytes, main_text
from lexmill.operators import minhash, progress, scoring
from lexmill.operators.line_dedup import dedup_lines, repeated_lines
from lexmill.sources import jsonl, manifest, warc
from lexmill.streaming.incremental import dedup_stream

DOC = "record_idx long, text string, group_idx int"


def value(spark, text, column):
    return spark.createDataFrame([(text, "en")], "text string, language string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, column, want",
    [
        ("", gopher.mean_word_length, 0),
        ("- a\n* b\n- c\n* d", gopher.frac_lines_start_bullet, 1.0),
        ("1. a\n22. b\nplain", gopher.frac_lines_start_bullet, 2 / 3),
        ("One.\nTwo!\nthree", gopher.frac_lines_end_punctuation, 2 / 3),
        ("Hello World", gopher.frac_alphabetic_chars, 10 / 11),
        ("12 34 5", gopher.frac_words_with_alpha, 0),
        ("Same here. Other. Same here.", gopher.frac_duplicate_sentences, 10 / 26),
        ("a para\n\nother\n\na para", gopher.frac_duplicate_paragraphs, 6 / 17),
        ("a para\n\nother", gopher.frac_duplicate_paragraphs, 0),
        ("", metrics.long_words, 0),
        ("tiny words", metrics.long_words, 0),
        ("x" * 15, metrics.repetitions, 0),
    ],
)
def test_metric(spark, text, column, want):
    assert value(spark, text, column("text")) == pytest.approx(want, abs=1e-6)


def test_stop_words_and_unknown_language(spark):
    df = spark.createDataFrame([("le chat est dans la maison et le jardin", "fr"), ("the cat sat", "fr"), ("whatever", "xx"), ("the,", "en")], "text string, language string")
    assert [r.x for r in df.select(gopher.has_stop_words("text", "language").alias("x")).collect()] == [1.0, 0.0, 1.0, 0.0]


def test_gate_bounds_are_single_precision(spark):
    m = {n: F.lit(float(np.float32(x))) for n, x in zip(gopher.METRICS, (5, 0.8, 0.1, 0.9, 0.75, 1, 0, 0))}
    low = m | {"frac_alphabetic_chars": F.lit(float(np.float32(0.7)))}
    row = spark.range(1).select(gopher.first_failed_rule(m).alias("a"), gopher.first_failed_rule(low).alias("b")).first()
    assert (row.a, row.b) == (None, "alphabetic_chars")


def test_repetitions_against_sets(spark):
    rng = random.Random(2)
    for _ in range(5):
        text = "".join(rng.choice("aé") for _ in range(60)) * 3
        data = text.encode()
        windows = [data[i : i + 20] for i in range(1, len(data) - 19)]
        assert value(spark, text, metrics.repetitions("text")) == pytest.approx((len(windows) - len(set(windows))) / len(data), abs=1e-6)


def dedup_brute(rows, threshold):
    import re

    seen, out = set(), {}
    for i, text in rows:
        kept = ""
        for para in re.split("\n\n+", text):
            new = 0
            for line in para.split("\n"):
                if line not in seen:
                    seen.add(line)
                    new += len(line.encode())
            if para and np.float32(new) / np.float32(len(para.encode())) > np.float32(threshold):
                kept += para + "\n\n"
        out[i] = kept
    return out


def test_line_dedup_against_a_loop(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(["a\n", "bé\n", "\n", "\n\n\n", "line of its own\n", f"x{i}\n", "tail"]) for _ in range(9))) for i in range(60)] + [(60, "")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], DOC)
    for n in (1, 4):
        got = {r.record_idx: r.text for r in dedup_lines(docs.repartition(n)).collect()}
        assert got == dedup_brute(rows, 0.2)
    seen, want = set(), []
    for i, t in rows:
        for k, line in enumerate(t.split("\n")):
            if line in seen:
                want.append((i, k, line))
            seen.add(line)
    assert sorted((r.ord, r.l, r.line) for r in repeated_lines(docs).collect()) == sorted(want)


def test_signatures_and_greedy_rounds_against_a_loop(spark):
    assert (minhash.signature_of(b"hi", 16) == np.uint64(2**64 - 1)).all()
    assert [len(minhash.signature_of(b"some text here", n)) for n in (1, 4, 64)] == [1, 4, 64]
    data = "some tëxt".encode()
    want = [min(minhash.fnv1a(data[i : i + 5], int(s)) for i in range(len(data) - 4)) for s in minhash.seeds(4)]
    assert minhash.signature_of(data, 4).tolist() == want
    assert [minhash.bands_and_rows(t, 128) for t in (0.8, 0.5, 0.9)] == [(9, 13), (25, 5), (5, 25)]
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(12)]
    texts = []
    for i in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = "z"
        texts.append("".join(t))
    texts += ["abc", "x"]
    b, r = minhash.bands_and_rows(0.8, 128)
    kept, gone = set(), set()
    for i, t in enumerate(texts):
        s = minhash.signature_of(t.encode())
        keys = {(k, s[k * r : k * r + r].tobytes()) for k in range(b)}
        if keys & kept:
            gone.add(i)
        else:
            kept |= keys
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], DOC)
    assert {x.ord for x in minhash.near_duplicate_ids(docs).collect()} == gone


def test_weighted_scores(spark):
    docs = spark.createDataFrame([(1, "ab\n\nabcd", "en"), (2, "", "en")], "key long, text string, language string")
    scored = scoring.with_scores(docs, lambda lang: queries.LengthModel(), prefix="q_")
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r.key: r.scores for r in scored.collect()}
    assert math.isclose(got[1]["q_rand"], round((3 * 3 / 97 + 5 * 5 / 97) / 8, 2), abs_tol=0.0051) and got[2] == {}


def test_archives_and_compressed_lines(spark, tmp_path):
    import gzip

    body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<p>one</p>"
    folder = tmp_path / "segments" / "123.7" / "warc"
    folder.mkdir(parents=True)
    with gzip.open(folder / "a.warc.gz", "wb") as out:
        for kind in ("warcinfo", "response"):
            out.write(f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n")
    (row,) = warc.read_warc(spark, str(tmp_path)).collect()
    assert (bytes(row.payload), row.record_idx, row.group_idx) == (b"<p>one</p>", 1, 7)
    docs = spark.createDataFrame([(1, "a\nb", 0), (2, "é", 1)], DOC)
    path = str(tmp_path / "out")
    jsonl.write_jsonl(docs, path)
    assert jsonl.committed_groups(path) == [0, 1]
    jsonl.write_jsonl(docs.withColumn("text", F.lit("other")), path)  # groups that are there stay
    assert sorted((r.record_idx, r.text, r.group_idx) for r in jsonl.read_jsonl(spark, path, docs.schema).collect()) == [(1, "a\nb", 0), (2, "é", 1)]


def test_manifest_and_selectors(spark):
    paths = spark.createDataFrame([(f"crawl-data/C/segments/1.{g}/warc/{f}",) for g, f in ((1, "b"), (0, "z"), (1, "a"))], "path string")
    assert {r.group_idx: r.files[0][-1] for r in manifest.archive_groups(paths).collect()} == {0: "z", 1: "a"}
    with pytest.raises(ValueError):
        manifest.archive_groups(paths.where("path LIKE '%.1/%'"))
    assert manifest.parse_groups("ALL", 3) == [0, 1, 2] and manifest.parse_groups("10-50", 90)[-1] == 49 and manifest.parse_groups("1,8,13", 90) == [1, 8, 13]
    for bad in ("x", "1-3,5"):
        with pytest.raises(ValueError):
            manifest.parse_groups(bad, 90)


def test_resume(spark):
    records = spark.createDataFrame([("a", i) for i in range(4)] + [("b", 0), ("c", 0)], "warc_file string, record_idx long")
    state = progress.progress(records.where("warc_file = 'a' AND record_idx < 2"), records, spark.createDataFrame([("c",)], "warc_file string"))
    assert progress.records_seen(state).first()[0] == -1
    assert sorted(map(tuple, progress.remaining(records, state).collect())) == [("a", 2), ("a", 3), ("b", 0)]


def test_html_and_character_sets():
    assert main_text("<head><title>t</title></head><nav>menu</nav><p>One <b>two</b></p><script>x</script><p>three &amp; four</p>") == "One two\nthree & four"
    assert decode_bytes("é".encode()) == "é" and decode_bytes(b"<meta charset=iso-8859-1>\xe9")[-1] == "é"


def test_stream_equals_batches_in_order(spark, tmp_path):
    rows = [(0, "one line\nother line"), (1, "one line\nother line"), (2, "new words here\none line")]
    source = tmp_path / "in"
    out, seen, check = (str(tmp_path / x) for x in ("out", "seen", "check"))
    for i, t in rows:
        spark.createDataFrame([(i, t, 0)], DOC).coalesce(1).write.mode("append").parquet(str(source))
        dedup_stream(spark.readStream.schema(DOC).parquet(str(source)), out, seen, check).trigger(availableNow=True).start().awaitTermination()
    got = {r.record_idx: r.text for r in spark.read.schema(DOC).parquet(f"{out}/batch=*").collect()}
    assert got == dedup_brute(rows, 0.2)


def test_every_core_query_has_columns(spark):
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert queries.gate_summary(spark, "/root/testdata/sf0.001").columns == ["lang", "kept", "dropped"]
