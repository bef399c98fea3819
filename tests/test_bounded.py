"""Steps whose memory, tasks or time once grew with the table."""

import gzip
import re
from contextlib import contextmanager

import zstandard
from pyspark.sql import functions as F

from lexmill import queries
from lexmill.sources import jsonl, warc

SF = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_an_archive_is_written_by_several_tasks(spark):
    with settings(spark, spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="24"):
        folder = queries.write_pages_as_archives(spark, SF)
    files = warc.found(folder, "*")
    assert len(files) == 8 and all(f.endswith(".warc.gz") for f in files)
    data = [open(re.sub("^file:/*", "/", f), "rb").read() for f in files]
    assert sum(len(re.findall(rb"\x1f\x8b\x08\x00.{4}\x04\xff", x, re.S)) for x in data) > 8  # members
    ids = [[int(x) for x in re.findall(rb"Record-ID: <urn:(\d+)>", gzip.decompress(x))[1::2]] for x in data]
    assert all(own == sorted(own) and {x % 8 for x in own} == {k} for k, own in enumerate(ids))
    assert sum(map(len, ids)) == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_a_group_is_written_by_several_tasks(spark, tmp_path):
    docs = spark.range(4000, numPartitions=4).select(F.col("id").alias("record_idx"), F.sha2(F.col("id").cast("string"), 512).alias("text"), F.lit(3).alias("group_idx"))
    path = tmp_path / "out"
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="32k"):
        jsonl.write_jsonl(docs, str(path))
    assert [p.name for p in path.iterdir() if not p.name.startswith(".")] == ["3.jsonl.zstd"]
    assert (path / "3.jsonl.zstd").read_bytes().count(zstandard.FRAME_HEADER) > 1
    got = jsonl.read_jsonl(spark, str(path), docs.schema)
    assert got.count() == 4000 and got.exceptAll(docs).isEmpty()


def test_batches_of_a_stream_are_several_files(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "new_folder", lambda spark, name: str(tmp_path / name))
    got = queries.stream_line_dedup(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(list(tmp_path.glob("stream/in/*.parquet"))) > 4
    assert sorted(p.name for p in tmp_path.glob("stream/out/*")) == [f"batch={k}" for k in range(4)]


def test_signatures_of_many_texts_are_those_of_each():
    import numpy as np

    from lexmill.operators.minhash import signature_of, signatures_of

    texts = [b"", b"abcd", b"abcde", b"", b"a" * 400, *(b"%d and some words more, %d" % (k, k * k) * (k % 9) for k in range(300)), b"xyz"]
    ends = np.cumsum([0, *map(len, texts)])
    for n, ngram in ((128, 5), (7, 1), (5, 3), (3, 8)):
        assert (signatures_of(np.frombuffer(b"".join(texts), np.uint8), ends, n, ngram) == np.stack([signature_of(t, n, ngram) for t in texts])).all()


def test_slices_of_a_batch_are_bounded():
    import pyarrow as pa

    from lexmill.functions.batches import mapped, slices

    column = pa.array(["", None, "abc", "é" * 10, "x", "y" * 50, None])
    assert [x for part in slices(column, 20, 3) for x in part.to_pylist()] == column.to_pylist()
    assert max(len(part) for part in slices(column, 20, 3)) == 3
    assert mapped(column, len, pa.int64()).to_pylist() == [0, None, 3, 10, 1, 50, None]


def test_a_model_gets_the_lines_of_a_slice(spark):
    from lexmill.operators import scoring

    class Model(queries.LengthModel):
        def predict(self, texts):
            assert sum(map(len, texts)) < 3 << 20, "lines of a whole batch"
            return super().predict(texts)

    docs = spark.range(3000, numPartitions=1).select(F.repeat(F.lit("some words\n"), 200).alias("text"), F.lit("en").alias("language"))
    assert scoring.with_scores(docs, lambda lang: Model()).where("scores['rand'] > 0").count() == 3000


def test_a_filter_is_built_in_segments(spark, monkeypatch):
    from lexmill.functions import bloom

    monkeypatch.setattr(bloom, "SEGMENT_BYTES", 100)
    lines = [f"line {k}" * (k % 5) for k in range(500)]
    want = bloom.BloomFilter.empty(1 << 13, 5)
    want.set(lines)
    got = bloom.build(spark.createDataFrame([(x,) for x in lines], "line string"), "line", 1 << 13, 5)
    assert (got.bits == want.bits).all() and got.get(lines).all()
    other = [f"none {k}" for k in range(2000)]
    assert got.get(other).tolist() == [all(got.bits[h // 8] >> (h % 8) & 1 for h in (int(bloom.hashes([x.encode()], s)[0]) % (1 << 13) for s in bloom.SEEDS[:5])) for x in other]


def test_repeated_windows_against_a_set():
    import random

    from lexmill.functions.metrics import _repeated_windows

    r = random.Random(1)
    for n in (1, 2, 3, 8, 13, 20, 24):
        for _ in range(30):
            data = bytes(r.choice(b"ab") for _ in range(r.randint(n + 1, n + 40)))
            own = [data[k : k + n] for k in range(1, len(data) - n + 1)]
            assert _repeated_windows(data, n, 1, len(data) - n + 1) == len(own) - len(set(own))
