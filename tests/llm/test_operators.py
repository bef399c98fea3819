"""The operators against SQL or brute force on small tables, and on odd ones."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations, permutations

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import importance, jaccard_join, license_scan, mixing, packing, quality_rules, substring_dedup, suffix_index
from lexmill.llm.common import by_bucket, components, hashed_sample
from lexmill.llm.kernels import thin, utf8

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=3, n=70):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["été", "straße", "Ünï"]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage = text(64)
    rows = []
    for i in range(n):
        t = text(rng.randint(5, 160))
        if i % 7 == 3 and rows:
            words = rng.choice(rows)[1].split()
            words[rng.randrange(len(words))] = "changed"
            t = " ".join(words)
        if i % 9 == 5:
            t += "\n" + passage + " " + text(5)
        if i % 13 == 6:
            t = "same line here\n" * 9 + t[:20]
        rows.append((i, t, "en", f"s{i % 3}", len(t)))
    rows += [(n, rows[4][1], "en", "s0", 1), (n + 1, rows[4][1], "en", "s1", 1), (n + 2, "", "en", "s1", 0), (n + 3, " \n ", "en", "s2", 3)]
    return rows


def duck(sql, rows):
    con = duckdb.connect()
    con.register("d0", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]))
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM d0")
    out = con.execute(sql)
    names = [c[0] for c in out.description]
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (dict(zip(names, r))[n] for n in sorted(names))) for r in out.fetchall()), key=str)


def rows_of(df):
    return sorted((tuple(round(r[n], 9) if isinstance(r[n], float) else r[n] for n in sorted(df.columns)) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [3, 4])
@pytest.mark.parametrize(
    "operator, sql",
    [
        (quality_rules.metrics, quality_rules.sql()),
        (lambda d: jaccard_join.linked(d, bucket_tokens=300, chunk_tokens=500, block_docs=8), jaccard_join.sql()),
        (lambda d: substring_dedup.intervals(d), substring_dedup.sql()),
        (lambda d: suffix_index.intervals(d, batches=3, shard_bytes=9000), substring_dedup.sql()),
        (mixing.counts, mixing.sql()),
    ],
    ids=["quality", "jaccard", "substrings", "suffixes", "mixing"],
)
def test_equals_sql(spark, operator, sql, seed):
    rows = corpus(seed)
    assert rows_of(operator(spark.createDataFrame(rows, SCHEMA))) == duck(sql, rows)


ODD = [(None, None, None, None, None), (1, None, None, "a", 0), (2, "", "en", None, 0), (3, "one two three four five", "en", "a", 1), (3, "one two three four five", "en", "a", 1), (None, "one two three four five", "en", "b", 1), (4, "x " * 30_000, "en", "b", 1), (5, "y" * 200_000, "en", "b", 1)]
CLASH = ", keep boolean, bucket int, part string, kind int, a long, b long, id long, first int, text_hash long, print long, bin int, w double, z int, share double, count int, fill int, starts string, key string, fold int"


def odd(spark, rows=ODD):
    return spark.createDataFrame([(*r, *[None] * CLASH.count(",")) for r in rows], SCHEMA + CLASH)


def grams(text, n=jaccard_join.NGRAM):
    ws = re.findall("[0-9A-Za-z\x80-\U0010ffff]+", text.lower())
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def jaccard(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a and b else 0.0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_jaccard_with_frequent_tokens_equals_sql(spark, monkeypatch, seed):
    """Many texts from few words: a third and more of the tokens are frequent, so that combinations are indexed."""
    monkeypatch.setattr(jaccard_join, "OFTEN", 3)
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randint(8, 120))] for _ in range(6)]
    rows = []
    for i in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(60)}"
        if rng.random() < 0.3:
            words += rng.choice(base)[: rng.randint(3, 40)]
        rows.append((i, " ".join(words), "en", "s", 1))
    count = Counter(g for r in rows for g in grams(r[1]))
    assert sum(n for n in count.values() if n > 3) >= 0.3 * sum(count.values())
    got = jaccard_join.linked(spark.createDataFrame(rows, SCHEMA), bucket_tokens=400, chunk_tokens=600, block_docs=16)
    assert rows_of(got) == duck(jaccard_join.sql(), rows)


def test_pairs_of_a_bucket_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, e = int(rng.integers(2, 90)), int(rng.integers(1, 40))
        entry, member = rng.integers(0, e, 500).astype(np.uint64), rng.integers(0, n, 500)
        size = rng.integers(1, 20, n)
        by = defaultdict(set)
        for x, m in zip(entry.tolist(), member.tolist()):
            by[x].add(m)
        want = {a << 32 | b for ms in by.values() for a in ms for b in ms if a < b and min(size[a], size[b]) >= 0.5 * max(size[a], size[b])}
        assert set(jaccard_join.pairs_of(entry, member, size, 0.5, small=int(rng.integers(1, 30))).tolist()) == want


def test_pairs_by_block_are_listed_or_in_blocks_compared_whole():
    rng = np.random.default_rng(5)
    for n, members, dense in ((0, 5, 4), (400, 30, 9), (900, 60, 30), (900, 60, 1), (500, 40, 10**6)):
        entry, member = rng.integers(0, 25, n).astype(np.uint64), rng.integers(0, members, n)
        block, size = rng.integers(0, 5, members) * 10, rng.integers(10, 40, members)
        whole, parts = jaccard_join.pairs_by_block(entry, member, block, size, 0.5, dense, most=50)
        whole = set(map(tuple, whole.tolist()))
        want, blocks = set(), set()
        for e in set(entry.tolist()):
            own = sorted(set(member[entry == e].tolist()))
            held = Counter(block[own].tolist())
            blocks |= {(a, b) for a in held for b in held if a <= b and held[a] * held[b] >= dense and (a != b or held[a] > 1)}
            want |= {a << 32 | b for a, b in combinations(own, 2) if min(size[a], size[b]) >= 0.5 * max(size[a], size[b])}
        assert whole == blocks
        inside = {x for x in want if tuple(sorted((int(block[x >> 32]), int(block[x & 0xFFFFFFFF])))) in whole}
        assert {int(x) for part in parts for x in part} - inside == want - inside


def test_shared_tokens_of_two_blocks_equal_brute_force():
    rng = np.random.default_rng(7)
    for n, n_one, same in ((30, 12, False), (30, 30, True), (200, 90, False), (1, 1, True)):
        sets = [np.flatnonzero(rng.random(60) < np.r_[np.full(20, 0.8), np.full(40, 0.04)]) for _ in range(n)]
        sets = [x if len(x) else np.array([0]) for x in sets]
        got = jaccard_join.shared_tokens(np.concatenate(sets).astype(np.int32), np.repeat(np.arange(n), list(map(len, sets))), n, n_one, same, columns=7)
        for i in range(n_one):
            for j in range(i + 1 if same else n_one, n):
                assert got[i, j - (0 if same else n_one)] == len(np.intersect1d(sets[i], sets[j]))


def test_a_large_group_of_near_copies_is_no_list_of_pairs(spark, monkeypatch):
    """20,000 sets that share entries: 200 million pairs, 1.6 GB as a list; and a group over many blocks of few sets."""
    n, entries = 20_000, 30
    entry, member = np.repeat(np.arange(entries, dtype=np.uint64), n), np.tile(np.arange(n), entries)
    whole, parts = jaccard_join.pairs_by_block(entry, member, np.arange(n) % 10, np.full(n, 100), 0.5, 2048**2 // 64)
    assert len(whole) == 55 and sum(map(len, parts)) == 0

    tables = {}
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name, real=jaccard_join.stored: tables.setdefault(name, real(df, name)))
    rng = random.Random(8)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(f"x{rng.randrange(99)}" if rng.random() < 0.04 else w for w in base), "en", "s", 1) for i in range(300)]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.linked(spark.createDataFrame(rows, SCHEMA), block_docs=64).collect()}
    sets = [grams(r[1]) for r in rows]
    links = Counter(x for a, b in combinations(range(300), 2) if len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b]) for x in (a, b))
    assert {k: v for k, (_, v) in got.items()} == {i: links[i] for i in range(300)}
    assert sum(links.values()) / 2 > 5_000 > 5 * tables["jaccard-candidates"].count()


def test_many_partners_and_very_long_texts(spark):
    rng = random.Random(4)
    long = [f"w{rng.randrange(5000)}" for _ in range(40_000)]
    base = [f"v{rng.randrange(900)}" for _ in range(150)]
    rows = [(i, " ".join(long[: 40_000 - 50 * i]), "en", "s", 1) for i in range(3)]
    for i in range(3, 140):
        words = list(base)
        for _ in range(rng.randint(1, 9)):
            words[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(words), "en", "s", 1))
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.linked(spark.createDataFrame(rows, SCHEMA), block_docs=32).collect()}
    sets = {r[0]: grams(r[1]) for r in rows}
    for i in range(140):
        near = [j for j in range(140) if j != i and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.5]
        assert got[i] == ((0 if i < 3 else 3), len(near))


def test_a_bounded_sample_is_the_first_in_hash_order(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    whole = [r.k for r in df.orderBy(F.pmod(F.xxhash64("k", F.lit(3)), F.lit(1 << 40)), "k").collect()]
    for most in (300, 3000, 9000):
        assert [r.k for r in hashed_sample(df, most, "k", seed=3).collect()] == whole[:most]


def test_buckets_are_dealt_out_without_another_exchange(spark):
    packed = spark.range(200).select((F.col("id") % 40).cast("int").alias("bucket"), "id")
    counted = by_bucket(packed, 40).count()
    assert {(r["bucket"], r["count"]) for r in counted.collect()} == {(b, 5) for b in range(40)}
    assert counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange ") == 1


def test_groups_of_links(spark):
    rng = random.Random(3)
    for n, m in ((1, 0), (40, 25), (60, 200)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + ([(i, i + 1) for i in range(100, 130)] if m else [])
        root = {x: x for e in edges for x in e}
        for _ in range(130):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: r for x, r in root.items() if x != r}


def test_repeated_rows_at_the_cut_of_a_source_are_all_taken(spark):
    rows = [(i, "text " * 40, "en", "a", 1) for i in range(9)] + [(9, "text " * 40, "en", "a", 1)] * 5
    for total in range(300, 2600, 300):
        got = Counter(r.doc_id for r in mixing.mixed(spark.createDataFrame(rows, SCHEMA), {"a": 1.0}, total).collect())
        assert got[9] in (0, 5, 10) and abs(sum(got.values()) - total / 200) <= 5.5


def test_values_of_an_exchange_keep_their_size():
    from lexmill.llm.common import exchange_sizes

    for items in (0, 1, 10**6, 10**9, 3 * 10**13):
        buckets, chunk = exchange_sizes(items, 1 << 20, 1 << 19)
        assert buckets >= 1 and items / buckets <= max(1 << 20, (32 * items) ** 0.5) + 1
        assert chunk / buckets >= 31 or buckets == 1


def test_batches_one_by_one_equal_all_at_once(spark):
    """Nine batches, the family opened anew after the fourth; the levels are those of the binary number nine."""
    rows = corpus(6, 90)
    docs = suffix_index.hashed_documents(spark.createDataFrame(rows, SCHEMA))
    family, found = suffix_index.IndexFamily(spark, 3), []
    for k in range(9):
        if k == 4:
            family = suffix_index.IndexFamily.open(spark, family.folder)
        found.append(family.add(suffix_index.send(docs.where(F.col("doc_id") % 9 == k), 3).drop("batch")))
    assert sorted(family.levels) == [0, 3]
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    want = duck(substring_dedup.sql(), rows)
    assert want and rows_of(suffix_index.merged_runs(whole)) == want
    tables = {t.name for t in spark.catalog.listTables()}
    assert rows_of(suffix_index.intervals(docs, batches=1)) == want
    assert {t.name for t in spark.catalog.listTables()} == tables == set(family.levels.values())
    family.drop()
    assert not spark.catalog.listTables()


def test_pipeline_keeps_one_of_a_large_group_without_a_list_of_pairs(spark, monkeypatch):
    tables = {}
    monkeypatch.setattr(jaccard_join, "stored", lambda df, name, real=jaccard_join.stored: tables.setdefault(name, real(df, name)))
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(f"x{i}y{rng.randrange(99)}" if rng.random() < 0.02 else w for w in base), "en", "s", 1) for i in range(2_200)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").count()
    sets = tables["jaccard-index"].count()
    assert kept < 30 and sets > 500
    assert tables["jaccard-candidates"].count() < sets**2 // 8


def test_pipeline_bounds_the_bytes_of_an_index_bucket(spark, monkeypatch):
    """Each set comes to nearly as many buckets as it has entries, with ten times the bytes of an entry."""
    packed = []

    def watched(df, buckets, real=by_bucket):
        if "sign" in df.columns:
            total = sum((F.octet_length(k) for k, kind in df.dtypes if kind == "binary"), F.lit(0))
            packed.append((df.agg(F.sum(total)).first()[0], buckets))
        return real(df, buckets)

    monkeypatch.setattr(jaccard_join, "by_bucket", watched)
    # the stage with small buckets, as a large table has many
    monkeypatch.setattr(jaccard_join, "linked", lambda docs, ngram, threshold, real=jaccard_join.linked: real(docs, ngram, threshold, 2048, 4096))
    rng = random.Random(12)
    rows = []
    for i in range(0, 1000, 2):
        words = [f"w{rng.randrange(9000)}" for _ in range(60)]
        rows += [(i, " ".join(words), "en", "s", 1), (i + 1, " ".join([*words[:20], "changed", *words[21:]]), "en", "s", 1)]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert {r.doc_id for r in kept.collect()} == set(range(0, 1000, 2))
    ((total, buckets),) = packed
    assert buckets > 8 and total / buckets <= 2048 * 16


def test_index_buckets_keep_their_bytes_at_any_size():
    for n in (0, 1, 10**3, 10**5, 10**7, 10**9):
        buckets, chunk = jaccard_join.index_sizes(75 * n, n, 1 << 20, 1 << 19)
        met = n * buckets * (1 - (1 - 1 / buckets) ** 75)  # sets in all buckets
        assert (6 * 75 * n + jaccard_join.MEMBER_BYTES * met) / buckets <= 16 * max(1 << 20, (32 * 4 * 75 * n) ** 0.5) * 1.01
        assert chunk / buckets >= 8 or buckets == 1
    batch = pa.RecordBatch.from_pydict({"a": [bytes(100)] * 50})
    parts = list(thin(batch, 1000))
    assert len(parts) > 5 and max(p.num_rows for p in parts) <= 10 and pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def test_no_level_is_merged_after_the_last_batch(spark, monkeypatch):
    written = []
    monkeypatch.setattr(suffix_index.IndexFamily, "_write", lambda self, rows, real=suffix_index.IndexFamily._write: written.append(real(self, rows)) or written[-1])
    rows = corpus()
    assert rows_of(suffix_index.intervals(spark.createDataFrame(rows, SCHEMA), batches=4, shard_bytes=9000)) == duck(substring_dedup.sql(), rows)
    assert len(written) == 4 + 1  # a level of each batch, and the first two merged
    assert not any(spark.catalog.tableExists(x) for x in written)


def test_odd_rows(spark):
    docs = odd(spark)
    assert quality_rules.metrics(docs).count() == len(ODD)
    assert {r.doc_id for r in quality_rules.keep_documents(docs).collect()} == {3, None, 5}
    # equal rows with one id are one document; null ids are left out
    assert sorted(map(tuple, jaccard_join.linked(docs).collect())) == [(i, i, 0) for i in (1, 2, 3, 4, 5)]
    assert jaccard_join.keep_one(docs).count() == len(ODD)
    assert [tuple(r) for r in substring_dedup.intervals(docs).collect()] == [(4, 0, 30_000)]
    assert [tuple(r) for r in suffix_index.intervals(docs).collect()] == [(4, 0, 30_000)]
    left = substring_dedup.cut(docs)
    assert left.columns == docs.columns and left.count() == len(ODD) - 1
    assert mixing.mixed(docs).columns == docs.columns
    assert license_scan.scan(docs).count() == 0
    placed = packing.packed(docs).collect()
    assert sum(r.n_tokens for r in placed) == 3 * 5 + 30_000 + 1
    labels = spark.createDataFrame([(3, 1, None), (4, 0, 1), (None, 1, 0), (99, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in importance.resampled(docs, labels).collect()} <= {3, 4, 5, None}


def test_empty_tables(spark):
    docs = odd(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_label = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for out in (
        quality_rules.metrics(docs), quality_rules.keep_documents(docs), jaccard_join.linked(docs), jaccard_join.keep_one(docs), substring_dedup.intervals(docs), substring_dedup.cut(docs),
        suffix_index.intervals(docs), mixing.counts(docs), mixing.mixed(docs), license_scan.scan(docs), packing.packed(docs), importance.resampled(docs, labels), importance.resampled(docs, one_label),
    ):
        assert out.count() == 0


def test_licenses_are_found_with_changes_and_spans(spark):
    mit = license_scan.TEMPLATES["mit"]
    words = mit.split()
    changed = " ".join(words[:40] + ["foo"] + words[41:90] + words[92:])
    clean = "nothing of the kind is said in this text at all and so on " * 20
    before = "Été – préface. "
    docs = spark.createDataFrame([(1, before + mit + " after"), (2, changed), (3, clean), (4, clean + license_scan.TEMPLATES["mit-notice"]), (5, mit + "\n\n" + mit)], "doc_id long, text string")
    got = defaultdict(list)
    for r in license_scan.scan(docs).collect():
        got[r.doc_id].append(r)
    assert set(got) == {1, 2, 4, 5} and len(got[5]) == 2
    (whole,), (near,), (notice,) = got[1], got[2], got[4]
    assert whole.coverage == 1.0 and (before + mit)[whole.start_char : whole.end_char] == mit.rstrip(".")
    assert near.template == "mit" and 0.9 < near.coverage < 1
    assert notice.template == "mit-notice" and notice.coverage == 1.0


def test_the_shortest_notice_is_found_among_any_words(spark):
    docs = spark.createDataFrame([(i, f"word{i} other{i}. All rights reserved. next{i} last{i}") for i in range(40)], "doc_id long, text string")
    got = license_scan.scan(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(40))
    assert {(r.template, r.n_matched, r.start_token, r.end_token) for r in got} == {("all-rights-reserved-notice", 3, 2, 5)}


def test_a_notice_on_successive_lines_is_found_on_each(spark):
    texts = [license_scan.TEMPLATES[n] for n in ("mit-notice", "cc-by-nc-4.0-notice", "gpl-3.0-notice", "all-rights-reserved-notice")]
    docs = spark.createDataFrame([(i, "\n".join([x] * 7)) for i, x in enumerate(texts)], "doc_id long, text string")
    spans = defaultdict(list)
    for r in license_scan.scan(docs).collect():
        spans[r.doc_id].append((r.start_token, r.end_token))
    for i, x in enumerate(texts):
        n = len(license_scan.words(x))
        assert sorted(spans[i]) == [(k * n, k * n + n) for k in range(7)]


def alignment(doc, template):
    """Score of the best local alignment without a band."""
    best, before = 0, [0] * (len(doc) + 1)
    for t in template:
        now = [0]
        for j, d in enumerate(doc):
            now.append(max(0, before[j] + (1 if d == t else -1), before[j + 1] - 1, now[-1] - 1))
        best, before = max(best, *now), now
    return best


def edits(doc, template):
    """Most matches of an alignment of the whole of ``doc`` with any part of the template that scores so much as the best."""
    score = alignment(doc, template)
    states = {}
    before = [(0, 0)] + [(-j, 0) for j in range(1, len(doc) + 1)]
    states[0] = before[-1]
    for i, t in enumerate(template, 1):
        now = [(0, 0)]
        for j, d in enumerate(doc):
            s, m = before[j]
            now.append(max((s + 1, m + 1) if d == t else (s - 1, m), (before[j + 1][0] - 1, before[j + 1][1]), (now[-1][0] - 1, now[-1][1])))
        before = now
        states[i] = now[-1]
    return max((m for s, m in states.values() if s == score), default=None)


def test_banded_alignment_equals_the_full_one():
    """The span that is reported, aligned as a whole, scores what the best local alignment does, with as many matches."""
    rng = random.Random(5)
    for _ in range(60):
        template = [rng.randrange(6) for _ in range(rng.randint(4, 25))]
        doc = [rng.randrange(6) for _ in range(rng.randint(0, 8))] + [x if rng.random() > 0.1 else rng.randrange(6) for x in template if rng.random() > 0.1] + [rng.randrange(6) for _ in range(rng.randint(1, 8))]
        matched, start, end = license_scan.align(np.array(doc), np.array(template), -60, 60)
        score = alignment(doc, template)
        assert score == alignment(doc[start:end], template)
        assert not score or matched == edits(doc[start:end], template)


def test_winnowing_guarantee():
    """Of any K + W - 1 words in a row at least one fingerprint is kept, and it is the same wherever they stand."""
    rng = np.random.default_rng(1)
    words = rng.integers(0, 50, 400).astype(np.uint64)
    row = np.sort(rng.integers(0, 12, 400))
    for k, w in ((3, 2), (5, 4), (2, 7)):
        hashed, first = license_scan.winnow(words, row, k, w)
        for i in range(400 - (k + w - 1) + 1):
            if row[i] == row[i + k + w - 2]:
                assert ((first >= i) & (first <= i + w - 1)).any()
        again, place = license_scan.winnow(np.concatenate([words[:7], words]), np.concatenate([np.full(7, -1), row]), k, w)
        assert set(zip(hashed.tolist(), (first + 7).tolist())) <= set(zip(again.tolist(), place.tolist()))


def test_planted_bodies_are_measured(spark):
    """Every template in strange words, with words changed, left out and put in: coverage is the share of template words that an
    alignment in full finds, and the span holds them."""
    rng = random.Random(9)
    names = [n for n, t in license_scan.TEMPLATES.items() if len(license_scan.words(t)) > 30]
    docs = []
    for i, name in enumerate(names):
        ws = re.findall(r"\S+", license_scan.TEMPLATES[name])
        for at in rng.sample(range(len(ws)), len(ws) // 25):
            ws[at] = rng.choice(["changed", "", f"{ws[at]} added"])
        around = lambda n: " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))
        docs.append((i, f"{around(37)} {' '.join(ws)} {around(20)}"))
    got = defaultdict(list)
    for r in license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        got[r.doc_id].append(r)
    for i, text in docs:
        template, doc = license_scan.words(license_scan.TEMPLATES[names[i]]).tolist(), license_scan.words(text).tolist()
        (r,) = [x for x in got[i] if x.template == names[i]]
        assert alignment(doc[r.start_token : r.end_token], template) == alignment(doc, template)
        assert r.coverage == r.n_matched / len(template) and r.n_matched <= len(template)
        assert 37 <= r.start_token and r.end_token <= len(doc) - 20


def test_templates_of_one_and_two_words(spark):
    docs = spark.createDataFrame([(1, "text under CC0 here"), (2, "dual use: CC0 1 or so"), (3, "nothing")], "doc_id long, text string")
    got = sorted((r.doc_id, r.template, r.start_token, r.end_token) for r in license_scan.scan(docs, {"one": "CC0", "two": "use CC0"}).collect())
    assert got == [(1, "one", 2, 3), (2, "two", 1, 3)]


def gains(bins, sizes, capacity):
    """Whether a move or an exchange of one for one, two for one or one for two between underfull bins raises the squared fills."""
    fill = [sum(sizes[i] for i in b) for b in bins]
    under = [k for k in range(len(bins)) if fill[k] < capacity]
    some = lambda b: [()] + [(i,) for i in b] + list(combinations(b, 2))
    for a, b in permutations(under, 2):
        if fill[a] <= fill[b]:  # a bin takes from less full ones
            continue
        for out in some(bins[a]):
            for taken in some(bins[b]):
                if taken and len(out) + len(taken) <= 3:
                    more = sum(sizes[i] for i in taken) - sum(sizes[i] for i in out)
                    if 0 < more <= capacity - fill[a]:
                        return True
    return False


def optimum(sizes, capacity):
    """Fewest bins, by trying all."""
    best = len(sizes)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(sizes):
            best = len(free)
            return
        for j in range(len(free)):
            if free[j] >= sizes[k]:
                place(k + 1, free[:j] + [free[j] - sizes[k]] + free[j + 1 :])
        place(k + 1, free + [capacity - sizes[k]])

    place(0, [])
    return best


def test_no_exchange_is_left_and_small_packings_are_best():
    rng = random.Random(7)
    extra = 0
    for n in range(120):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 8))]
        bins = packing.local_search(packing.best_fit(sizes, 30), sizes, 30)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes))) and all(0 < sum(sizes[i] for i in b) <= 30 for b in bins)
        assert not gains(bins, sizes, 30)
        extra += len(bins) - optimum(sizes, 30)
    assert extra == 0
    for n in range(12):
        sizes = [rng.randint(1, 40) for _ in range(60)]
        assert not gains(packing.local_search([[i] for i in range(60)], sizes, 64), sizes, 64)


def fewest_bins(sizes, capacity):
    """The bound L2 of Martello and Toth: no packing has fewer bins."""
    best = 0
    for small in range(capacity // 2 + 1):
        full, large = sizes[sizes > capacity - small], sizes[(sizes > capacity // 2) & (sizes <= capacity - small)]
        rest = sizes[(sizes >= small) & (sizes <= capacity // 2)].sum() - (capacity * len(large) - large.sum())
        best = max(best, len(full) + len(large) + max(0, -(-rest // capacity)))
    return best


def test_packing_places_every_token_and_search_helps(spark):
    rng = random.Random(1)
    sizes = [rng.randint(1, 60) for _ in range(400)]
    first = packing.best_fit(sizes, 64)
    after = packing.local_search(first, sizes, 64)
    assert sorted(i for b in after for i in b) == list(range(400)) and all(sum(sizes[i] for i in b) <= 64 for b in after)
    square = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    assert len(after) <= len(first) and square(after) >= square(first)
    poor = [[i] for i in range(400)]
    assert len(packing.local_search(poor, sizes, 64)) <= len(first) * 1.02
    docs = spark.createDataFrame([(i, "t " * n) for i, n in enumerate([*sizes, 1000, 0])], "doc_id long, text string")
    placed = packing.packed(docs, capacity=64, shard_pieces=90).toPandas()
    assert placed.n_tokens.sum() == sum(sizes) + 1000
    bins = placed.sort_values(["bin_id", "slot"]).groupby("bin_id")
    assert bins.n_tokens.sum().max() <= 64
    assert all((g.start.to_numpy() == np.cumsum(g.n_tokens) - g.n_tokens).all() for _, g in bins)
    assert len(bins) <= 1.02 * fewest_bins(placed.n_tokens.to_numpy(), 64)


MASK = (1 << 64) - 1


def mixed_bits(x):
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & MASK
    return x ^ x >> 31


def feature_cells(text):
    """Cells of words and word pairs by plain integers: a polynomial over the bytes of a word, one over the hashes of two words."""
    words = [w.encode() for w in re.findall("[^ \t\n\x0b\f\r]+", text)]
    hashed = [mixed_bits((sum((b + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, b in enumerate(w)) + len(w)) & MASK) for w in words]
    pairs = [mixed_bits(mixed_bits((a + b * 0xD6E8FEB86659FD93 + 2) & MASK)) for a, b in zip(hashed, hashed[1:])]
    return np.array([h % importance.CELLS for h in hashed + pairs], np.int64)


def noise(doc_id):
    u = ((mixed_bits((mixed_bits(doc_id & MASK) + importance.SEED) & MASK) >> 12) + 0.5) / 2**52
    return -math.log(-math.log(u))


def test_noise_is_standard_gumbel():
    x = importance.gumbel(np.arange(200_000))
    assert abs(x.mean() - 0.5772) < 0.01 and abs(x.var() - math.pi**2 / 6) < 0.02
    assert abs((x < 1.0).mean() - math.exp(-math.exp(-1.0))) < 0.005


def test_rows_tied_at_the_cut_are_all_taken(spark):
    rows = [(i, "good text here now") for i in range(10)] + [(10, "other words of bad kind")] * 6
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(11)], "doc_id long, quality int, toxic int")
    got = Counter(r.doc_id for r in importance.resampled(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect())
    assert got[10] in (0, 6) and sum(got.values()) >= 7


def test_resampling_equals_brute_force(spark):
    rows = [(i, t) for i, t, *_ in corpus(8, 60)]
    labels = [(i, i % 2, 0) for i in range(40)]
    got = {r.doc_id: (r.n_features, r.log_weight, r.key) for r in importance.resampled(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    cells = {i: feature_cells(t) for i, t in rows}
    raw, good = np.ones(importance.CELLS), np.ones(importance.CELLS)
    for i, c in cells.items():
        np.add.at(raw, c, 1)
        if i < 40 and i % 2:
            np.add.at(good, c, 1)
    ratio = np.log(good / good.sum()) - np.log(raw / raw.sum())
    keys = {i: ratio[c].sum() + noise(i) for i, c in cells.items() if len(c)}
    want = sorted(keys, key=keys.get, reverse=True)[: int(0.5 * len(rows) + 0.5)]
    assert set(got) == set(want)
    assert all(abs(got[i][2] - keys[i]) < 1e-6 for i in want)


def test_pipeline_equals_its_stages_in_brute_force(spark, tmp_path):
    rows = corpus(11, 80)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    by_id = {r[0]: list(r) for r in rows}
    names = sorted(["doc_id", "n_words", "n_chars_words", "dup_2gram_frac", "dup_3gram_frac", "dup_5gram_frac", "dup_7gram_frac", "dup_10gram_frac", "dup_line_frac", "keep"])
    kept = [r[names.index("doc_id")] for r in duck(quality_rules.sql(), rows) if r[names.index("keep")]]
    root = {i: i for i in kept}
    pairs = [(a, b) for a in kept for b in kept if a < b and jaccard(by_id[a][1], by_id[b][1]) >= jaccard_join.THRESHOLD]
    for _ in kept:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    kept = [i for i in kept if root[i] == i]
    cuts = defaultdict(list)
    for i, end, start in duck(substring_dedup.sql(), [by_id[i] for i in kept]):
        cuts[i].append((start, end))
    texts = {i: substring_dedup.remove_tokens(by_id[i][1], *zip(*sorted(cuts[i]))) if cuts[i] else by_id[i][1] for i in kept}
    kept = [i for i in kept if texts[i].split()]
    copies = {i: c for c, i, _ in duck(mixing.sql(), [(i, texts[i], "", by_id[i][3], 0) for i in kept])}
    want = Counter()
    for i, c in copies.items():
        want[i] = c * len(texts[i].split())
    assert cuts and pairs
    assert Counter(got.groupby("doc_id").n_tokens.sum().to_dict()) == want
    assert got.groupby("bin_id").n_tokens.sum().max() <= packing.CAPACITY


@pytest.mark.parametrize("large", [50, (1 << 63) - 1])
def test_pipeline_keeps_one_row_of_repeated_rows_and_null_ids(spark, large):
    rng = random.Random(8)
    t = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(90)) for _ in range(8)]
    near = lambda text: text.rsplit(" ", 1)[0] + " changed"
    pairs = [(0, t[0]), (0, t[0]), (1, t[1]), (None, t[1]), (None, t[2]), (None, t[2]), (3, t[3]), (3, near(t[3])), (None, t[4]), (None, near(t[4])), (5, t[5]), (large, t[6]), (None, near(t[6])), (3, t[7]), (2, t[7])]
    docs = spark.createDataFrame([(i, x, "en", f"s{n}", len(x)) for n, (i, x) in enumerate(pairs)], SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, "")
    got = [(r.doc_id, min(r.text, near(r.text))[:60]) for r in docs.collect()]
    want = [(0, 0), (1, 1), (None, 2), (3, 3), (None, 4), (5, 5), (large, 6), (2, 7)]
    assert sorted(got, key=str) == sorted(((i, t[n][:60]) for i, n in want), key=str)
    assert all(len(r.text.split()) == 90 for r in docs.collect())


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.createDataFrame(corpus(2, 40), SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").schema.names == docs.schema.names


def test_utf8_of_slices_and_nulls():
    import pyarrow as pa

    data, offsets = utf8(pa.array(["a", None, "été", ""])[1:])
    assert bytes(data).decode() == "été" and offsets.tolist() == [0, 0, 5, 5]
