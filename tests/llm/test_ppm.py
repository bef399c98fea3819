import math
import random
import re
from collections import Counter

import pytest

from lexmill.llm import ppm


def brute(rows):
    """Scores by the dictionary trie, trained without learning on the scored text."""
    out = []
    long, seen = ppm.LONG, Counter()
    for _, text, _ in rows:
        ws = (text or "").split()
        seen.update(tuple(ws[i : i + long + 1]) for i in range(len(ws) - long))
    for doc_id, text, fold in rows:
        model = {}
        for _, other, g in rows:
            if g != fold:
                ppm.adaptive_bits((other or "").encode(), model=model)
        ws = list(re.finditer(r"\S+", text or ""))
        flags = [seen[tuple(w[0] for w in ws[i : i + long + 1])] > 1 for i in range(len(ws) - long)]
        free = set()
        for w, known in zip(ws[long:], flags):
            if known:
                free |= set(range(len(text[: w.start()].encode()), len(text[: w.end()].encode())))
        each = [0.0]
        for k in range(len((text or "").encode())):
            each.append(ppm.adaptive_bits((text or "").encode()[: k + 1], model=model, learn=False))
        bits = sum(b - a for k, (a, b) in enumerate(zip(each, each[1:])) if k not in free)
        bits += math.log2((len(flags) + 1) * math.comb(len(flags), sum(flags))) if flags else 0.0
        out.append((doc_id, len((text or "").encode()), bits))
    return out


LINE = "one two three föur five six seven eight nine ten eleven twelve"
TEXTS = ["the cat sat on the mat", "the cat sat on the hat", "été à la plage, été", "", None, "zzzz qqqq", "the cat sat on the mat", "x" * 300, LINE, LINE + " ends otherwise", "begins " + LINE + " " + LINE]


@pytest.mark.parametrize("model_bytes", [ppm.MODEL_BYTES, 400])
def test_scores_equal_a_dictionary_trie(spark, model_bytes):
    docs = spark.createDataFrame([(i, t, "other") for i, t in enumerate(TEXTS)], "doc_id long, text string, bits string")
    folds = {r.doc_id: r.fold for r in ppm._folded(docs).collect()}
    assert set(folds.values()) == {0, 1}
    got = {r.doc_id: r for r in ppm.score(docs, model_bytes).collect()}
    for doc_id, n, bits in brute([(i, t, folds[i]) for i, t in enumerate(TEXTS)]):
        assert got[doc_id].n_bytes == n
        assert math.isclose(got[doc_id].bits, bits, rel_tol=1e-9, abs_tol=1e-9)
        assert (got[doc_id].bits_per_byte is None) == (n == 0)


def test_empty_table_nulls_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert ppm.score(spark.createDataFrame([], schema)).count() == 0
    rows = ppm.score(spark.createDataFrame([(None, "ab"), (None, "ab")], schema)).collect()
    assert [(r.doc_id, r.bits) for r in rows] == [(None, 16.0)] * 2  # the other fold is empty
    rows = ppm.score(spark.createDataFrame([(i, "abcabc") for i in (1, 1, 2, 3)], schema), model_bytes=1).collect()
    assert len(rows) == 4


def test_documents_that_occur_twice_cost_next_to_nothing(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + rng.choice("xyz") for _ in range(120)) for _ in range(30)]
    docs = spark.createDataFrame([(i, texts[i % 30]) for i in range(36)], "doc_id long, text string")
    rate = {r.doc_id: r.bits_per_byte for r in ppm.score(docs).collect()}
    twice = {i for i in range(36) if i % 30 < 6}
    assert max(rate[i] for i in twice) < 0.5 * min(rate[i] for i in rate if i not in twice)


def test_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "word and others " * 60_000), (2, "zz " * 5)], "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.score(docs).collect()}
    assert got[1].n_bytes == 960_000 and got[1].bits_per_byte < got[2].bits_per_byte


def test_adaptive(spark):
    docs = spark.createDataFrame([(1, "aaaaaaaaaaaa"), (2, "qwertyuiop")], "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.score_adaptive(docs).collect()}
    assert got[1].bits_per_byte < got[2].bits_per_byte
    assert math.isclose(ppm.adaptive_bits(b"a"), 8.0)
