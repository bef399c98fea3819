from collections import Counter

import numpy as np
import pytest

from lexmill.llm import flat_graph
from lexmill.llm.kernels import group_roots


def clustered(seed, n, groups, dim=24, noise=0.03):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for g in range(groups):
        size = int(rng.integers(2, 9))
        at = rng.choice(n, size, replace=False)
        x[at] = x[at[0]] + noise * rng.normal(size=(size, dim))
    return x.astype(np.float32)


def truth(x, ids=None):
    """{id: (class, links)} by brute force."""
    ids = list(range(len(x))) if ids is None else ids
    u = np.asarray(x, np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    root = group_roots(len(x), *np.nonzero(np.triu(near, 1)))
    least = {}
    for i, r in zip(ids, root.tolist()):
        least[r] = min(least.get(r, i), i)
    return {i: (least[r], int(n) - 1) for i, r, n in zip(ids, root.tolist(), near.sum(1))}


def got(spark, x, **sizes):
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = flat_graph.near_duplicates(vectors, 0.95, **sizes).collect()
    assert len({r.vec_id for r in rows}) == len(rows)
    return {r.vec_id: (r.class_id, r.n_links) for r in rows}


def missed(spark, x, **sizes):
    """How many links there are, and how many of them are not found; none may be found that is not there."""
    want, have = truth(x), got(spark, x, **sizes)
    assert want.keys() == have.keys()
    assert all(have[i][1] <= want[i][1] for i in want)
    return sum(n for _, n in want.values()), sum(want[i][1] - have[i][1] for i in want)


@pytest.mark.parametrize("seed, shard", [(1, 150), (2, 40)])
def test_recall_and_precision_against_brute_force(spark, seed, shard):
    x = clustered(seed, 900, 80)
    x[800:840] = x[0] + 0.02 * np.random.default_rng(seed).normal(size=(40, 24))  # a large group
    links, lost = missed(spark, x, shard_vectors=shard)
    assert links > 1500 and lost <= 0.05 * links


def test_copies_bad_rows_and_empty_tables(spark):
    schema = "label string, vec_id long, embedding array<float>, id int, v string, shard int"
    one, other = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [("", 5, one, 1, "", 0), ("", 3, one, 1, "", 0), ("", 9, one, 1, "", 0), ("", 3, one, 1, "", 0), ("", 4, other, 1, "", 0), ("", 6, [2.0, 0.0, 0.0], 1, "", 0)]
    rows += [("", None, one, 1, "", 0), ("", 7, None, 1, "", 0), ("", 8, [0.0, 0.0, 0.0], 1, "", 0), ("", 10, [1.0, None, 0.0], 1, "", 0), ("", 11, [1.0, 0.0], 1, "", 0), ("", 12, [float("nan"), 0.0, 1.0], 1, "", 0)]
    found = sorted((r.vec_id, r.class_id, r.n_links) for r in flat_graph.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert found == [(3, 3, 3), (4, 4, 0), (5, 3, 3), (6, 3, 3), (9, 3, 3), (11, 11, 0)]  # 11 is of another dimension
    assert flat_graph.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_an_id_with_two_vectors_loses_no_link(spark):
    a, b = [1.0, 0.0, 0.1], [0.0, 1.0, 0.1]
    rows = [(1, a), (1, b), (2, [0.01, 1.0, 0.1]), (3, [1.0, 0.01, 0.1])]
    found = sorted(map(tuple, flat_graph.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()))
    assert found == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def near_copies(seed, sizes, alone, dim=64, noise=0.02):
    """Groups of different near copies of a vector each, and other vectors, in any order."""
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(alone, dim)), *(rng.normal(size=dim) + noise * rng.normal(size=(s, dim)) for s in sizes)])
    return rng.permutation(x).astype(np.float32)


@pytest.mark.parametrize("sizes, alone", [([60] * 8, 200), ([60, 300, 2000], 100)])
def test_large_groups_of_different_near_copies_at_complete_overlap(spark, sizes, alone):
    x = near_copies(1, sizes, alone)
    links, lost = missed(spark, x)
    assert links >= sum(s * (s - 1) for s in sizes) and lost <= 0.01 * links
    classes = Counter(c for c, _ in got(spark, x).values())
    assert sorted(classes.values())[-len(sizes) :] == sorted(sizes)


def test_a_group_over_many_shards_is_found(spark):
    links, lost = missed(spark, near_copies(2, [900, 60], 100), shard_vectors=60)
    assert lost <= 0.05 * links


def test_large_shards_and_all_pairs_in_blocks_are_exact(spark, monkeypatch):
    x = near_copies(3, [70, 80], 60)
    monkeypatch.setattr(flat_graph, "MOST_VECTORS", 50)
    assert got(spark, x) == truth(x)
    monkeypatch.setattr(flat_graph, "EXACT_BLOCK", 50)
    assert got(spark, x, min_recall=1.1) == truth(x)
