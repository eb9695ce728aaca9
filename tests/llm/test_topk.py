"""Exact top-k search against all pairs, on vectors with ties and faults."""

import numpy as np
import pytest

from cartrail.llm import topk


def plain(rows, k):
    held = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            held.append((i, [int(np.floor(64 * x)) for x in v]))
    found = []
    for i, v in {(i, tuple(v)) for i, v in held if i % 20 == 0}:
        products = [(sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in held if j != i and len(w) == len(v)]
        scored = sorted((-max(-(2**63), min(2**63 - 1, s)), j) for s, j in products)
        found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_all_pairs(spark, shard_rows):
    pick = np.random.default_rng(1)
    rows = [(i, pick.normal(0, 0.2, 6).round(1).tolist()) for i in range(400)]
    rows += [(i, [0.5] * 6) for i in range(400, 460)]
    rows += [(460, None), (480, [0.1, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (520, [float("inf")] * 6), (None, [0.1] * 6)]
    rows += [(540, [0.3, 0.4]), (541, [0.1, 0.2]), (560, []), (561, []), (580, [1e6] * 6)]
    rows += [(20, rows[20][1]), (40, [0.9] * 6), (41, rows[41][1]), (-20, [0.2] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, shard string")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found = topk.top_k(df, 7, shard_rows=shard_rows, block_rows=5)
    assert sorted(map(tuple, found.collect())) == plain(rows, 7)
    assert topk.top_k(df.limit(0)).count() == 0


@pytest.mark.parametrize("shard_rows", [30, 10_000])
def test_huge_components_and_a_hot_id(spark, shard_rows):
    """A score beyond a long is the nearest one; an id on a third of all rows is dealt out like others."""
    pick = np.random.default_rng(3)
    rows = [(i, pick.normal(0, 0.3, 4).tolist()) for i in range(120)] + [(60, [0.5] * 4)] * 70
    rows += [(1000, [1e30, -1e30, 0.0, 1.0]), (1001, [1e308] * 4), (1002, [-1.7e308, 0.0, 0.0, 0.0]), (1020, [1e17, 0.3, -1e17, 0.1]), (1040, [0.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = [(i, [min(max(x * 64, -1.7976931348623157e308), 1.7976931348623157e308) / 1 for x in v]) for i, v in rows]
    found = topk.top_k(df, 5, shard_rows=shard_rows, block_rows=5)
    held = [(i, [int(np.floor(x)) if abs(x) < 2**53 else int(x) for x in v]) for i, v in asked]
    expected = []
    for i, v in sorted({(i, tuple(v)) for i, v in held if i % 20 == 0}):
        products = [(sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in held if j != i]
        scored = sorted((-max(-(2**63), min(2**63 - 1, s)), j) for s, j in products)
        expected += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_the_least_score_is_the_last():
    """Scores that are cut to the least long come behind all others, in a node's bound and in a row's score."""
    sides = [-(10**30)] * 6 + [10**30] * 3 + [5] * 3
    vectors = np.array([[v, 1] for v in sides], dtype=object)
    tree = topk.KDTree(vectors, 2)
    query = np.array([1, 0], dtype=object)
    bounds = tree.bounds(query[None, :])[0]
    for k, expected in ((2, [6, 7]), (5, [6, 7, 8, 9, 10]), (8, [6, 7, 8, 9, 10, 11, 0, 1])):
        scores, found = topk.search(tree, np.arange(12), query, -1, bounds, k, topk.NO_FLOOR)
        assert found.tolist() == expected
        assert scores.tolist() == [max(-(2**63), min(2**63 - 1, sides[i])) for i in expected]


def test_tree_boxes_are_tight_and_search_is_exact():
    pick = np.random.default_rng(2)
    vectors = np.floor(pick.normal(0, 20, (3000, 8)))
    tree = topk.KDTree(vectors, 50)
    leaves = [r for r in tree.rows if r is not None]
    assert sorted(np.concatenate(leaves)) == list(range(3000)) and max(map(len, leaves)) <= 50
    for node, rows in enumerate(tree.rows):
        if rows is not None:
            assert (vectors[rows].min(axis=0) == tree.low[node]).all() and (vectors[rows].max(axis=0) == tree.high[node]).all()
    ids = np.arange(3000)
    asked = vectors[:40]
    bounds = tree.bounds(asked)
    for i, query in enumerate(asked):
        scores, found = topk.search(tree, ids, query, i, bounds[i], 10, -np.inf)
        every = vectors @ query
        best = [j for j in np.lexsort((ids, -every)) if j != i][:10]
        assert found.tolist() == best and scores.tolist() == every[best].tolist()
        # a k-th score from elsewhere keeps ties and drops the rest
        floor = float(every[best[4]])
        scores, found = topk.search(tree, ids, query, i, bounds[i], 10, floor)
        assert found.tolist() == [j for j in best if every[j] >= floor]
