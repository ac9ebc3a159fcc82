"""The exact neighbour join against brute force, and a hand-worked flip test."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailcast.contract import FEATURE_ORDER
from retailcast.operators import bias as B
from retailcast.operators import knn
from retailcast.plans.base import spread
from tests.conftest import SF0001

SCHEMA = "record_id long, x array<double>"


def brute(queries, candidates, k):
    out = []
    for q, x in queries:
        best = sorted((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), c) for c, y in candidates)[:k]
        out += [(q, r + 1, c, d) for r, (d, c) in enumerate(best)]
    return sorted(out)


def joined(spark, queries, candidates, k):
    found, work = knn.knn_join(spark.createDataFrame(queries, SCHEMA).repartition(3), spark.createDataFrame(candidates, SCHEMA).repartition(4), k)
    return sorted(map(tuple, found.select("query_id", "rank", "candidate_id", "distance2").collect())), work


@pytest.mark.parametrize("k", [1, 4, 700])
def test_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(knn, "CHUNK", 37)
    monkeypatch.setattr(knn, "BLOCK", 23)
    monkeypatch.setattr(knn, "STEP", 16)
    rng = random.Random(k)
    centres = [[rng.randrange(1000) for _ in range(5)] for _ in range(6)]
    near = lambda: [float(v + rng.randrange(-30, 30)) for v in rng.choice(centres)]
    candidates = [(i, near()) for i in range(300)]
    candidates += [(1000 + i, candidates[0][1]) for i in range(150)]            # a third of the rows are one point
    queries = [(i, near()) for i in range(120)] + [(500 + i, candidates[0][1]) for i in range(60)] + [(900, [5000.0] * 5)]
    found, work = joined(spark, queries, candidates, k)
    assert found == brute(queries, candidates, k)
    if k == 4:
        assert work["pairs"] < work["all_pairs"] / 2


def plane(seed, n, first=0):
    rng = random.Random(seed)
    return [(first + i, [float(rng.randrange(1000)), float(rng.randrange(1000))]) for i in range(n)]


def test_pairs_of_a_query_stay_the_same_over_more_candidates(spark, monkeypatch):
    monkeypatch.setattr(knn, "CHUNK", 64)
    queries = plane(1, 60)
    few, many = (joined(spark, queries, plane(2, n), 3)[1] for n in (1_000, 16_000))
    assert many["pairs"] < 2 * few["pairs"]


def test_ties_under_a_leaf_of_equal_points(spark):
    same = [(1000 - i, [3.0, 4.0]) for i in range(300)] + plane(3, 200, 2000)
    queries = [(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [900.0, 900.0])]
    assert joined(spark, queries, same, 4)[0] == brute(queries, same, 4)


def test_partitions_grow_with_the_shipped_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "ROWS", 20, raising=False)
    rows = spark.createDataFrame(plane(4, 2_000), SCHEMA)
    found, _ = knn.knn_join(rows.filter("record_id < 500"), rows, 3)
    parts = {int(n) for n in re.findall(r"hashpartitioning\(cell#\d+, chunk#\d+, block#\d+, (\d+)\)", found._jdf.queryExecution().toString())}
    assert parts and min(parts) >= 2_000 // 20 // 2


def test_few_rows_and_none(spark):
    one = [(1, [1.0, 2.0])]
    assert joined(spark, one, [(7, [1.0, 2.0]), (3, [1.0, 2.0])], 5)[0] == [(1, 1, 3, 0.0), (1, 2, 7, 0.0)]
    empty = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(one, SCHEMA)
    assert knn.knn_join(some, empty, 3)[0].count() == knn.knn_join(empty, some, 3)[0].count() == 0


def test_neighbours_of_the_retail_rows(spark):
    rows = knn.scaled_features(B.with_predicted_label(spread(spark, SF0001)), FEATURE_ORDER[2:], "record_id")
    local = [(r["record_id"], r["is_weekend"], r["x"]) for r in rows.collect()]
    found, work = knn.knn_join(rows.filter("is_weekend = 1"), rows.filter("is_weekend <> 1"), 5)
    want = brute([(i, x) for i, w, x in local if w == 1], [(i, x) for i, w, x in local if w != 1], 5)
    assert sorted(map(tuple, found.collect())) == want and work["all_pairs"] > work["pairs"]


def test_flip_test_by_hand(spark):
    """Two d-rows predicted 0 beside a-rows predicted 1, one predicted 1 beside 0s, one like its neighbours."""
    rows = [(1, 1, 0, 0.0), (2, 1, 0, 1.0), (3, 1, 1, 100.0), (4, 1, 1, 2.0)]
    rows += [(10 + i, 0, 1, float(i)) for i in range(3)] + [(20 + i, 0, 0, 100.0 + i) for i in range(3)]
    rows += [(90, None, 1, 0.0), (91, 1, None, 0.0), (None, 0, 0, 0.0)]
    df = spark.createDataFrame(rows, "record_id long, is_weekend int, pred_bin int, v double")
    assert tuple(B.flip_test(df, ["v", "is_weekend"], k=3).first()) == (4, 2, 1, 0.25)
    none = B.flip_test(df.filter("is_weekend = 1"), ["v"], k=3).first()
    assert none["n_d"] == 0 and none["FT"] is None


def test_scaling(spark):
    df = spark.createDataFrame([(1, 2.0, 5, None), (2, 4.0, 5, 1.0), (3, 3.0, 5, 3.0)], "record_id long, a double, b int, c double")
    got = {r["record_id"]: r["x"] for r in knn.scaled_features(df, ["a", "b", "c"], "record_id", 10).select("record_id", "x").orderBy(F.col("record_id")).collect()}
    assert got == {1: [0.0, 0.0, 0.0], 2: [10.0, 0.0, 0.0], 3: [5.0, 0.0, 10.0]}


def test_tree_of_few_values():
    """Cuts between distinct values: every point lies in one leaf and its box, no leaf is empty."""
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 2, 500) * 1000.0, (rng.random(500) < 0.01) * 1000.0, rng.integers(0, 30, 500) * 1.0], axis=1)
    tree = knn.Tree(x, 10)
    own = tree.place(x)
    assert sorted(np.concatenate(tree.rows)) == list(range(500)) and all((own[r] == i).all() and len(r) for i, r in enumerate(tree.rows))
    assert all(len(r) <= 10 or (x[r] == x[r[0]]).all() for r in tree.rows)
