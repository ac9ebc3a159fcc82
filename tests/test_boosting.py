"""Second-order boosting: a hand-worked tree, plain loops, missing values, continuation, early stopping, stored scoring."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailcast.operators import boosting as O
from retailcast.operators import model as M
from retailcast.session import shared_path

P = {"max_depth": 2, "learning_rate": 0.5, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_weight": 1, "reg_lambda": 1.0, "seed": 1}


def table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "record_id long, a double, b double, y double").repartition(3)


def test_one_round_by_hand(spark):
    """y = 0, 0, 8, 8 at a = 1..4: base 4, gradients 4, 4, -4, -4. Cut at 2.5: GL = 8, HL = 2."""
    df = table(spark, [(1.0, 0.0, 0.0), (2.0, 0.0, 0.0), (3.0, 0.0, 8.0), (4.0, 0.0, 8.0)])
    model, _ = O.fit(df, ["a", "b"], "y", dict(P, max_depth=1), 1, id_col="record_id")
    t = model.trees[0]
    assert model.base == 4.0 and t.feature[0] == 0 and abs(t.threshold[0] - 2.5) < 1e-6 and t.gain[0] == 64 / 3 + 64 / 3 - 0
    assert t.value[1] == -0.5 * 8 / 3 and t.value[2] == 0.5 * 8 / 3 and list(t.cover[:3]) == [4, 2, 2]
    heavy, _ = O.fit(df, ["a", "b"], "y", dict(P, max_depth=1, reg_lambda=1000.0), 1, id_col="record_id")
    assert abs(heavy.trees[0].value[2]) < abs(t.value[2]) / 100
    none, _ = O.fit(df, ["a", "b"], "y", dict(P, min_child_weight=3), 1, id_col="record_id")
    assert (none.trees[0].feature == -1).all() and none.predict(np.array([[1.0, 0.0]]))[0] == 4.0


def plain_round(x, y, pred, depth, edges, p):
    """One tree by loops over rows and cuts: {node: (feature, threshold, missing left) or value}."""
    tree, members = {}, {0: list(range(len(y)))}
    for node in range(2 ** (depth + 1) - 1):
        if node not in members:
            continue
        own = members[node]
        g, h = sum(pred[i] - y[i] for i in own), len(own)
        best = None
        if node < 2**depth - 1:
            for f in range(len(edges)):
                for e in edges[f]:
                    for ml in (False, True):
                        left = [i for i in own if (ml if math.isnan(x[i][f]) else x[i][f] <= e)]
                        gl, hl = sum(pred[i] - y[i] for i in left), len(left)
                        if hl < 1 or h - hl < 1:
                            continue
                        gain = gl**2 / (hl + p["reg_lambda"]) + (g - gl)**2 / (h - hl + p["reg_lambda"]) - g**2 / (h + p["reg_lambda"])
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-7):
                            best = gain, f, e, ml, left
        if best:
            tree[node] = best[1:4]
            members[2 * node + 1], members[2 * node + 2] = best[4], [i for i in own if i not in best[4]]
        else:
            tree[node] = -p["learning_rate"] * g / (h + p["reg_lambda"])
    return tree


def test_histograms_of_many_tasks_are_added_by_spark(spark, monkeypatch):
    df = noisy(spark, 300, 9)
    model, _ = O.fit(df, ["a", "b"], "y", P, 3, id_col="record_id")
    monkeypatch.setattr(O, "DIRECT", 0)
    again, _ = O.fit(df, ["a", "b"], "y", P, 3, id_col="record_id")
    assert again.rows() == model.rows()


def test_rounds_equal_plain_loops(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(90):
        a, b = rng.choice([1.0, 2.0, 3.0, 5.0, 8.0, float("nan")]), rng.choice([0.0, 1.0, 4.0, None])
        rows.append((a, b, float((0 if math.isnan(a) else a * 3) + (7 if b is None else b * b) + rng.randrange(3))))
    df = table(spark, rows)
    model, curve = O.fit(df, ["a", "b"], "y", P, 3, id_col="record_id")
    x = [[a, float("nan") if b is None else b] for a, b, _ in rows]
    y = [r[2] for r in rows]
    edges = O.bin_edges(df, ["a", "b"], 64)
    assert [[round(e, 5) for e in x] for x in edges] == [[1.5, 2.5, 4.0, 6.5], [0.5, 2.5]]
    pred = [sum(y) / len(y)] * len(y)
    for t, (_, rmse, _) in zip(model.trees, curve, strict=True):
        want = plain_round(x, y, pred, 2, edges, P)
        for node, v in want.items():
            if isinstance(v, tuple):
                assert (t.feature[node], t.threshold[node]) == v[:2]
            else:
                assert t.feature[node] == -1 and abs(t.value[node] - v) < 1e-3
        pred = [p + d for p, d in zip(pred, t.predict(np.array(x)), strict=True)]
        assert abs(rmse - math.sqrt(sum((p - v) ** 2 for p, v in zip(pred, y, strict=True)) / len(y))) < 1e-9
    again, _ = O.fit(df.repartition(7), ["a", "b"], "y", P, 3, id_col="record_id")
    assert again.rows() == model.rows()                     # however the rows are dealt


def noisy(spark, n, seed):
    rng = random.Random(seed)
    rows = [(float(rng.randrange(50)), float(rng.randrange(10)), 0.0) for _ in range(n)]
    return table(spark, [(a, b, float(round(a * 2 + b * b / 3 + rng.gauss(0, 8)))) for a, b, _ in rows])


def test_continuation_appends_to_the_same_trees(spark):
    df, p = noisy(spark, 400, 1), dict(P, subsample=0.7, colsample_bytree=0.5)
    short, _ = O.fit(df, ["a", "b"], "y", p, 4, id_col="record_id")
    long, _ = O.fit(df, ["a", "b"], "y", p, 9, id_col="record_id")
    more, _ = O.fit(df, ["a", "b"], "y", p, 5, id_col="record_id", start=short)
    assert more.rows() == long.rows() and long.prefix(4).rows() == short.rows()
    assert len({tuple(t.cover[:1]) for t in long.trees}) > 1          # every tree has a row sample of its own


def test_early_stopping_keeps_the_best_prefix(spark):
    train, val = noisy(spark, 300, 2), noisy(spark, 200, 3)
    p = dict(P, learning_rate=0.6, max_depth=4)
    model, curve = O.fit(train, ["a", "b"], "y", p, 60, val=val, patience=3, id_col="record_id")
    full, whole = O.fit(train, ["a", "b"], "y", p, len(curve) + 5, val=val, id_col="record_id")
    best = min((v, r) for r, _, v in curve)[1]
    assert curve == whole[: len(curve)] and len(curve) - 1 - best == 3 and len(model.trees) == best + 1
    assert model.rows()[1:] == full.prefix(best + 1).rows()[1:]
    found = M.early_stopping(spark.createDataFrame(curve, "round int, train_rmse double, val_rmse double"), 3).first()
    assert found["best_iteration"] == best and found["stopped_early"]


def test_stored_scores_equal_the_model(spark):
    df = noisy(spark, 200, 4).withColumn("a", F.when(F.col("record_id") % 9 > 0, F.col("a")))
    model, _ = O.fit(df, ["a", "b"], "y", dict(P, max_depth=3), 6, id_col="record_id")
    path = O.save(model, spark, shared_path(spark, "test-models/boosted"))
    assert O.load(spark, path).rows() == model.rows()
    rows = O.score(spark, path, df).collect()
    x = np.array([[float("nan") if r["a"] is None else r["a"], r["b"]] for r in rows])
    np.testing.assert_array_equal([r["prediction"] for r in rows], model.predict(x))
    plan = O.score(spark, path, df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_rows_and_no_labels(spark):
    df = table(spark, [(1.0, 2.0, None)])
    model, curve = O.fit(df, ["a", "b"], "y", P, 3)
    assert model.predict(np.zeros((1, 2)))[0] == 0.0 and curve == []
    with pytest.raises(ValueError):
        M.boosting_params(subsample=0)
