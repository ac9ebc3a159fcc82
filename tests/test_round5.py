"""Long fits by tasks that keep their rows, batch scores in numpy, tabulated Shapley shares."""

import os
import threading

import numpy as np
from pyspark.sql import functions as F

from retailcast.operators import attribution as A
from retailcast.operators import boosting as O
from retailcast.operators import model as M
from retailcast.session import shared_path

P = {"max_depth": 4, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.7, "min_child_weight": 1, "reg_lambda": 1.0, "seed": 1}
NAMES = ["a", "b", "c", "d"]


def rows(spark, n, first=0):
    """Numbers with gaps, a flag and few labels by row number."""
    i = F.col("record_id")
    a, b, c = F.when(i % 11 > 0, i * 7919 % 97 / 3.0), F.when(i % 7 > 0, i * 31 % 5).cast("double"), (i % 2).cast("double")
    y = F.round(F.coalesce(a, F.lit(40.0)) * 2 + F.coalesce(b, F.lit(3.0)) ** 2 * (1 + c) + i * 13 % 29)
    return spark.range(first, first + n).withColumnRenamed("id", "record_id").select("record_id", a.alias("a"), b.alias("b"), c.alias("c"), F.lit(None).cast("double").alias("d"), y.alias("y"))


def test_long_fits_run_as_one_job_and_give_the_same_trees(spark, monkeypatch):
    train, val, stored = rows(spark, 3000), rows(spark, 900, 5000), []
    kept = O.materialize
    monkeypatch.setattr(O, "materialize", lambda df, name, **o: stored.append(name) or kept(df, name, **o))
    model, curve = O.fit(train, NAMES, "y", P, 17, val=val, patience=6, id_col="record_id")
    assert stored == ["binned"]                                   # rows are stored once, not after every few trees
    monkeypatch.setattr(O, "gang_size", lambda *_: 0)
    passes, same = O.fit(train, NAMES, "y", P, 17, val=val, patience=6, id_col="record_id")
    assert len(stored) > 2 and model.rows() == passes.rows()
    np.testing.assert_allclose(curve, same, rtol=1e-12)
    assert model.predict(np.array([[1.0, 1.0, 0.0, np.nan]])).tolist() == passes.predict(np.array([[1.0, 1.0, 0.0, np.nan]])).tolist()


def test_long_fit_continues_without_validation_rows(spark):
    df = rows(spark, 800)
    short, _ = O.fit(df, NAMES, "y", P, 7, id_col="record_id")
    more, curve = O.fit(df, NAMES, "y", P, 6, id_col="record_id", start=short)
    long, whole = O.fit(df, NAMES, "y", P, 13, val=df.limit(0), patience=2, id_col="record_id")
    assert more.rows() == long.rows() and [r for r, *_ in curve] == list(range(7, 13)) and all(v is None for *_, v in whole)


def test_bundled_features_fit_a_byte_and_give_back_their_sums():
    sizes = [66, 3, 3, 66, 8, 13, 12, 32, 256]
    groups = O.bundles(sizes)
    assert sorted(f for g in groups for f in g) == list(range(len(sizes))) and len(groups) < len(sizes)
    assert all(np.prod([sizes[f] for f in g]) <= 256 for g in groups)
    rng, n = np.random.default_rng(3), 500
    gang = O._Gang([list(range(s - 2)) for s in sizes], dict(P, subsample=1.0), 0, lambda t: t)
    bins = np.stack([np.where(rng.random(n) < 0.1, O.MISSING, rng.integers(0, s - 1, n)) for s in sizes]).astype(np.uint8)
    y = rng.integers(0, 50, n).astype(np.float64)
    gang.add(0, np.arange(n), y, bins, np.zeros(n))
    columns = np.arange(len(sizes)) != 4
    g, count, _ = gang._count(None, [0], columns, None, 0, True)
    for f, s in enumerate(sizes):
        at = np.minimum(bins[f].astype(int), 255 if s == 256 else gang.width - 1)
        want = np.bincount(np.where(bins[f] == O.MISSING, gang.width - 1, at), weights=-y, minlength=gang.width) * columns[f]
        assert np.array_equal(g[f, 0], want) and count[f].sum() == n * columns[f]


def test_tasks_add_up_through_a_folder(spark):
    folder, found = O.re.sub("^file:/+", "/", shared_path(spark, "test-board")), {}

    def task(me):
        board = O._Board(folder, me, 3)
        found[me] = [board.total((np.array([me, k]), [float(me)], 1)) for k in range(4)]
    threads = [threading.Thread(target=task, args=(i,)) for i in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for k in range(4):
        for me in range(3):
            a, b, n = found[me][k]
            assert a.tolist() == [3, 3 * k] and sorted(b) == [0.0, 1.0, 2.0] and n == 3
    assert len(os.listdir(folder)) == 1                           # the last total; what all have read is deleted


def test_batches_are_scored_by_table_with_the_same_numbers(spark):
    df = rows(spark, 600)
    model, _ = O.fit(df, NAMES, "y", P, 4, id_col="record_id")
    path = O.save(model, spark, shared_path(spark, "test-models/round5"))
    more = df.unionByName(df.limit(2).withColumn("a", F.lit(float("inf"))).withColumn("b", F.lit(float("-inf"))))
    found = M.batch_score(path, more, NAMES)
    assert found.columns == [*more.columns, "prediction"] and "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    got = found.toPandas()
    assert len(got) == 602 and np.array_equal(got["prediction"], model.predict(got[NAMES].to_numpy(dtype=float)))
    assert np.array_equal(got["prediction"], O.score(spark, path, more).toPandas()["prediction"])
    none = O.save(O.Booster(NAMES, dict(P), 3.5, []), spark, shared_path(spark, "test-models/round5-none"))
    assert [r["prediction"] for r in M.batch_score(none, df.limit(2), NAMES).collect()] == [3.5, 3.5]


def test_shapley_shares_are_worked_out_once_for_each_leaf(spark, monkeypatch):
    model, _ = O.fit(rows(spark, 600), NAMES, "y", P, 3, id_col="record_id")
    trees = A.load_trees(spark, O.save(model, spark, shared_path(spark, "test-models/round5-shap")))
    x = np.random.default_rng(2).uniform(0, 40, (500, 4))
    x[::5, 0] = np.nan
    seen, kept = [], A.path_shares
    monkeypatch.setattr(A, "path_shares", lambda zs, os_, value: seen.append(os_.shape) or kept(zs, os_, value))
    found, leaves = [np.zeros(x.shape) for _ in trees], sum(int((t["left"] < 0).sum()) for t in trees)
    for part in (slice(0, 200), slice(200, 500)):
        for t, phi in zip(trees, found, strict=True):
            A.tree_shap_batch(x[part], t, phi[part])
    assert all(n <= 2 ** (d - 1) for d, n in seen) and len(seen) <= leaves + 2 * len(trees)      # however many rows and batches
    monkeypatch.setattr(A, "TABLED", -1)
    for t, phi in zip(trees, found, strict=True):
        by_row = np.zeros(x.shape)
        A.tree_shap_batch(x, {k: v for k, v in t.items() if k != "shares"}, by_row)
        assert np.array_equal(phi, by_row)
