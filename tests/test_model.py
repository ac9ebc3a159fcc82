import numpy as np
import pytest
from pyspark.sql import functions as F

from retailcast.operators import attribution as A
from retailcast.operators import model as M
from retailcast.plans.base import scored
from retailcast.session import shared_path
from tests.conftest import SF0001
from tests.shap_reference import tree_shap


@pytest.fixture(scope="module")
def model_path(spark):
    train = scored(spark, SF0001).filter("split_type = 'train'")
    m = M.train_gbt(train, rounds=5, max_depth=4)
    return M.save_model(m, shared_path(spark, "test-models/gbt5"))


def test_shap_additive_and_matches_spark(spark, model_path):
    rows = scored(spark, SF0001).filter("split_type = 'test'").drop("prediction").limit(40)
    sh = A.shap_values(spark, rows, model_path).toPandas()
    phi = sh[[c for c in sh.columns if c.startswith("shap_")]].to_numpy().sum(axis=1)
    np.testing.assert_allclose(sh["base_value"] + phi, sh["model_output"], rtol=1e-9, atol=1e-9)
    spark_pred = M.batch_score(model_path, rows).select("record_id", "prediction").toPandas()
    merged = sh.merge(spark_pred, on="record_id")
    np.testing.assert_allclose(merged["model_output"], merged["prediction"], rtol=1e-9, atol=1e-9)


def test_tree_table_and_codecs(spark, model_path):
    tt = M.tree_table(spark, model_path)
    assert tt.select("treeID").distinct().count() == 6           # the intercept and five trees
    t = scored(spark, SF0001).filter("split_type = 'test'").drop("prediction")
    from retailcast.contract import FEATURE_ORDER
    req = t.select("record_id", F.concat_ws(",", *[F.col(c).cast("float").cast("string")
                                                   for c in FEATURE_ORDER]).alias("value"))
    a = M.score_csv_requests(model_path, req).select("record_id", "prediction")
    b = M.batch_score(model_path, t).select("record_id", F.col("prediction").alias("p2"))
    j = a.join(b, "record_id").select(F.max(F.abs(F.col("prediction") - F.col("p2")))).first()[0]
    assert j < 1e-9


def test_json_requests_and_format(spark, model_path):
    from retailcast.contract import FEATURE_ORDER
    t = scored(spark, SF0001).filter("split_type = 'test'").drop("prediction").orderBy("record_id").limit(3)
    rows = t.select(*FEATURE_ORDER).collect()
    import json
    dicts = json.dumps({"instances": [r.asDict() for r in rows]})
    lists = json.dumps({"instances": [list(r) for r in rows]})
    bare = json.dumps([list(r) for r in rows])
    req = spark.createDataFrame([(1, dicts), (2, lists), (3, bare)], "request_id long, body string")
    out = M.score_json_requests(model_path, req)
    preds = {(r["request_id"], r["pos"]): r["prediction"] for r in out.collect()}
    assert len(preds) == 9
    for p in range(3):
        assert abs(preds[(1, p)] - preds[(2, p)]) < 1e-9 and abs(preds[(1, p)] - preds[(3, p)]) < 1e-9
    doc = {r["request_id"]: json.loads(r["body"]) for r in M.format_predictions(out).collect()}
    assert [round(x, 6) for x in doc[1]["predictions"]] == [round(preds[(1, p)], 6) for p in range(3)]


def test_early_stopping(spark):
    curve = spark.createDataFrame([(i, 1.0, v) for i, v in enumerate([5.0, 4.0, 3.0, 3.5] + [3.2] * 25)],
                                  "round int, train_rmse double, val_rmse double")
    r = M.early_stopping(curve, patience=20).first()
    assert (r["best_iteration"], r["best_val_rmse"], r["last_round"], r["stopped_early"]) == (2, 3.0, 22, True)


def test_vectorized_shap_equals_recursive(spark, model_path):
    trees = A.load_trees(spark, model_path)
    rows = scored(spark, SF0001).filter("split_type = 'test'").limit(25).toPandas()
    from retailcast.contract import FEATURE_ORDER
    X = rows[FEATURE_ORDER].to_numpy(dtype=float)
    for t in trees:
        vec = np.zeros((len(X), len(FEATURE_ORDER)))
        A.tree_shap_batch(X, t, vec)
        for r in range(len(X)):
            ref = np.zeros(len(FEATURE_ORDER))
            tree_shap(X[r], t, ref)
            np.testing.assert_allclose(vec[r], ref, rtol=1e-9, atol=1e-9)
        pred = A.predict_batch(X, t)
        assert pred.shape == (len(X),)
