"""Golden values from the reference's published reports (transcribed)."""

import math

import pytest
from pyspark.sql import functions as F

from retailcast.operators import bias as B
from retailcast.operators import evaluation as E
from retailcast.operators import profile as X

# ---- fixed values: the 25 published scored test rows
# (units_sold, prediction, is_weekend, high_demand) ----
SCORED_25 = [
    (66, 80.28925, 0, 0), (97, 92.332825, 0, 0), (113, 124.36449, 1, 0), (93, 83.60985, 0, 0),
    (87, 77.35963, 0, 0), (97, 105.57706, 0, 0), (157, 133.64217, 1, 1), (167, 161.4434, 1, 1),
    (270, 174.3986, 1, 1), (110, 106.16672, 0, 0), (160, 135.86954, 1, 1), (103, 101.92528, 0, 0),
    (104, 93.639915, 0, 0), (136, 138.17879, 1, 1), (113, 106.278336, 1, 0), (99, 91.34808, 0, 0),
    (108, 98.534485, 0, 0), (102, 101.81024, 0, 0), (82, 83.41884, 0, 0), (89, 89.15958, 0, 0),
    (107, 105.259926, 0, 0), (130, 120.44263, 0, 0), (93, 113.55879, 1, 0), (78, 79.05545, 0, 0),
    (125, 123.023224, 0, 0),
]


@pytest.fixture(scope="module")
def scored25(spark):
    rows = [(i, u, p, w, h) for i, (u, p, w, h) in enumerate(SCORED_25)]
    return spark.createDataFrame(rows, "record_id long, units_sold long, prediction double, "
                                       "is_weekend int, high_demand int")


def rel(a, b, tol=1e-6):
    return abs(a - b) <= tol * max(1.0, abs(b))


def test_regression_metrics(scored25):
    m = E.regression_metrics(scored25).first()
    assert m["n_rows"] == 25
    assert rel(m["rmse"], 21.68276)
    assert rel(m["mae"], 11.38070)
    assert rel(m["r2"], 0.706529)


def test_label_profile(scored25):
    p = {r["feature_name"]: r for r in X.data_profile(scored25, features=[]).collect()}
    lab = p["units_sold"]
    assert rel(lab["mean"], 115.44) and rel(lab["std"], 40.8504182)
    assert (lab["min"], lab["max"], lab["p25"], lab["p50"], lab["p75"]) == (66, 270, 93, 104, 125)


def test_label_distribution(scored25):
    d = E.label_distribution(scored25).first()
    assert (d["n_pos"], d["n_neg"], d["pos_rate_overall"]) == (5, 20, 0.2)


def test_posttraining_record(scored25):
    r = B.posttraining_bias(scored25).first().asDict()
    assert r["threshold_units_sold"] == 136.0
    assert (r["group_a_value"], r["group_d_value"]) == (0.0, 1.0)
    assert (r["group_a_n"], r["group_d_n"]) == (17, 8)
    assert r["group_a_pos_rate_true"] == 0.0 and r["group_a_accuracy"] == 1.0
    assert r["group_a_recall"] is None and r["group_a_precision"] is None
    assert (r["group_d_pos_rate_true"], r["group_d_pos_rate_pred"]) == (0.625, 0.375)
    assert (r["group_d_recall"], r["group_d_precision"], r["group_d_accuracy"]) == (0.6, 1.0, 0.75)
    assert (r["DPL_labels"], r["DPPL_predicted"], r["AD_accuracy_diff"]) == (-0.625, -0.375, 0.25)
    assert r["RD_recall_diff"] is None


def test_confusion(scored25):
    b = B.with_predicted_label(scored25)
    c = {r["facet_value"]: (r["tp"], r["fp"], r["tn"], r["fn"]) for r in B.confusion_by_facet(b).collect()}
    assert c == {0: (0, 0, 17, 0), 1: (3, 0, 3, 2)}


def test_bias_long_skips_undefined(scored25):
    keys = {r["key"] for r in B.bias_long(B.posttraining_bias(scored25)).collect()}
    assert "bias_RD_recall_diff" not in keys and "bias_DPL_labels" in keys
    assert len(keys) == 16


def test_pretraining_golden(spark):
    # counts recovered from the published report: a = 360 rows (251 positive), d = 140 (123 positive)
    rows = [(0, 1)] * 251 + [(0, 0)] * 109 + [(1, 1)] * 123 + [(1, 0)] * 17
    df = spark.createDataFrame(rows, "is_weekend int, high_demand int")
    r = B.pretraining_bias(df).first()
    assert rel(r["ci"], 0.44, 1e-12)
    assert rel(r["dpl"], -0.18134920634920637, 1e-12)
    assert rel(r["js"], 0.025249292282339603, 1e-10)
    assert rel(r["kl"], 0.11544694444928766, 1e-10)
    assert rel(r["ks"], 0.18134920634920637, 1e-12)
    assert rel(r["lp"], 0.25646650714464464, 1e-12)
    assert rel(r["tvd"], 0.18134920634920634, 1e-12)
    long = B.pretraining_report(df).collect()
    assert [x["name"] for x in long] == ["CI", "DPL", "JS", "KL", "KS", "LP", "TVD"]


def test_registry_metrics_doc(scored25):
    import json
    doc = json.loads(X.registry_metrics(E.regression_metrics(scored25), B.posttraining_bias(scored25))
                     .first()[0])["regression_metrics"]
    assert set(doc) == {"rmse", "mae", "r2", "dpl", "dppl", "ad"}
    assert rel(doc["rmse"]["value"], 21.68276) and doc["rmse"]["standard_deviation"] == "NaN"
    assert doc["dpl"]["value"] == -0.625


def test_fit_status(spark):
    df = spark.createDataFrame([("train", 10.0), ("validation", 20.0)], "split_type string, rmse double")
    assert E.fit_status(df).first()["fit_status"] == "overfit"
    df = spark.createDataFrame([("train", 10.0), ("validation", 10.1)], "split_type string, rmse double")
    assert E.fit_status(df).first()["fit_status"] == "underfit"
    df = spark.createDataFrame([("train", 10.0), ("validation", 11.0)], "split_type string, rmse double")
    assert E.fit_status(df).first()["fit_status"] == "good_fit"
    assert not math.isnan(E.fit_status(df).first()["val_train_rmse_ratio"])


def test_one_facet_group(spark):
    df = spark.createDataFrame([(1, 100, 90.0, 0, 1), (2, 50, 40.0, 0, 0)],
                               "record_id long, units_sold long, prediction double, is_weekend int, high_demand int")
    r = B.posttraining_bias(df).first()
    assert r["group_d_value"] is None and r["threshold_units_sold"] == 100.0
