"""Quantiles, request codecs, versions, storage rules and nested JSON reports."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailcast import session as S
from retailcast.contract import FEATURE_ORDER
from retailcast.operators import evaluation as E
from retailcast.operators import model as M
from retailcast.operators import registry as G
from retailcast.operators.bias import cddpl
from retailcast.operators.quantile import exact_quantiles
from retailcast.sources import sinks as K


def _path(spark, name):
    import uuid
    return S.shared_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda x: x / 4)), min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, values):
    rows = [(i % 2, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.75, 1.0], by=["g"]).collect()}
    for g in (0, 1):
        own = [v for k, v in rows if k == g and v is not None]
        assert (g in got) == bool(own)
        if own:
            assert got[g][0] == len(own)
            np.testing.assert_allclose(got[g][1], np.quantile(own, [0.0, 0.1, 0.5, 0.75, 1.0]), atol=1e-9)


def test_no_value_map_in_the_library():
    import pathlib
    root = pathlib.Path(S.__file__).parent
    assert not [p for p in root.rglob("*.py") if "percentile(" in p.read_text()]


def test_json_request_forms(spark):
    row = {c: float(i) for i, c in enumerate(FEATURE_ORDER)}
    vec = list(row.values())
    bodies = {1: {"instances": [row, row]}, 2: {"x": 1, "instances": [vec]}, 3: [row], 4: [vec, vec], 5: vec,
              6: {"instances": [{k: v for k, v in row.items() if k != "year"}, row]}, 7: [vec[:-1]], 8: {"instances": []}, 9: 5}
    rows = [(k, json.dumps(v)) for k, v in bodies.items()] + [(10, "{\"instances\": ["), (11, None), (12, "")]
    out = M.parse_json_requests(spark.createDataFrame(rows, "request_id long, body string")).collect()
    got = {}
    for r in out:
        got.setdefault(r["request_id"], []).append((r["pos"], r["error"], None if r["error"] else [r[c] for c in FEATURE_ORDER]))
    ok = lambda n: [(i, None, vec) for i in range(n)]
    assert {k: sorted(v, key=lambda x: x[0]) for k, v in got.items()} == {
        1: ok(2), 2: ok(1), 3: ok(1), 4: ok(2), 5: ok(1), 6: [(0, "missing_features", None), (1, None, vec)],
        7: [(0, "wrong_width", None)], 8: [(0, "no_instances", None)], 9: [(0, "no_instances", None)],
        10: [(0, "not_json", None)], 11: [(0, "not_json", None)], 12: [(0, "not_json", None)]}


def test_csv_request_lines(spark):
    line = ",".join(str(float(i)) for i in range(18))
    rows = [(1, f"{line}\n{line}\n"), (2, line.replace("17.0", "x")), (3, "1,2"), (4, ""), (5, None)]
    out = M.parse_csv_requests(spark.createDataFrame(rows, "id long, value string")).collect()
    got = sorted((r["id"], r["pos"] or 0, r["error"] or "", r[FEATURE_ORDER[-1]]) for r in out)
    assert got == [(1, 0, "", 17.0), (1, 1, "", 17.0), (2, 0, "", None), (3, 0, "wrong_width", None), (4, 0, "empty_body", None), (5, 0, "empty_body", None)]


def test_unsupported_hyperparameters_raise():
    with pytest.raises(ValueError):
        M.boosting_params(reg_lambda=-1)
    with pytest.raises(ValueError):
        M.boosting_params(depth=3)


def test_versions_go_on_and_are_idempotent(spark):
    runs = spark.createDataFrame([("a", "2024-01-01", 1.0, 0.9), ("b", "2024-01-02", 99.0, 0.9), ("c", "2024-01-03", 1.0, 0.9)],
                                 "mlflow_run_id string, eval_timestamp_utc string, rmse double, r2 double")
    gated = G.metric_gate(runs)
    first = G.register_model_versions(gated.filter("mlflow_run_id = 'a'"))
    nxt = G.register_model_versions(gated, stored=first)
    assert [(r["mlflow_run_id"], r["model_version"]) for r in nxt.collect()] == [("c", 2)]


def test_empty_key_falls_through(spark):
    ev = json.dumps({"detail": {"ModelPackageArn": "", "ModelPackageName": "second", "ModelApprovalStatus": "PendingManualApproval"}})
    r = G.route_approval_event(spark.createDataFrame([(ev,)], "event_json string")).first()
    assert (r["model_package_arn"], r["action"]) == ("second", "notified_pending")


def test_r2_leaves_out_rows_without_label(spark):
    rows = [(1.0, 1.5), (2.0, 2.0), (4.0, 3.5), (None, 3.0), (None, 9.0)]
    r = E.regression_metrics(spark.createDataFrame(rows, "units_sold double, prediction double")).first()
    y, p = np.array([1, 2, 4.0]), np.array([1.5, 2, 3.5])
    assert r["n_rows"] == 3 and abs(r["r2"] - (1 - ((p - y) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-12


def test_cddpl_leaves_out_undefined_groups(spark):
    rows = [(1, 1, 1), (1, 0, 0), (1, 0, 1), (2, 1, 0), (2, 0, 0)]
    r = cddpl(spark.createDataFrame(rows, "g int, is_weekend int, pred_bin int"), "g").first()
    assert r["n_undefined"] == 1 and abs(r["CDDPL"] - (0.0 - 0.5)) < 1e-12


def test_json_safe_is_recursive(spark):
    df = spark.sql("select named_struct('a', double('NaN'), 'b', array(double('Infinity'), 1.0D)) as s, map('k', double('NaN')) as m")
    r = K.json_safe(df).first()
    assert r["s"]["a"] is None and r["s"]["b"] == [None, 1.0] and r["m"] == {"k": None}


def test_feature_table_append_is_idempotent(spark):
    from retailcast.functions.features import engineer
    from retailcast.sources.tables import retail_daily
    from tests.conftest import SF0001
    rows, path = engineer(retail_daily(spark, SF0001)).limit(50), _path(spark, "features")
    K.append_feature_table(rows, path)
    n = spark.read.parquet(path).count()
    K.append_feature_table(rows, path)
    assert spark.read.parquet(path).count() == n == 50


def test_session_rules(spark):
    S.check_session(spark)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(RuntimeError):
            S.check_session(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stored_table_follows_its_sources(spark):
    path = _path(spark, "source")
    spark.range(3).write.parquet(path)
    build = lambda: spark.read.parquet(path).withColumn("x", F.col("id") + 1)
    one = S.session_table(spark, ("t", path), build, (spark.read.parquet(path),))
    assert one.count() == 3
    spark.range(5).write.mode("overwrite").parquet(path)
    assert S.session_table(spark, ("t", path), build, (spark.read.parquet(path),)).count() == 5
    S.forget_tables(spark)
