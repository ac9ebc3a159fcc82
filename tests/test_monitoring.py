from pyspark.sql import functions as F

from retailcast.operators import monitoring as W
from retailcast.operators import registry as G


def test_quarantine_reasons(spark):
    df = spark.createDataFrame(
        [(1, 2.0, '{"k": 3}'), (2, 2.0, None), (3, 2.0, "not json"), (4, None, '{"k": 1}'), (5, -1.0, '{"k": 1}'),
         (6, 1.0, '{"j": 1}')], "event_id long, value double, props string")
    got = {r["event_id"]: r["status"] for r in W.quarantine(df).collect()}
    assert got == {1: "valid", 2: "missing_payload", 3: "malformed_payload", 4: "missing_value",
                   5: "negative_value", 6: "malformed_payload"}


def test_psi_zero_for_same_distribution_and_positive_for_shift(spark):
    base = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    same = W.psi(base, base, ["x"]).first()["psi"]
    shifted = W.psi(base, base.select((F.col("x") + 30).alias("x")), ["x"]).first()["psi"]
    assert abs(same) < 1e-12 and shifted > 0.2


def test_ks_and_mean_shift(spark):
    base = spark.range(100).select(F.col("id").cast("double").alias("x"))
    cur = spark.range(100).select((F.col("id") + 50).cast("double").alias("x"))
    assert abs(W.ks_drift(base, cur, ["x"]).first()["ks"] - 0.5) < 1e-12
    ms = W.mean_shift(base, cur, ["x"]).first()
    assert abs(ms["mean_shift"] - 50 / base.agg(F.stddev_samp("x")).first()[0]) < 1e-12


def test_apply_contract_defaults(spark):
    df = spark.createDataFrame([(1, "3.5", None)], "record_id long, a string, b double")
    r = W.apply_contract(df, ["a", "b", "c"], {"b": 7.0}).first()
    assert (r["a"], r["b"], r["c"], r["schema_version"]) == (3.5, 7.0, 0.0, "v1")


def test_rolling_window(spark):
    df = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 21)], "date string")
    assert W.rolling_window(df, 7).count() == 7


def test_route_approval(spark):
    ev = spark.createDataFrame([
        (1, '{"detail": {"ModelPackageArn": "a1", "ModelPackageGroupName": "g", "ModelApprovalStatus": "PendingManualApproval"}}'),
        (2, '{"detail": {"modelPackageName": "a2", "ModelPackageGroupName": "g", "ModelApprovalStatus": "Approved", "ModelPackageStatus": "Completed"}}'),
        (3, '{"detail": {"ModelPackageGroupName": "g", "ModelApprovalStatus": "Approved"}}'),
        (4, '{"detail": {"ModelPackageArn": "a4", "ModelPackageGroupName": "h", "ModelApprovalStatus": "Approved", "ModelPackageStatus": "Completed"}}'),
        (5, '{"detail": {"ModelPackageArn": "a5", "ModelPackageGroupName": "g", "ModelApprovalStatus": "Approved", "ModelPackageStatus": "InProgress"}}'),
    ], "event_id long, event_json string")
    got = {r["event_id"]: (r["action"], r["reason"]) for r in G.route_approval_event(ev, expected_group="g").collect()}
    assert got == {1: ("notified_pending", None), 2: ("deploy_started", None), 3: ("skip", "no_model_package_arn"),
                   4: ("skip", "wrong_group"), 5: ("skip", None)}


def test_gate_and_versions(spark):
    runs = spark.createDataFrame([("r1", "2024-01-31T00:00:00Z", 30.0, 0.6), ("r2", "2024-02-29T00:00:00Z", 50.0, 0.9),
                                  ("r3", "2024-03-31T00:00:00Z", 20.0, 0.7), ("r4", "2024-04-30T00:00:00Z", None, 0.9)],
                                 "mlflow_run_id string, eval_timestamp_utc string, rmse double, r2 double")
    gated = {r["mlflow_run_id"]: r["gate_passed"] for r in G.metric_gate(runs).collect()}
    assert gated == {"r1": True, "r2": False, "r3": True, "r4": False}
    v = {r["mlflow_run_id"]: r["model_version"] for r in G.register_model_versions(G.metric_gate(runs)).collect()}
    assert v == {"r1": 1, "r3": 2}
