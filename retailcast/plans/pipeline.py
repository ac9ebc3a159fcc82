"""The end-to-end job as a plain driver function: feature job -> quality
job -> training -> evaluation -> monitoring append -> gate -> registration.
Each step is a Spark job over stored tables; nothing data-sized is
collected. All outputs go under ``out_dir`` (a shared folder)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.contract import EXPERIMENT_NAME, GATE_R2_MIN, GATE_RMSE_MAX
from retailcast.functions.features import engineer
from retailcast.operators import attribution as A
from retailcast.operators import bias as B
from retailcast.operators import evaluation as E
from retailcast.operators import model as M
from retailcast.operators import profile as X
from retailcast.operators import quality as Q
from retailcast.operators import registry as G
from retailcast.session import check_session
from retailcast.sources import sinks as K
from retailcast.sources.tables import retail_daily


def run_pipeline(spark: SparkSession, sf_dir: str, out_dir: str, run_ts: str, run_id: str,
                 rounds: int | None = None, stores: int | None = None,
                 rmse_max: float = GATE_RMSE_MAX, r2_min: float = GATE_R2_MIN) -> dict[str, DataFrame]:
    check_session(spark)
    out = out_dir.rstrip("/")
    raw = retail_daily(spark, sf_dir, stores)

    # feature job: engineered rows, split, stored once (feature table + splits)
    K.append_feature_table(engineer(raw), f"{out}/feature_table")
    feats = spark.read.parquet(f"{out}/feature_table")
    K.write_splits(feats, f"{out}/splits")

    # quality job: metrics, checks, suggestions as TSV reports
    base = feats.select(*raw.columns)
    K.write_tsv_report(Q.run_analyzers(base, Q.default_analyzers()), f"{out}/quality/dataset-metrics")
    K.write_tsv_report(Q.check_results(base), f"{out}/quality/constraint-checks")
    K.write_tsv_report(Q.success_metrics(base), f"{out}/quality/success-metrics")
    K.write_tsv_report(Q.suggest_constraints(base), f"{out}/quality/constraint-suggestions")

    # training with early stopping; model stored
    splits = spark.read.parquet(f"{out}/splits")
    train, val = splits.filter("split_type = 'train'"), splits.filter("split_type = 'validation'")
    model, curve = M.fit_with_early_stopping(spark, train, val, rounds)
    model_path = M.save_model(model, f"{out}/model")
    curve.write.mode("overwrite").parquet(f"{out}/learning_curve")

    # evaluation on the test split
    test = M.batch_score(model_path, splits.filter("split_type = 'test'"))
    test.write.mode("overwrite").parquet(f"{out}/eval/test_predictions")
    test = spark.read.parquet(f"{out}/eval/test_predictions")
    metrics = E.regression_metrics(test)
    bias = B.posttraining_bias(test)
    summary = X.evaluation_summary(metrics, E.label_distribution(test), X.profile_nested(test, run_ts), bias,
                                   run_ts, run_id, EXPERIMENT_NAME, model_path, f"{out}/splits")
    flat = X.evaluation_summary_flat(summary)
    K.write_json_report(summary, f"{out}/eval/evaluation_summary_json")
    A.shap_values(spark, test, model_path).write.mode("overwrite").parquet(f"{out}/eval/shap_values")
    importance = A.shap_importance(spark.read.parquet(f"{out}/eval/shap_values"))

    # monitoring appends happen for passing and failing runs alike
    K.append_monitoring(flat, f"{out}/monitoring/evaluation_summary", run_ts, run_id)
    K.append_monitoring(X.profile_long(X.profile_nested(test, run_ts), run_ts, run_id), f"{out}/monitoring/data_profile", run_ts, run_id)
    K.append_monitoring(test, f"{out}/monitoring/test_predictions", run_ts, run_id)
    K.append_monitoring(importance, f"{out}/monitoring/shap_feature_importance", run_ts, run_id)

    # gate and registration
    run = metrics.select(F.lit(run_id).alias("mlflow_run_id"), F.lit(run_ts).alias("eval_timestamp_utc"),
                         "rmse", "r2")
    gated = G.metric_gate(run, rmse_max, r2_min)
    versions = G.register_model_versions(gated, stored=K.read_if_exists(spark, f"{out}/registry/versions"))
    # the new version is computed before the append: the table it reads is the one it is added to
    spark.createDataFrame(versions.collect(), versions.schema).write.mode("append").parquet(f"{out}/registry/versions")
    return {"summary": flat, "gate": gated, "versions": spark.read.parquet(f"{out}/registry/versions"), "curve": curve}
