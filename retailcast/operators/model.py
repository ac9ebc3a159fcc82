"""Model training and batch inference as Spark jobs (M-series, E6).

Boosted trees: the second-order histogram booster of ``operators.boosting``. Rounds
are sequential; every pass of a round is distributed over the partitions.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailcast.contract import FEATURE_ORDER, GBT_PARAMS, LABEL
from retailcast.functions.columns import require_columns
from retailcast.operators import boosting
from retailcast.operators.boosting import Booster


def assemble_features(df: DataFrame, features=FEATURE_ORDER, handle_invalid: str = "keep",
                      out: str = "features") -> DataFrame:
    """M1: ordered numeric feature vector (missing input column -> error)."""
    require_columns(df, features)
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid=handle_invalid).transform(df)


def boosting_params(seed: int = 42, **overrides) -> dict:
    """M2: the training job's boosted-tree settings; unknown names and values out of range raise."""
    p = dict(GBT_PARAMS, seed=seed) | overrides
    unknown = set(p) - set(GBT_PARAMS) - {"seed"}
    if unknown or not (0 < p["subsample"] <= 1 and 0 < p["colsample_bytree"] <= 1 and p["max_depth"] >= 1 and p["reg_lambda"] >= 0 and p["min_child_weight"] >= 0):
        raise ValueError(f"boosted trees can't take {sorted(unknown) or p}")
    return p


def _id_col(df: DataFrame, id_col: str = "record_id") -> str | None:
    return id_col if id_col in df.columns else None


def train_gbt(train: DataFrame, rounds: int | None = None, seed: int = 42, features=FEATURE_ORDER,
              label: str = LABEL, start: Booster | None = None, **options) -> Booster:
    """M2: a fit of ``rounds`` rounds, or as many more from ``start``; ``options`` are parameters
    of the job or of ``boosting.fit`` (bins, equal_width, bits)."""
    require_columns(train, [*features, label])
    own = {k: options.pop(k) for k in ("bins", "equal_width", "bits") if k in options}
    p = boosting_params(seed, **options)
    return boosting.fit(train, features, label, p, rounds or p["n_estimators"], start=start, id_col=_id_col(train), **own)[0]


def _error_pass(model: Booster, label: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(model.trees)), 0
        for batch in batches:
            x, y = boosting._numbers(batch, model.features), batch.column(label).to_numpy(zero_copy_only=False)
            pred = np.full(len(y), model.base)
            for k, t in enumerate(model.trees):
                pred += t.predict(x)
                total[k] += ((pred - y) ** 2).sum()
            n += len(y)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total), pa.array(np.full(len(total), n))], ["round", "e", "n"])
    return run


def learning_curve(spark: SparkSession, model: Booster, train: DataFrame, val: DataFrame,
                   features=FEATURE_ORDER, label: str = LABEL) -> DataFrame:
    """Train / validation RMSE after each boosting round (one distributed
    pass per split; the result has one row per round)."""
    def curve(df: DataFrame, name: str) -> DataFrame:
        rows = df.filter(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label))
        sums = rows.mapInArrow(_error_pass(model, label), "round int, e double, n long").groupBy("round").agg(F.sum("e").alias("e"), F.sum("n").alias("n"))
        return sums.select("round", F.sqrt(F.col("e") / F.col("n")).alias(name))
    return curve(train, "train_rmse").join(curve(val, "val_rmse"), "round", "full")


def early_stopping(curve: DataFrame, patience: int = 20) -> DataFrame:
    """M3: best round = argmin validation RMSE among rounds before the stop;
    stop = first round that is `patience` rounds past the running best."""
    w = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    with_best = curve.withColumn("best_so_far", F.min_by("round", F.struct("val_rmse", "round")).over(w))
    stopped = with_best.filter(F.col("round") - F.col("best_so_far") >= patience)
    stop_round = stopped.agg(F.min("round")).scalar()
    kept = with_best.filter(F.col("round") <= F.coalesce(stop_round, F.lit(10 ** 9)))
    return kept.agg(F.min_by("round", F.struct("val_rmse", "round")).alias("best_iteration"),
                    F.min("val_rmse").alias("best_val_rmse"),
                    F.max("round").alias("last_round"),
                    stop_round.isNotNull().alias("stopped_early"))


def save_model(model: Booster, path: str) -> str:
    return boosting.save(model, SparkSession.active(), path)


def batch_score(model_path: str, df: DataFrame, features=FEATURE_ORDER, out: str = "prediction") -> DataFrame:
    """M6: load the stored model and score a table (input columns + prediction)."""
    require_columns(df, features)
    score = boosting.score if df.isStreaming else boosting.score_table
    return score(df.sparkSession, model_path, df, out)


def tree_table(spark: SparkSession, model_path: str) -> DataFrame:
    """Model inspection — one row per node of the stored model (tree 0 is the intercept)."""
    return boosting.nodes(spark, model_path)


def _feature_rows(values: Column, error: Column, keep: list[str]) -> list[Column]:
    """Columns of a parsed request row: position, the features as floats, and the error (NULL: valid)."""
    return [*keep, "pos", *[F.when(error.isNull(), F.get(values, F.lit(i))).cast("float").alias(c) for i, c in enumerate(FEATURE_ORDER)],
            error.alias("error")]


def parse_csv_requests(requests: DataFrame, col: str = "value") -> DataFrame:
    """M7: headerless CSV bodies of one or more lines -> one row per line that isn't
    blank: the request's other columns, ``pos``, the 18 features and ``error``.

    A field that isn't a number is NULL; a line of another width, and a body
    without a line, become a row with an error. No request is lost."""
    keep = [c for c in requests.columns if c != col]
    lines = F.filter(F.split(F.coalesce(F.col(col), F.lit("")), "\r?\n"), lambda x: F.trim(x) != "")
    rows = requests.select(*keep, F.posexplode_outer(lines).alias("pos", "line"))
    values = F.transform(F.split("line", ","), lambda x: F.trim(x).try_cast("double"))
    error = (F.when(F.col("line").isNull(), F.lit("empty_body"))
             .when(F.size(values) != len(FEATURE_ORDER), F.lit("wrong_width")))
    return rows.select(*_feature_rows(values, error, keep))


def parse_json_requests(requests: DataFrame, id_col: str = "request_id", body: str = "body") -> DataFrame:
    """M8: JSON bodies -> one row per instance: id, ``pos``, the 18 features and ``error``.

    The instances are the field ``instances`` of an object, whatever stands beside
    it, or the body itself: a list of objects, a list of lists or a flat list of
    numbers (one instance). What can't be read becomes a row with an error: not_json,
    no_instances, missing_features (an object without all features) or wrong_width."""
    text = F.coalesce(F.get_json_object(body, "$.instances"), F.col(body))
    valid = F.try_parse_json(F.col(body))
    is_dicts, is_lists, is_flat = text.rlike(r"^\s*\[\s*\{"), text.rlike(r"^\s*\[\s*\["), text.rlike(r"^\s*\[")
    dicts = F.from_json(text, "array<map<string,double>>")
    from_dicts = F.transform(dicts, lambda m: F.struct(
        F.array(*[F.try_element_at(m, F.lit(c)) for c in FEATURE_ORDER]).alias("x"),
        F.when(m.isNull() | ~F.forall(F.array(*map(F.lit, FEATURE_ORDER)), lambda c: F.map_contains_key(m, c)), "missing_features").alias("error")))
    row = lambda x: F.struct(x.alias("x"), F.when(x.isNull() | (F.size(x) != len(FEATURE_ORDER)), "wrong_width").alias("error"))
    from_lists = F.transform(F.from_json(text, "array<array<double>>"), row)
    from_flat = F.array(row(F.from_json(text, "array<double>")))
    found = F.when(is_dicts, from_dicts).when(is_lists, from_lists).when(is_flat, from_flat)
    none = F.coalesce(F.size(found), F.lit(0)) <= 0
    empty = F.array(F.struct(F.lit(None).cast("array<double>").alias("x"), F.when(valid.isNull(), "not_json").otherwise("no_instances").alias("error")))
    rows = requests.select(id_col, F.posexplode(F.when(valid.isNull() | none | text.rlike(r"^\s*\[\s*\]\s*$"), empty).otherwise(found)).alias("pos", "r"))
    return rows.select(*_feature_rows(F.col("r.x"), F.col("r.error"), [id_col]))


def quarantined_requests(parsed: DataFrame) -> DataFrame:
    """Request rows that can't be scored, with their reason."""
    return parsed.filter("error IS NOT NULL").drop(*FEATURE_ORDER)


def score_parsed(model_path: str, parsed: DataFrame) -> DataFrame:
    return batch_score(model_path, parsed.filter("error IS NULL").drop("error"))


def score_csv_requests(model_path: str, requests: DataFrame, col: str = "value") -> DataFrame:
    """M7: predictions of the valid lines; the others are in ``quarantined_requests``."""
    return score_parsed(model_path, parse_csv_requests(requests, col))


def score_json_requests(model_path: str, requests: DataFrame, id_col: str = "request_id",
                        body: str = "body") -> DataFrame:
    """M8: (request id, position) -> prediction of the valid instances; the others are in ``quarantined_requests``."""
    return score_parsed(model_path, parse_json_requests(requests, id_col, body))


def format_predictions(scored: DataFrame, id_col: str = "request_id", pos: str = "pos",
                       accept: str = "application/json") -> DataFrame:
    """M9: per request, predictions in instance order as a JSON document or CSV
    lines. Requests are bounded (their body was one payload), so the per-request
    list is bounded too."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos), F.col("prediction")))),
                          lambda s: s["prediction"])
    agg = scored.groupBy(id_col).agg(ordered.alias("p"))
    if accept == "application/json":
        return agg.select(id_col, F.to_json(F.struct(F.col("p").alias("predictions"))).alias("body"))
    return agg.select(id_col, F.array_join(F.transform("p", lambda v: v.cast("string")), "\n").alias("body"))


def hyperparameter_log(spark: SparkSession, run_id: str, params: dict, metrics: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M4: params as (run_id, key, value) rows and metrics long (run_id, key, step, value)."""
    rows = spark.createDataFrame([(run_id, k, json.dumps(v) if not isinstance(v, str) else v) for k, v in sorted(params.items())],
                                 "run_id string, key string, value string")
    num = [c for c, t in metrics.dtypes if t in ("double", "bigint", "int", "float")]
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in num)
    long = metrics.selectExpr(*[c for c in metrics.columns if c not in num],
                              f"stack({len(num)}, {stack}) as (key, value)")
    return rows, long.withColumn("run_id", F.lit(run_id)).withColumn("step", F.lit(0))


def fit_with_early_stopping(spark: SparkSession, train: DataFrame, val: DataFrame, rounds: int | None = None,
                            patience: int | None = None, seed: int = 42, **overrides) -> tuple[Booster, DataFrame]:
    """M2 + M3: boost until ``patience`` rounds past the best validation round or
    ``rounds`` (the job's 250) in all, and keep the trees up to the best round.

    Rounds are appended to one fit and never refitted: trees past the best round are cut off."""
    p = boosting_params(seed, **overrides)
    patience = p["early_stopping_rounds"] if patience is None else patience
    model, curve = boosting.fit(train, FEATURE_ORDER, LABEL, p, rounds or p["n_estimators"], val=val, patience=patience, id_col=_id_col(train))
    return model, spark.createDataFrame(curve, "round int, train_rmse double, val_rmse double")
