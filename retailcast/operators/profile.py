"""Data profile, evaluation summary, run history.

Moments and extremes are computed WIDE, in one aggregation whose single row is
stacked into the long form; quantiles come from distributed ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.contract import FEATURE_ORDER, LABEL
from retailcast.operators.quantile import exact_quantiles

# ---- fixed values: statistics of a profile, in order ----
STATS = ["mean", "std", "min", "max", "p25", "p50", "p75"]
NUMERIC = ("int", "bigint", "smallint", "tinyint", "double", "float")


def _stat_exprs(c: str) -> list[Column]:
    x = F.col(c).cast("double")
    return [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]


def profile_columns(df: DataFrame, features=FEATURE_ORDER, label: str = LABEL) -> list[tuple[str, str]]:
    """(column, kind) for the label and the numeric features that exist."""
    types = dict(df.dtypes)
    out = [(label, "label")] if types.get(label) in NUMERIC else []
    out += [(c, "feature") for c in features if types.get(c) in NUMERIC]
    return out


def data_profile(df: DataFrame, features=FEATURE_ORDER, label: str = LABEL) -> DataFrame:
    """Long profile rows (feature_name, kind, n_rows, mean, std, min, max, p25, p50, p75)."""
    cols = profile_columns(df, features, label)
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[e for c, _ in cols for e in _stat_exprs(c)])
    structs = [F.struct(F.lit(c).alias("feature_name"), F.lit(k).alias("kind"),
                        F.col("n_rows"),
                        *[F.col(f"{c}__{s}").alias(s) for s in ("mean", "std", "min", "max")])
               for c, k in cols]
    quantiles = exact_quantiles(df, [c for c, _ in cols], [0.25, 0.5, 0.75]).select(
        F.col("feature").alias("feature_name"), *[F.col("q")[i].alias(f"p{p}") for i, p in enumerate((25, 50, 75))])
    return wide.select(F.inline(F.array(*structs))).join(quantiles, "feature_name", "left")


def profile_nested(df: DataFrame, generated_at_utc: str, features=FEATURE_ORDER,
                   label: str = LABEL) -> DataFrame:
    """Nested one-row profile: generated_at_utc, n_rows, label_<label> struct,
    features map<string, struct<7 stats>>."""
    long = data_profile(df, features, label)
    stats = F.struct(*[F.col(s) for s in STATS])
    return long.agg(
        F.lit(generated_at_utc).alias("generated_at_utc"),
        F.max("n_rows").alias("n_rows"),
        F.max(F.when(F.col("kind") == "label", stats)).alias(f"label_{label}"),
        F.map_from_entries(F.filter(F.collect_list(F.struct(F.col("feature_name"), stats)),
                                    lambda e: e["feature_name"] != label)).alias("features"))


def profile_long(nested: DataFrame, eval_timestamp_utc: str, run_id: str,
                 label: str = LABEL) -> DataFrame:
    """Nested profile -> 14-column long rows with run context."""
    ctx = [F.lit(eval_timestamp_utc).alias("eval_timestamp_utc"), F.lit(run_id).alias("mlflow_run_id"),
           F.substring(F.lit(eval_timestamp_utc), 1, 10).alias("eval_date"),
           F.col("generated_at_utc")]
    lab = nested.select(*ctx, F.lit(label).alias("feature_name"), F.lit("label").alias("kind"),
                        F.col("n_rows"), *[F.col(f"label_{label}.{s}").alias(s) for s in STATS])
    feats = (nested.select(*ctx, F.col("n_rows"), F.explode("features").alias("feature_name", "v"))
             .select(*[F.col(c) for c in ("eval_timestamp_utc", "mlflow_run_id", "eval_date", "generated_at_utc")],
                     "feature_name", F.lit("feature").alias("kind"), "n_rows",
                     *[F.col(f"v.{s}").alias(s) for s in STATS]))
    return lab.unionByName(feats)


# ------------------------------------------------------------------ runs

def monthly_runs(scored: DataFrame, split: str = "test", label: str = LABEL,
                 prediction: str = "prediction") -> DataFrame:
    """Backtest runs: one evaluation run per calendar month of the chosen split.
    run id, timestamp (month end, ISO Z) and the fused metric pass."""
    from retailcast.operators.evaluation import metric_columns
    s = scored.filter(F.col("split_type") == split) if split else scored
    month_end = F.last_day(F.to_date(F.max("date")))
    return (s.groupBy("year", "month")
            .agg(*metric_columns(label, prediction),
                 F.date_format(F.to_timestamp(month_end), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eval_timestamp_utc"))
            .select(F.format_string("run-%04d-%02d", "year", "month").alias("mlflow_run_id"),
                    "eval_timestamp_utc", "n_rows", "rmse", "mae", "r2"))


def metric_history(runs: DataFrame, window: int = 3, by: list[str] | None = None) -> DataFrame:
    """Per run, the previous RMSE, change and rolling mean over `window` runs.
    Ordered window over the run table (one row per run)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*(by or [])).orderBy("eval_timestamp_utc")
    return runs.select(
        *(by or []), "mlflow_run_id", "eval_timestamp_utc", "rmse", "r2",
        F.lag("rmse").over(w).alias("prev_rmse"),
        (F.col("rmse") - F.lag("rmse").over(w)).alias("rmse_change"),
        F.avg("rmse").over(w.rowsBetween(-(window - 1), 0)).alias("rmse_rolling_avg"))


def profile_history(scored: DataFrame, label: str = LABEL, split: str = "test") -> DataFrame:
    """Label quantiles per monthly run and their change against the
    previous run (grouped aggregate, then a window over the per-run table)."""
    from pyspark.sql import Window
    s = scored.filter(F.col("split_type") == split) if split else scored
    y = F.col(label).cast("double")
    per = (s.groupBy("year", "month").agg(F.avg(y).alias("label_mean"))
           .join(exact_quantiles(s, [label], [0.25, 0.5, 0.75], by=["year", "month"]).select("year", "month", "q"), ["year", "month"], "left"))
    w = Window.orderBy("year", "month")
    return per.select(
        F.format_string("run-%04d-%02d", "year", "month").alias("mlflow_run_id"), "label_mean",
        F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"),
        (F.col("q")[1] - F.lag(F.col("q")[1]).over(w)).alias("p50_change"),
        (F.col("label_mean") - F.lag("label_mean").over(w)).alias("mean_change"))


def quantile_history(df: DataFrame, columns: list[str], period: tuple = ("year", "month")) -> DataFrame:
    """Quartiles of columns per period and the change of the median against the previous one."""
    from pyspark.sql import Window
    per = exact_quantiles(df, columns, [0.25, 0.5, 0.75], by=list(period))
    w = Window.partitionBy("feature").orderBy(*period)              # one row per period and column
    q = F.col("q")
    return per.select(*period, "feature", "n", q[0].alias("p25"), q[1].alias("p50"), q[2].alias("p75"), (q[1] - F.lag(q[1]).over(w)).alias("p50_change"))


def latest_run(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Newest run (max eval timestamp) — `max_by`, a streaming aggregate."""
    keep = [c for c in runs.columns if c not in (by or [])]
    latest = F.max_by(F.struct(*keep), F.col("eval_timestamp_utc")).alias("r")
    agg = runs.groupBy(*by).agg(latest) if by else runs.agg(latest)
    return agg.select(*(by or []), "r.*")


def evaluation_summary(metrics: DataFrame, label_dist: DataFrame, profile: DataFrame,
                       bias: DataFrame, eval_timestamp_utc: str, run_id: str,
                       experiment: str, model_source: str, data_source: str) -> DataFrame:
    """One nested record per run from one-row frames (each is a scalar
    aggregate, so the combination is a product of single rows)."""
    m = metrics.select(F.struct("rmse", "mae", "r2").alias("metrics"), "n_rows")
    hd = label_dist.select(F.struct("n_pos", "n_neg", "pos_rate_overall").alias("high_demand"))
    pr = profile.select(F.struct(*profile.columns).alias("data_profile"))
    bi = bias.select(F.struct(*bias.columns).alias("bias_metrics"))
    one = m.select(
        F.lit(eval_timestamp_utc).alias("eval_timestamp_utc"), F.lit(run_id).alias("mlflow_run_id"),
        F.lit(experiment).alias("experiment_name"), F.lit(model_source).alias("model_source"),
        F.lit(data_source).alias("test_data_source"), F.col("n_rows").cast("bigint").alias("n_rows"),
        "metrics",
        hd.select(F.col("high_demand")).scalar().alias("high_demand"),
        pr.select(F.col("data_profile")).scalar().alias("data_profile"),
        bi.select(F.col("bias_metrics")).scalar().alias("bias_metrics"))
    return one


# ---- fixed values: bias fields of the flat summary, in order ----
FLAT_BIAS_FIELDS = [
    "threshold_units_sold", "group_a_value", "group_d_value",
    "group_a_n", "group_a_pos_rate_true", "group_a_pos_rate_pred", "group_a_recall",
    "group_a_precision", "group_a_accuracy",
    "group_d_n", "group_d_pos_rate_true", "group_d_pos_rate_pred", "group_d_recall",
    "group_d_precision", "group_d_accuracy",
    "DPL_labels", "DPPL_predicted", "RD_recall_diff", "AD_accuracy_diff",
]


def evaluation_summary_flat(summary: DataFrame, label: str = LABEL) -> DataFrame:
    """Fixed-schema wide row (NULL where a metric is undefined)."""
    def num(c):
        return F.col(c).cast("double")
    cols = [F.col(c) for c in ("eval_timestamp_utc", "mlflow_run_id", "experiment_name",
                                "model_source", "test_data_source", "n_rows")]
    cols += [num(f"metrics.{m}").alias(m) for m in ("rmse", "mae", "r2")]
    cols += [num(f"data_profile.label_{label}.{s}").alias(f"label_{label}_{s}") for s in STATS]
    cols += [num(f"high_demand.{k}").alias(f"high_demand_{k}") for k in ("n_pos", "n_neg", "pos_rate_overall")]
    cols += [F.when(~F.isnan(num(f"bias_metrics.{k}")), num(f"bias_metrics.{k}")).alias(f"bias_{k}")
             for k in FLAT_BIAS_FIELDS]
    return summary.select(*cols)


def registry_metrics(metrics: DataFrame, bias: DataFrame) -> DataFrame:
    """The model-registry metrics document as one JSON string."""
    def entry(c):
        return F.struct(c.cast("double").alias("value"), F.lit("NaN").alias("standard_deviation"))
    b = bias.select("DPL_labels", "DPPL_predicted", "AD_accuracy_diff")
    doc = metrics.select(F.struct(F.struct(
        entry(F.col("rmse")).alias("rmse"), entry(F.col("mae")).alias("mae"), entry(F.col("r2")).alias("r2"),
        entry(b.select("DPL_labels").scalar()).alias("dpl"),
        entry(b.select("DPPL_predicted").scalar()).alias("dppl"),
        entry(b.select("AD_accuracy_diff").scalar()).alias("ad")).alias("regression_metrics")).alias("doc"))
    return doc.select(F.to_json("doc", {"ignoreNullFields": "false"}).alias("registry_metrics_json"))
