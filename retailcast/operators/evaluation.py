"""Regression evaluation (E-series) and the deterministic baseline model (M5).

All metrics are fused into one aggregation pass per grouping; the results
are one row per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.contract import LABEL


def baseline_fit(train: DataFrame, keys=("store_id", "day_of_week_index"),
                 label: str = LABEL) -> DataFrame:
    """M5: mean label per (store, weekday) over the training rows.
    One row per key; partial aggregation keeps hot stores cheap."""
    return train.groupBy(*keys).agg(F.avg(F.col(label).cast("double")).alias("_key_mean"))


def baseline_predict(df: DataFrame, split_col: str = "split_type", keys=("store_id", "day_of_week_index"),
                     label: str = LABEL, out: str = "prediction") -> DataFrame:
    """Fit on the train split and score every row: key mean, else the global train mean."""
    train = df.filter(F.col(split_col) == "train")
    table = baseline_fit(train, keys, label)
    global_mean = train.agg(F.avg(F.col(label).cast("double"))).scalar()
    # The key table grows with stores x 7; Catalyst/AQE picks broadcast only
    # under the size threshold, otherwise a shuffle join (skew-split by AQE).
    return (df.join(table, list(keys), "left")
            .withColumn(out, F.coalesce(F.col("_key_mean"), global_mean))
            .drop("_key_mean"))


def metric_columns(label: str = LABEL, prediction: str = "prediction") -> list[Column]:
    """E1–E3 as aggregate expressions (one pass) over rows that have a label and a prediction."""
    e = F.col(prediction).cast("double") - F.col(label).cast("double")
    y = F.when(e.isNotNull(), F.col(label).cast("double"))       # rows with a label and a prediction
    sse = F.sum(e * e)
    n = F.count(e)
    sst = F.var_pop(y) * n
    return [
        n.alias("n_rows"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
        F.when(sst > 0, F.lit(1.0) - sse / sst).alias("r2"),
    ]


def regression_metrics(scored: DataFrame, label: str = LABEL, prediction: str = "prediction",
                       by: list[str] | None = None) -> DataFrame:
    """Rmse, mae, r2 (and n) overall or per group (e.g. split_type)."""
    cols = metric_columns(label, prediction)
    return scored.groupBy(*by).agg(*cols) if by else scored.agg(*cols)


def fit_status(by_split: DataFrame, split_col: str = "split_type") -> DataFrame:
    """E5: generalization gap and fit verdict from per-split RMSE (one row)."""
    piv = by_split.agg(
        F.max(F.when(F.col(split_col) == "train", F.col("rmse"))).alias("train_rmse"),
        F.max(F.when(F.col(split_col) == "validation", F.col("rmse"))).alias("val_rmse"))
    gap = F.col("val_rmse") - F.col("train_rmse")
    ratio = F.col("val_rmse") / (F.col("train_rmse") + F.lit(1e-8))
    status = (F.when((ratio > 1.15) & (gap > 5), "overfit")
              .when(ratio < 1.02, "underfit").otherwise("good_fit"))
    return piv.select("train_rmse", "val_rmse", gap.alias("generalization_gap_rmse"),
                      ratio.alias("val_train_rmse_ratio"), status.alias("fit_status"))


def residual_histogram(scored: DataFrame, bins: int = 30, label: str = LABEL,
                       prediction: str = "prediction") -> DataFrame:
    """Equal-width bins of prediction − label over [min, max]; the max
    value falls in the last bin."""
    r = F.col(prediction).cast("double") - F.col(label).cast("double")
    with_r = scored.select(r.alias("residual"))
    stats = with_r.agg(F.min("residual").alias("lo"), F.max("residual").alias("hi"))
    lo, hi = stats.select("lo").scalar(), stats.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("residual") - lo) / width), F.lit(bins - 1))).cast("int")
    return (with_r.groupBy(idx.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (lo + F.col("bin") * width).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n"))


def pred_vs_actual(scored: DataFrame, bins: int = 20, label: str = LABEL,
                   prediction: str = "prediction") -> DataFrame:
    """2-D binned density of (actual, predicted) on a shared axis range."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    both = scored.select(y.alias("y"), p.alias("p"))
    rng = both.agg(F.least(F.min("y"), F.min("p")).alias("lo"), F.greatest(F.max("y"), F.max("p")).alias("hi"))
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))

    def b(c):
        return F.when(hi == lo, F.lit(0)).otherwise(
            F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1))).cast("int")
    return both.groupBy(b("y").alias("actual_bin"), b("p").alias("pred_bin")).agg(F.count(F.lit(1)).alias("n"))


def label_stats(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Mean and sample std of the label."""
    y = F.col(label).cast("double")
    return df.agg(F.avg(y).alias("label_mean"), F.stddev_samp(y).alias("label_std"))


def label_distribution(df: DataFrame, col: str = "high_demand") -> DataFrame:
    """n_pos, n_neg and overall positive rate of a 0/1 label."""
    v = F.col(col).cast("int")
    pos = F.count_if(v == 1)
    neg = F.count_if(v == 0)
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg"),
                  F.try_divide(pos.cast("double"), (pos + neg).cast("double")).alias("pos_rate_overall"))
