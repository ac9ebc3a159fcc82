"""Flagship plan: retail view -> features -> hash split -> baseline model ->
per-split accuracy and weekday/weekend bias, all in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.functions.columns import safe_divide
from retailcast.operators.evaluation import metric_columns
from retailcast.operators.quantile import exact_quantiles


def scored_frame(spark: SparkSession, sf_dir: str, stores: int | None = None) -> DataFrame:
    """27 engineered columns + ``prediction`` from the store x weekday baseline.

    The retail view and the feature table are written once to the shared
    folder (lineitem is joined and aggregated once); every consumer reads the
    stored tables."""
    from retailcast.plans.base import scored
    return scored(spark, sf_dir, stores)


def flagship(spark: SparkSession, sf_dir: str, stores: int | None = None) -> DataFrame:
    scored = scored_frame(spark, sf_dir, stores)
    # Per-split threshold (min label among positives, else p75): one row per
    # split, so the join back is bounded by the three split names.
    thr = scored.groupBy("split_type").agg(
        F.min(F.when(F.col("high_demand") == 1, F.col("units_sold").cast("double"))).alias("threshold"))
    if not thr.filter("threshold IS NULL").isEmpty():
        p75 = exact_quantiles(scored, ["units_sold"], [0.75], by=["split_type"])
        thr = thr.join(p75, "split_type", "left").select("split_type", F.coalesce("threshold", F.col("q")[0]).alias("threshold"))
    binned = scored.join(F.broadcast(thr), "split_type").withColumn(
        "pred_bin", F.coalesce(F.col("prediction") >= F.col("threshold"), F.lit(False)).cast("int"))
    a, d = F.col("is_weekend") == 0, F.col("is_weekend") == 1
    y, p = F.col("high_demand") == 1, F.col("pred_bin") == 1

    def rate(num, den):
        return safe_divide(F.count_if(num), F.count_if(den))
    out = binned.groupBy("split_type").agg(
        *metric_columns(),
        F.max("threshold").alias("threshold_units_sold"),
        (rate(a & y, a) - rate(d & y, d)).alias("dpl_labels"),
        (rate(a & p, a) - rate(d & p, d)).alias("dppl_predicted"),
        (rate(a & (y == p), a) - rate(d & (y == p), d)).alias("ad_accuracy_diff"))
    return out
