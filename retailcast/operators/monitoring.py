"""Production monitoring in batch form (W-series): event-time windows,
anomaly scores, alerts, quarantine, contracts, delayed labels, drift,
bias drift, rolling windows, retrain triggers and prediction sanity.

Streaming versions of the windowed operators live in
`retailcast.streaming`; both share the column expressions defined here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailcast.operators.quantile import exact_quantiles
from retailcast.contract import FEATURE_ORDER, LABEL

TS_FMT = "yyyy-MM-dd HH:mm:ss"


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time for batch windows. Zone-less (TIMESTAMP_NTZ) driver columns
    are used as they are, so windows follow wall-clock time whatever the
    session time zone; only string columns are parsed."""
    t = dict(df.dtypes)[ts]
    return df if t in ("timestamp_ntz", "timestamp") else df.withColumn(ts, F.to_timestamp(ts))


def window_avg(events: DataFrame, size: str = "1 hour", key: str = "event_type",
               value: str = "value", ts: str = "ts") -> DataFrame:
    """W2 (batch): tumbling event-time window average per key."""
    w = F.window(F.col(ts), size)
    return (event_time(events, ts).groupBy(w.alias("w"), F.col(key))
            .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"))
            .select(F.date_format("w.start", TS_FMT).alias("window_start"),
                    F.date_format("w.end", TS_FMT).alias("window_end"), key, "avg_value", "n"))


def anomaly_score(events: DataFrame, key: str = "event_type", value: str = "value",
                  ts: str = "ts", bucket: str = "1 hour") -> DataFrame:
    """W3 (batch): z-score of each value against the previous time bucket of
    the same key: (v − mean_prev) / std_prev. Bucket statistics are a grouped
    aggregate (keys x buckets rows), joined back on (key, bucket) — a hot key
    is spread over its buckets instead of one ordered window partition."""
    e = event_time(events, ts).withColumn("_b", F.window(ts, bucket)["start"])
    stats = (e.groupBy(key, "_b").agg(F.avg(value).alias("mean_prev"), F.stddev_samp(value).alias("std_prev"))
             .withColumn("_b", F.col("_b") + F.expr(f"INTERVAL {bucket}")))
    z = F.try_divide(F.col(value) - F.col("mean_prev"), F.col("std_prev"))
    return (e.join(stats, [key, "_b"], "left")
            .select("event_id", key, value, F.round("mean_prev", 9).alias("mean_prev"),
                    z.alias("anomaly_score")))


STATE_COLS = ["n0", "s1_0", "s2_0", "c"]


def running_zscore(df: DataFrame, prior: DataFrame | None = None, key: str = "event_type",
                   order: tuple = ("ts", "event_id"), value: str = "value", expire: str | None = None) -> tuple[DataFrame, DataFrame]:
    """W3 (cumulative form): z-score of each value against ALL earlier values of
    its key — prior state plus earlier rows of this input — and the new state.

    State per key: count, sum and sum of squares of (value − c), c a per-key
    centring constant fixed when the key is first seen, and the newest event time
    ``seen``. Earlier-row sums come from the exact distributed prefix sum, so a key
    holding a third of all rows is spread over range partitions instead of one task.
    A row without a value has no score and doesn't change the state. With ``expire`` (an
    interval) the new state leaves out keys last seen that long before the newest event:
    such a key begins anew."""
    from retailcast.operators.split import grouped_prefix_sum
    first = df.groupBy(key).agg(F.avg(value).alias("c_new"), F.max(order[0]).alias("seen_new"))
    if prior is None:
        st = first.select(key, F.lit(0).cast("bigint").alias("n0"), F.lit(0.0).alias("s1_0"),
                          F.lit(0.0).alias("s2_0"), F.col("c_new").alias("c"), F.col("seen_new").alias("seen"))
    else:
        st = (first.join(prior, first[key].eqNullSafe(prior[key]), "full")
              .select(F.coalesce(first[key], prior[key]).alias(key), F.coalesce("n0", F.lit(0)).cast("bigint").alias("n0"),
                      F.coalesce("s1_0", F.lit(0.0)).alias("s1_0"), F.coalesce("s2_0", F.lit(0.0)).alias("s2_0"),
                      F.coalesce("c", "c_new").alias("c"), F.greatest("seen", "seen_new").alias("seen")))
    y = (F.col(value) - F.col("c"))
    keep = list(dict.fromkeys(["event_id", *order, key, value]))
    valued = df.filter(F.col(value).isNotNull()).select(*keep)
    state = st.withColumnRenamed(key, "_key")
    rows = (valued.join(state, F.col(key).eqNullSafe(F.col("_key")))
            .select(*keep, *STATE_COLS, F.lit(1).cast("bigint").alias("one"), y.alias("y"), (y * y).alias("y2")))
    cum = grouped_prefix_sum(rows, key, list(order), ["one", "y", "y2"])
    n = F.col("n0") + F.col("cum_one") - 1
    s1 = F.col("s1_0") + F.col("cum_y") - F.col("y")
    s2 = F.col("s2_0") + F.col("cum_y2") - F.col("y2")
    var = (s2 - s1 * s1 / n) / (n - 1)
    z = F.when((n >= 2) & (var > 0), (F.col("y") - s1 / n) / F.sqrt(var))
    scored = cum.select("event_id", key, value, z.alias("anomaly_score")).unionByName(
        df.filter(F.col(value).isNull()).select("event_id", key, value, F.lit(None).cast("double").alias("anomaly_score")))
    batch = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("bn"), F.sum("y").alias("bs1"), F.sum("y2").alias("bs2"))
    new_state = (st.join(batch, F.col(key).eqNullSafe(F.col("_key")), "left")
                 .select(key, (F.col("n0") + F.coalesce("bn", F.lit(0))).alias("n0"),
                         (F.col("s1_0") + F.coalesce("bs1", F.lit(0.0))).alias("s1_0"),
                         (F.col("s2_0") + F.coalesce("bs2", F.lit(0.0))).alias("s2_0"), "c", "seen"))
    if expire:
        new_state = new_state.filter(F.col("seen") >= st.agg(F.max("seen")).scalar() - F.expr(f"INTERVAL {expire}"))
    return scored, new_state


def alerts(windowed: DataFrame, threshold: float, above: bool = True) -> DataFrame:
    """Window rows whose average crosses the threshold."""
    cond = F.col("avg_value") > threshold if above else F.col("avg_value") < threshold
    return windowed.filter(cond).withColumn("alert", F.lit("above" if above else "below"))


PROPS_SCHEMA = "k bigint"


def quarantine(events: DataFrame) -> DataFrame:
    """Parse the JSON payload permissively and tag each record valid or
    quarantined with the first failing rule."""
    p = F.from_json("props", PROPS_SCHEMA)
    reason = (F.when(F.col("props").isNull(), "missing_payload")
              .when(p.isNull() | p["k"].isNull(), "malformed_payload")
              .when(F.col("value").isNull(), "missing_value")
              .when(F.col("value") < 0, "negative_value"))
    return events.select("event_id", F.coalesce(reason, F.lit("valid")).alias("status"),
                         p["k"].alias("k"))


def apply_contract(df: DataFrame, features: list[str] = FEATURE_ORDER, defaults: dict | None = None,
                   version: str = "v1") -> DataFrame:
    """Contract projection — fixed feature order, float coercion with
    try_cast, defaults for missing or uncastable values, schema version."""
    defaults = defaults or {}
    cols = []
    for c in features:
        v = F.col(c).cast("string").try_cast("float") if c in df.columns else F.lit(None).cast("float")
        cols.append(F.coalesce(v, F.lit(float(defaults.get(c, 0.0))).cast("float")).alias(c))
    return df.select(*[c for c in ("record_id",) if c in df.columns], *cols, F.lit(version).alias("schema_version"))


def delayed_labels(predictions: DataFrame, labels: DataFrame, key: str = "record_id",
                   label: str = LABEL) -> DataFrame:
    """W7 (batch): performance once late labels arrive — left join on the key."""
    j = predictions.join(labels.select(key, label), key, "left")
    e = F.col("prediction") - F.col(label).cast("double")
    return j.agg(F.count(F.lit(1)).alias("n_predictions"), F.count(label).alias("n_labeled"),
                 F.sqrt(F.avg(e * e)).alias("rmse_labeled"))


LABEL_STATES = ("labeled", "unlabeled", "late_label")


def labels_within(predictions: DataFrame, labels: DataFrame, bound: str, key: str = "record_id") -> DataFrame:
    """Predictions (key, predicted_at, prediction) and labels (key, labelled_at, label), batch or stream,
    joined in full where the label comes within ``bound`` of its prediction: (key, status, prediction, label).

    Status: labeled; unlabeled, a prediction without a label in time; late_label, a label without a
    prediction that it could still reach."""
    mine = labels.withColumnRenamed(key, "_label_key")
    near = (F.col(key) == F.col("_label_key")) & (F.col("labelled_at") >= F.col("predicted_at")) & (F.col("labelled_at") <= F.col("predicted_at") + F.expr(f"INTERVAL {bound}"))
    status = F.when(F.col(key).isNull(), LABEL_STATES[2]).when(F.col("_label_key").isNull(), LABEL_STATES[1]).otherwise(LABEL_STATES[0])
    return predictions.join(mine, near, "full").select(F.coalesce(key, "_label_key").alias(key), status.alias("status"), "prediction", "label")


DECILES = [i / 10 for i in range(1, 10)]


def _long(df: DataFrame, features: list[str]) -> DataFrame:
    stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in features)
    return df.selectExpr(f"stack({len(features)}, {stack}) as (feature, v)")


def psi(baseline: DataFrame, current: DataFrame, features: list[str], eps: float = 1e-6) -> DataFrame:
    """Population stability index per feature over baseline-decile buckets.

    Edges: exact deciles of each baseline feature. Bucket = number of edges
    strictly below the value; both sides are counted in one pass, combined map-side
    to a row per feature and bucket."""
    # nine numbers per feature: the edges become literals of the counting pass
    edges = {r["feature"]: r["q"] for r in exact_quantiles(baseline, features, DECILES).collect()}

    def buckets(df: DataFrame, side: int) -> DataFrame:
        cells = []
        for c in features:
            v = F.col(c).cast("double")
            bucket = sum((F.when(v > e, 1).otherwise(0) for e in edges.get(c, [])), F.lit(0))
            cells.append(F.struct(F.lit(c).alias("feature"), F.when(v.isNotNull(), bucket).alias("bucket")))
        return df.select(F.lit(side).alias("side"), F.explode(F.array(*cells)).alias("x")).select("side", "x.feature", "x.bucket").filter("bucket IS NOT NULL")
    counts = buckets(baseline, 0).unionByName(buckets(current, 1)).groupBy("feature", "bucket").agg(
        F.count_if(F.col("side") == 0).alias("base"), F.count_if(F.col("side") == 1).alias("cur"))           # features x buckets rows
    total = Window.partitionBy("feature")
    d = counts.select("feature", F.try_divide(F.col("base"), F.sum("base").over(total)).alias("p_base"), F.try_divide(F.col("cur"), F.sum("cur").over(total)).alias("p_cur"))
    pb = F.greatest(F.coalesce("p_base", F.lit(0.0)), F.lit(eps))
    pc = F.greatest(F.coalesce("p_cur", F.lit(0.0)), F.lit(eps))
    return d.groupBy("feature").agg(F.sum((pc - pb) * F.log(pc / pb)).alias("psi"))


def ks_drift(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Exact two-sample Kolmogorov–Smirnov statistic per feature:
    max |F_base(v) − F_cur(v)| over all observed values. Counts per distinct
    value are a grouped aggregate; the empirical CDFs come from an exact
    distributed prefix sum (no window over a whole feature)."""
    from retailcast.operators.split import grouped_prefix_sum
    both = (_long(baseline, features).withColumn("_side", F.lit(0))
            .unionByName(_long(current, features).withColumn("_side", F.lit(1)))
            .filter(F.col("v").isNotNull()))
    counts = both.groupBy("feature", "v").agg(F.count_if(F.col("_side") == 0).alias("cb"),
                                              F.count_if(F.col("_side") == 1).alias("cc"))
    n = counts.groupBy("feature").agg(F.sum("cb").alias("nb"), F.sum("cc").alias("nc"))
    cum = grouped_prefix_sum(counts, "feature", "v", ["cb", "cc"])
    gap = F.abs(F.col("cum_cb") / F.col("nb") - F.col("cum_cc") / F.col("nc"))
    # `n` has one row per feature
    return cum.join(F.broadcast(n), "feature").groupBy("feature").agg(F.max(gap).alias("ks"))


def mean_shift(baseline: DataFrame, current: DataFrame, features: list[str]) -> DataFrame:
    """Standardised mean shift per feature, (mean_cur − mean_base) / std_base
    (sample std of the baseline); one wide aggregation per side."""
    def stats(df, tag):
        return df.agg(*[e for c in features for e in (
            F.avg(F.col(c).cast("double")).alias(f"{c}__m{tag}"),
            F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__s{tag}"))])
    b, c_ = stats(baseline, "b"), stats(current, "c")
    row = b.select(*[F.col(x) for x in b.columns],
                   *[c_.select(f"{c}__mc").scalar().alias(f"{c}__mc") for c in features])
    stack = ", ".join(f"'{c}', `{c}__mb`, `{c}__sb`, `{c}__mc`" for c in features)
    long = row.selectExpr(f"stack({len(features)}, {stack}) as (feature, mean_base, std_base, mean_cur)")
    return long.select("feature", "mean_base", "mean_cur",
                       F.try_divide(F.col("mean_cur") - F.col("mean_base"), F.col("std_base")).alias("mean_shift"))


def bias_drift(scored: DataFrame, facet: str = "is_weekend", y: str = "high_demand", yhat: str = "pred_bin", facet_value=1,
               period: tuple = ("year", "month")) -> DataFrame:
    """The post-training record per period and its change against the previous one.

    One grouped pass counts the confusion cells of facet d (``facet_value``) and the rest per period; the
    window runs over one row per period. Undefined ratios, and changes from or to one, are NULL."""
    d, t, p = F.col(facet) == F.lit(facet_value), F.col(y) == 1, F.col(yhat) == 1
    cells = [(f"{g}_{name}", who & cond) for g, who in (("a", ~d), ("d", d)) for name, cond in (("tp", t & p), ("fp", ~t & p), ("tn", ~t & ~p), ("fn", t & ~p))]
    counts = scored.filter(F.col(facet).isNotNull() & F.col(y).isNotNull()).groupBy(*period).agg(*[F.count_if(c).alias(n) for n, c in cells])
    c = {n: F.col(n).cast("double") for n, _ in cells}

    def rates(g: str) -> dict[str, Column]:
        tp, fp, tn, fn = (c[f"{g}_{x}"] for x in ("tp", "fp", "tn", "fn"))
        n = tp + fp + tn + fn
        return {"DPL_labels": F.try_divide(tp + fn, n), "DPPL_predicted": F.try_divide(tp + fp, n), "RD_recall_diff": F.try_divide(tp, tp + fn),
                "DAR_precision_diff": F.try_divide(tp, tp + fp), "AD_accuracy_diff": F.try_divide(tp + tn, n)}
    a, b = rates("a"), rates("d")
    record = counts.select(*period, *[(a[k] - b[k]).alias(k) for k in a], *[sum((F.col(f"{g}_{x}") for x in ("tp", "fp", "tn", "fn")), F.lit(0)).cast("bigint").alias(f"n_{g}") for g in ("a", "d")])
    w = Window.orderBy(*period)
    return record.select("*", *[(F.col(k) - F.lag(k).over(w)).alias(f"{k}_change") for k in a])


def rolling_window(df: DataFrame, days: int = 7, date_col: str = "date", end: Column | None = None) -> DataFrame:
    """Rows of the last `days` days up to `end` (default: the newest date)."""
    last = end if end is not None else df.agg(F.max(F.to_date(date_col))).scalar()
    d = F.to_date(date_col)
    return df.filter((d > F.date_sub(last, days)) & (d <= last))


def retrain_trigger(psi_df: DataFrame, threshold: float = 0.2) -> DataFrame:
    """Per-feature drift flag and whether any feature triggers retraining."""
    flagged = psi_df.withColumn("drifted", F.col("psi") > threshold)
    # the drift table has one row per feature: a whole-table window over it
    # avoids computing the drift twice (once more in a subquery)
    return flagged.withColumn("retrain", F.max(F.col("drifted").cast("int")).over(Window.partitionBy()) == 1)


def prediction_sanity(scored: DataFrame, prediction: str = "prediction", upper: Column | None = None) -> DataFrame:
    """Compliance of predictions: non-negative, finite, below an upper bound."""
    p = F.col(prediction)
    up = upper if upper is not None else F.lit(float("inf"))
    ok = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    return scored.agg(ok(p >= 0).alias("non_negative"), ok(~F.isnan(p) & p.isNotNull()).alias("finite"),
                      ok(p <= up).alias("within_bound"), F.count(F.lit(1)).alias("n"))
