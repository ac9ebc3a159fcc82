"""Pre- and post-training bias metrics (B-series).

Every report is one grouped aggregation (facet x label counts) followed by
arithmetic on a handful of rows; no row-level data leaves the executors.
Undefined ratios are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.contract import LABEL
from retailcast.functions.columns import safe_divide

# ---- fixed values: pre-training metric names and descriptions ----
PRE_METRICS = [
    ("CI", "Class Imbalance (CI)"),
    ("DPL", "Difference in Positive Proportions in Labels (DPL)"),
    ("JS", "Jensen-Shannon Divergence (JS)"),
    ("KL", "Kullback-Liebler Divergence (KL)"),
    ("KS", "Kolmogorov-Smirnov Distance (KS)"),
    ("LP", "L-p Norm (LP)"),
    ("TVD", "Total Variation Distance (TVD)"),
]


def _xlogy(p: Column, q: Column) -> Column:
    """p * ln(p / q) with 0·ln0 = 0 and NULL when q = 0 < p."""
    return F.when(p == 0, F.lit(0.0)).when(q == 0, F.lit(None)).otherwise(p * F.log(p / q))


def label_facet_counts(df: DataFrame, label: str, facet: str, facet_value=1) -> DataFrame:
    """Per label value: count in facet d (== facet_value) and in the rest (a)."""
    is_d = F.col(facet) == F.lit(facet_value)
    return (df.filter(F.col(facet).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col(label).alias("label_value"))
            .agg(F.count_if(~is_d).alias("c_a"), F.count_if(is_d).alias("c_d")))


def pretraining_bias(df: DataFrame, label: str = "high_demand", facet: str = "is_weekend",
                     facet_value=1, positive=1) -> DataFrame:
    """B1–B7 as one wide row: ci, dpl, js, kl, ks, lp, tvd (+ n_a, n_d)."""
    counts = label_facet_counts(df, label, facet, facet_value)
    totals = counts.agg(F.sum("c_a").alias("n_a"), F.sum("c_d").alias("n_d"))
    n_a, n_d = totals.select("n_a").scalar(), totals.select("n_d").scalar()
    pa = F.col("c_a") / n_a
    pd_ = F.col("c_d") / n_d
    m = (pa + pd_) / 2
    per = counts.select(
        "label_value", pa.alias("pa"), pd_.alias("pd"),
        _xlogy(pa, pd_).alias("kl_t"),
        (_xlogy(pa, m) + _xlogy(pd_, m)).alias("js_t"),
        F.abs(pa - pd_).alias("abs_t"))
    pos = F.col("label_value") == F.lit(positive)
    agg = per.agg(
        F.coalesce(F.max(F.when(pos, F.col("pa"))), F.lit(0.0)).alias("q_a"),
        F.coalesce(F.max(F.when(pos, F.col("pd"))), F.lit(0.0)).alias("q_d"),
        F.when(F.count_if(F.col("kl_t").isNull()) == 0, F.sum("kl_t")).alias("kl"),
        (F.sum("js_t") / 2).alias("js"),
        F.max("abs_t").alias("ks"),
        F.sqrt(F.sum(F.col("abs_t") * F.col("abs_t"))).alias("lp"),
        (F.sum("abs_t") / 2).alias("tvd"))
    return agg.select(
        n_a.cast("bigint").alias("n_a"), n_d.cast("bigint").alias("n_d"),
        safe_divide(n_a - n_d, n_a + n_d).alias("ci"),
        (F.col("q_a") - F.col("q_d")).alias("dpl"),
        "js", "kl", "ks", "lp", "tvd")


def pretraining_report(df: DataFrame, label: str = "high_demand", facet: str = "is_weekend",
                       facet_value=1, positive=1) -> DataFrame:
    """Long rows (label, facet, facet_value, name, description, value)."""
    wide = pretraining_bias(df, label, facet, facet_value, positive)
    stack = ", ".join(f"'{n}', '{d}', {n.lower()}" for n, d in PRE_METRICS)
    return wide.selectExpr(
        f"'{label}' as label", f"'{facet}' as facet", f"'{facet_value}' as facet_value",
        f"stack({len(PRE_METRICS)}, {stack}) as (name, description, value)")


# ---------------------------------------------------------------- post-training

def bias_threshold(scored: DataFrame, label_bin: str = "high_demand", label: str = LABEL) -> Column:
    """min label among positives, else p75 of the label (one number)."""
    from retailcast.operators.quantile import exact_quantile
    least = scored.agg(F.min(F.when(F.col(label_bin) == 1, F.col(label).cast("double")))).first()[0]
    return exact_quantile(scored, label, 0.75) if least is None else F.lit(least)


def with_predicted_label(scored: DataFrame, threshold: Column | None = None,
                         prediction: str = "prediction", out: str = "pred_bin",
                         label_bin: str = "high_demand", label: str = LABEL) -> DataFrame:
    thr = bias_threshold(scored, label_bin, label) if threshold is None else threshold
    return scored.withColumn(out, F.coalesce(F.col(prediction) >= thr, F.lit(False)).cast("int"))


def confusion_by_facet(df: DataFrame, facet: str = "is_weekend", y: str = "high_demand",
                       yhat: str = "pred_bin") -> DataFrame:
    """TP, FP, TN, FN, n per facet value (rows with a NULL facet/label excluded)."""
    t, p = F.col(y) == 1, F.col(yhat) == 1
    return (df.filter(F.col(facet).isNotNull() & F.col(y).isNotNull())
            .groupBy(F.col(facet).alias("facet_value"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
                 F.count_if(~t & ~p).alias("tn"), F.count_if(t & ~p).alias("fn")))


RATE_COLUMNS = ["pos_rate_true", "pos_rate_pred", "recall", "precision", "accuracy"]


def group_rates(conf: DataFrame) -> DataFrame:
    """Per-facet rates from the confusion counts."""
    c = F.col
    return conf.select(
        "facet_value", "n", "tp", "fp", "tn", "fn",
        safe_divide(c("tp") + c("fn"), c("n")).alias("pos_rate_true"),
        safe_divide(c("tp") + c("fp"), c("n")).alias("pos_rate_pred"),
        safe_divide(c("tp"), c("tp") + c("fn")).alias("recall"),
        safe_divide(c("tp"), c("tp") + c("fp")).alias("precision"),
        safe_divide(c("tp") + c("tn"), c("n")).alias("accuracy"))


def _pair(rates: DataFrame) -> DataFrame:
    """The two smallest facet values (a < d) side by side in one row.

    a = min over per-facet structs (ordered by facet value, one scalar
    subquery); d = the smallest struct above a (one aggregation). Both run
    over the per-facet table, never over rows."""
    cols = ["n", "tp", "fp", "tn", "fn"] + RATE_COLUMNS
    s = F.struct(F.col("facet_value"), *[F.col(x) for x in cols])
    a = rates.agg(F.min(s)).scalar()
    d = F.min(F.when(F.col("facet_value") > a["facet_value"], s))
    both = rates.agg(d.alias("d")).select(a.alias("a"), "d")
    out = [F.col("a.facet_value").cast("double").alias("group_a_value"),
           F.col("d.facet_value").cast("double").alias("group_d_value")]
    for g in ("a", "d"):
        out += [F.col(f"{g}.{x}").alias(f"{g}_{x}") for x in cols]
    return both.select(*out)


def posttraining_bias(scored: DataFrame, facet: str = "is_weekend", label_bin: str = "high_demand",
                      prediction: str = "prediction", label: str = LABEL) -> DataFrame:
    """The 21-field post-training record, plus the counts behind it
    (B14–B18 from the same one-row pivot). One grouped pass + one threshold pass."""
    thr = bias_threshold(scored, label_bin, label)
    binned = with_predicted_label(scored, thr, prediction, "pred_bin", label_bin, label)
    p = _pair(group_rates(confusion_by_facet(binned, facet, label_bin, "pred_bin")))
    c = F.col
    rec = [thr.alias("threshold_units_sold"), "group_a_value", "group_d_value"]
    for g in ("a", "d"):
        rec.append(c(f"{g}_n").alias(f"group_{g}_n"))
        rec += [c(f"{g}_{x}").alias(f"group_{g}_{x}") for x in RATE_COLUMNS]
    rec += [
        (c("a_pos_rate_true") - c("d_pos_rate_true")).alias("DPL_labels"),
        (c("a_pos_rate_pred") - c("d_pos_rate_pred")).alias("DPPL_predicted"),
        (c("a_recall") - c("d_recall")).alias("RD_recall_diff"),
        (c("a_accuracy") - c("d_accuracy")).alias("AD_accuracy_diff"),
    ]
    return p.select(*rec)


def posttraining_extended(scored: DataFrame, facet: str = "is_weekend", label_bin: str = "high_demand",
                          prediction: str = "prediction", label: str = LABEL) -> DataFrame:
    """DPPL, DI, DCAcc, DCR, RD, DAR, DRR, AD, TE for the a/d pair (one row)."""
    thr = bias_threshold(scored, label_bin, label)
    binned = with_predicted_label(scored, thr, prediction, "pred_bin", label_bin, label)
    p = _pair(group_rates(confusion_by_facet(binned, facet, label_bin, "pred_bin")))
    c = F.col

    def acc_rate(g):   # observed positives / predicted positives
        return safe_divide(c(f"{g}_tp") + c(f"{g}_fn"), c(f"{g}_tp") + c(f"{g}_fp"))

    def rej_rate(g):   # observed negatives / predicted negatives
        return safe_divide(c(f"{g}_tn") + c(f"{g}_fp"), c(f"{g}_tn") + c(f"{g}_fn"))

    def npv(g):
        return safe_divide(c(f"{g}_tn"), c(f"{g}_tn") + c(f"{g}_fn"))

    def fn_fp(g):
        return safe_divide(c(f"{g}_fn"), c(f"{g}_fp"))
    return p.select(
        "group_a_value", "group_d_value",
        (c("a_pos_rate_pred") - c("d_pos_rate_pred")).alias("DPPL"),
        safe_divide(c("d_pos_rate_pred"), c("a_pos_rate_pred")).alias("DI"),
        (acc_rate("a") - acc_rate("d")).alias("DCAcc"),
        (rej_rate("d") - rej_rate("a")).alias("DCR"),
        (c("a_recall") - c("d_recall")).alias("RD"),
        (c("a_precision") - c("d_precision")).alias("DAR"),
        (npv("d") - npv("a")).alias("DRR"),
        (c("a_accuracy") - c("d_accuracy")).alias("AD"),
        (fn_fp("d") - fn_fp("a")).alias("TE"))


def posttraining_one_vs_rest(scored: DataFrame, facet: str = "is_weekend", label_bin: str = "high_demand",
                             prediction: str = "prediction", label: str = LABEL) -> DataFrame:
    """Facets with more than two values: every value d against the rest a
    (a − d differences of label rate, prediction rate, recall and accuracy).
    Per-value counts plus their totals — no pairing of facet values."""
    thr = bias_threshold(scored, label_bin, label)
    binned = with_predicted_label(scored, thr, prediction, "pred_bin", label_bin, label)
    conf = confusion_by_facet(binned, facet, label_bin, "pred_bin")
    tot = conf.agg(*[F.sum(c).alias(f"t_{c}") for c in ("n", "tp", "fp", "tn", "fn")])
    rest = {c: tot.select(f"t_{c}").scalar() - F.col(c) for c in ("n", "tp", "fp", "tn", "fn")}
    c = F.col

    def rates(n, tp, fp, tn, fn):
        return (safe_divide(tp + fn, n), safe_divide(tp + fp, n), safe_divide(tp, tp + fn), safe_divide(tp + tn, n))
    d = rates(c("n"), c("tp"), c("fp"), c("tn"), c("fn"))
    a = rates(rest["n"], rest["tp"], rest["fp"], rest["tn"], rest["fn"])
    return conf.select(
        F.col("facet_value").cast("double").alias("facet_value"), c("n").alias("n_d"), rest["n"].alias("n_a"),
        (a[0] - d[0]).alias("DPL_labels"), (a[1] - d[1]).alias("DPPL_predicted"),
        (a[2] - d[2]).alias("RD_recall_diff"), (a[3] - d[3]).alias("AD_accuracy_diff"))


def excluded_rows(df: DataFrame, facet: str = "is_weekend", label_bin: str = "high_demand") -> DataFrame:
    """Rows left out of the bias reports because the facet or the label is NULL."""
    return df.agg(F.count_if(F.col(facet).isNull() | F.col(label_bin).isNull()).alias("n_excluded"),
                  F.count(F.lit(1)).alias("n_rows"))


def bias_long(record: DataFrame, prefix: str = "bias_") -> DataFrame:
    """Numeric fields of a one-row record as (key, value) rows, NULL/NaN skipped."""
    num = [c for c, t in record.dtypes if t in ("double", "float", "int", "bigint")]
    stack = ", ".join(f"'{prefix}{c}', cast(`{c}` as double)" for c in num)
    long = record.selectExpr(f"stack({len(num)}, {stack}) as (key, value)")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def cddpl(scored: DataFrame, group: str, facet: str = "is_weekend", facet_value=1,
          yhat: str = "pred_bin") -> DataFrame:
    """Conditional demographic disparity of predicted labels.

    Per group i: DD_i = share of facet d among predicted negatives − share of
    facet d among predicted positives; CDDPL = Σ n_i·DD_i / Σ n_i. A group
    without predicted positives or negatives has no DD_i: it is left out with
    its weight and counted in ``n_undefined``. Two-level aggregation: per
    (group) conditional counts, then a weighted sum.
    """
    is_d, pos = F.col(facet) == F.lit(facet_value), F.col(yhat) == 1
    per = (scored.filter(F.col(facet).isNotNull())
           .groupBy(group)
           .agg(F.count(F.lit(1)).alias("n_i"),
                F.count_if(~pos).alias("neg"), F.count_if(pos).alias("pos"),
                F.count_if(~pos & is_d).alias("neg_d"), F.count_if(pos & is_d).alias("pos_d")))
    dd = safe_divide(F.col("neg_d"), F.col("neg")) - safe_divide(F.col("pos_d"), F.col("pos"))
    return per.agg(safe_divide(F.sum(F.col("n_i") * dd), F.sum(F.when(dd.isNotNull(), F.col("n_i")))).alias("CDDPL"),
                   F.count_if(dd.isNull()).alias("n_undefined"))


def flip_test(scored: DataFrame, features: list[str], facet: str = "is_weekend", facet_value=1, yhat: str = "pred_bin",
              id_col: str = "record_id", k: int = 5) -> DataFrame:
    """Counterfactual flip test, one row (n_d, flips_up, flips_down, FT).

    Each row of facet d is held against its ``k`` nearest rows of the rest (exact search over the
    scaled ``features`` but the facet). A row predicted 0 whose neighbours are mostly predicted 1
    flips up, one predicted 1 whose neighbours are not flips down; FT = (up - down) / n_d, NULL
    without rows on either side. Rows with a NULL facet, prediction or id take no part.
    """
    from retailcast.operators.knn import knn_join, scaled_features
    from retailcast.session import materialize
    rows = scaled_features(scored.filter(F.col(facet).isNotNull() & F.col(yhat).isNotNull() & F.col(id_col).isNotNull()), [c for c in features if c != facet], id_col)
    rows = materialize(rows.select(F.col(id_col).cast("long").alias(id_col), (F.col(facet) == F.lit(facet_value)).alias("_d"), F.col(yhat).cast("int").alias("_p"), "x"), "flip_rows")
    near, _ = knn_join(rows.filter("_d"), rows.filter("NOT _d"), k, id_col)
    return flips(rows.select(id_col, "_p"), near, id_col)


def flips(predicted: DataFrame, near: DataFrame, id_col: str) -> DataFrame:
    """The flip-test record of a neighbour table and the predictions of both sides."""
    other = predicted.select(F.col(id_col).alias("candidate_id"), F.col("_p").alias("_np"))
    per = near.join(other, "candidate_id").groupBy("query_id").agg((F.avg("_np") > 0.5).cast("int").alias("_flip"))
    own = per.join(predicted.select(F.col(id_col).alias("query_id"), "_p"), "query_id")
    up, down = F.count_if((F.col("_p") == 0) & (F.col("_flip") == 1)), F.count_if((F.col("_p") == 1) & (F.col("_flip") == 0))
    return own.agg(F.count(F.lit(1)).alias("n_d"), up.alias("flips_up"), down.alias("flips_down")).select(
        "n_d", "flips_up", "flips_down", safe_divide((F.col("flips_up") - F.col("flips_down")).cast("double"), F.col("n_d")).alias("FT"))
