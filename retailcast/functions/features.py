"""Feature engineering: raw 17 columns -> 27-column feature row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.contract import LABEL
from retailcast.functions.columns import (calendar_columns, discount_amount,
                                          event_time_iso, promo_or_holiday)


def p75_threshold(df: DataFrame, label: str = LABEL, q: float = 0.75) -> Column:
    """Scalar column: the exact, linearly interpolated quantile of ``label`` over the whole input."""
    from retailcast.operators.quantile import exact_quantile  # local import: avoids a cycle
    return exact_quantile(df, label, q)


def label_high_demand(df: DataFrame, threshold: Column | float | None = None,
                      label: str = LABEL, out: str = "high_demand") -> DataFrame:
    """``label >= threshold`` as 0/1; threshold defaults to the p75 of the whole input."""
    if threshold is None:
        thr = p75_threshold(df, label)
    elif isinstance(threshold, Column):
        thr = threshold
    else:
        thr = F.lit(float(threshold))
    return df.withColumn(out, F.coalesce(F.col(label) >= thr, F.lit(False)).cast("int"))


def label_fixed_threshold(df: DataFrame, threshold: float = 100, label: str = LABEL,
                          out: str = "high_demand") -> DataFrame:
    """``label >= threshold`` with a fixed threshold."""
    return label_high_demand(df, threshold, label, out)


def label_if_missing(df: DataFrame, label: str = LABEL, out: str = "high_demand") -> DataFrame:
    """build the p75 label only when the column is absent."""
    return df if out in df.columns else label_high_demand(df, label=label, out=out)


def engineer(df: DataFrame, split: bool = True, threshold: Column | float | None = None) -> DataFrame:
    """F1–F8 + P2/P4: add the 10 derived columns in contract order."""
    from retailcast.operators.split import split_hash  # local import: avoids a cycle

    cols = {"event_time": event_time_iso("date")}
    cols.update(calendar_columns("date"))
    cols["discount_amount"] = discount_amount()
    cols["is_promo_or_holiday"] = promo_or_holiday()
    out = label_high_demand(df.withColumns(cols), threshold)
    if split:
        out = split_hash(out)
    return out
