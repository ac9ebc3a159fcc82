"""Scalar column functions (F-series). All are built-in Spark expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"

__all__ = [
    "parse_date", "event_time_iso", "calendar_columns", "weekday_index", "date_string",
    "discount_amount", "promo_or_holiday", "safe_divide", "predicted_label", "residual",
    "eval_date", "compact_timestamp", "sanitize_column_name", "sanitize_names",
    "safe_resource_name", "json_path_first", "sql_predicate", "cast_float32",
    "cast_strings", "select_by_droplist", "select_feature_order", "require_columns",
    "add_run_context", "null_if_not_finite",
]


def parse_date(c: str | Column) -> Column:
    return F.to_date(c)


def event_time_iso(date_col: str | Column) -> Column:
    return F.date_format(F.to_timestamp(F.to_date(date_col)), ISO_Z)


def calendar_columns(date_col: str | Column) -> dict[str, Column]:
    d = F.to_date(date_col)
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        "day_of_year": F.dayofyear(d).cast("int"),
        "day_of_week_index": weekday_index(d),
    }


def weekday_index(date_col: str | Column) -> Column:
    """Monday = 0 … Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(F.to_date(date_col)).cast("int")


def date_string(date_col: str | Column) -> Column:
    return F.date_format(F.to_date(date_col), "yyyy-MM-dd")


def discount_amount(price: str = "base_price", pct: str = "discount_pct") -> Column:
    return F.col(price) * F.col(pct)


def promo_or_holiday(promo: str = "is_promo", holiday: str = "is_holiday") -> Column:
    return F.coalesce((F.col(promo) == 1) | (F.col(holiday) == 1), F.lit(False)).cast("int")


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 or NULL (the undefined case)."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def predicted_label(prediction: str | Column, threshold: Column) -> Column:
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    return F.coalesce(p >= threshold, F.lit(False)).cast("int")


def residual(prediction: str = "prediction", label: str = "units_sold") -> Column:
    return F.col(prediction) - F.col(label)


def eval_date(ts: str | Column) -> Column:
    return F.substring(ts, 1, 10)


def compact_timestamp(ts: str | Column) -> Column:
    return F.regexp_replace(ts, r"[:\-.Z]", "")


def sanitize_column_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")


def sanitize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitize_column_name(c) for c in df.columns])


def safe_resource_name(c: str | Column, max_len: int = 63) -> Column:
    return F.substring(F.translate(c, ":/_", "---"), 1, max_len)


def json_path_first(json_col: str | Column, *paths: str) -> Column:
    """First non-null of several JSON paths (key-spelling fallbacks)."""
    return F.coalesce(*[F.get_json_object(json_col, p) for p in paths])


def sql_predicate(predicate: str) -> Column:
    return F.expr(predicate)


def cast_float32(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("float") for c in columns})


def cast_strings(df: DataFrame) -> DataFrame:
    numeric = ("int", "bigint", "smallint", "tinyint", "double", "float", "boolean")
    return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes
                           if t not in numeric and not t.startswith("decimal")})


def select_by_droplist(df: DataFrame, drop: list[str]) -> DataFrame:
    return df.drop(*drop)


def select_feature_order(df: DataFrame, order: list[str]) -> DataFrame:
    require_columns(df, order)
    return df.select(*order)


def require_columns(df: DataFrame, required: list[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns absent from the table: {missing}")


def add_run_context(df: DataFrame, eval_timestamp_utc: str, run_id: str,
                    ingested_at_utc: str | None = None) -> DataFrame:
    cols = {
        "eval_timestamp_utc": F.lit(eval_timestamp_utc),
        "mlflow_run_id": F.lit(run_id),
        "eval_date": eval_date(F.lit(eval_timestamp_utc)),
    }
    if ingested_at_utc is not None:
        cols["ingested_at_utc"] = F.lit(ingested_at_utc)
    return df.withColumns(cols)


def null_if_not_finite(c: Column) -> Column:
    """NaN / ±Inf -> NULL (JSON-safe)."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)
