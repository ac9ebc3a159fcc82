"""Sinks (S-series): split tables, TSV reports, the keyed feature table,
monitoring tables and JSON reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from retailcast.contract import FEATURE_ORDER, FEATURE_TABLE_SCHEMA
from retailcast.functions.columns import add_run_context, null_if_not_finite, require_columns


def write_splits(df: DataFrame, path: str, split_col: str = "split_type", fmt: str = "parquet") -> None:
    """One table partitioned by split (train/validation/test folders)."""
    # three folders are too few to deal by: a part would be all that one task read of the largest
    w = _dealt(df, *[f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]).write.mode("overwrite").partitionBy(split_col)
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))


def _dealt(df: DataFrame, *by: str) -> DataFrame:
    """``df`` rebalanced by ``by``: a task sorts its rows by folder before it writes them, and gets a
    part of bounded size however large its input files are."""
    return df.hint("rebalance", *by)


def write_tsv_report(df: DataFrame, path: str) -> None:
    """Single-file TSV with header. Only for report-sized frames (one
    row per metric), never for data-sized ones."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)


def contract_select(df: DataFrame) -> DataFrame:
    """Cast to the 27-column feature-table contract, in order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE_TABLE_SCHEMA.fields])


def read_if_exists(spark, path: str) -> DataFrame | None:
    """A Parquet table, or None when nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def append_feature_table(df: DataFrame, path: str) -> None:
    """Append to the offline feature table, partitioned by year/month. A
    (record_id, event_time) that is stored already is not stored again, so a
    repeated run adds nothing."""
    rows = contract_select(df)
    stored = read_if_exists(df.sparkSession, path)
    if stored is not None:
        rows = rows.join(stored.select("record_id", "event_time"), ["record_id", "event_time"], "left_anti")
    _dealt(rows.select(*[f.name for f in FEATURE_TABLE_SCHEMA.fields]), "year", "month").write.mode("append").partitionBy("year", "month").parquet(path)


def latest_features(table: DataFrame, key: str = "record_id", ts: str = "event_time",
                    tiebreak: str | None = "record_id") -> DataFrame:
    """Newest row per key. `max_by` over a struct is a partial (map-side)
    aggregate: no sort of the whole table and no per-key row buffers."""
    others = [c for c in table.columns if c != key]
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak and tiebreak != key else [])
    return (table.groupBy(key)
            .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("r"))
            .select(key, "r.*"))


def append_monitoring(df: DataFrame, path: str, eval_timestamp_utc: str, run_id: str,
                      ingested_at_utc: str | None = None) -> None:
    """Append with run context, partitioned by (eval_date, run id).
    Dynamic partition overwrite makes a re-run of the same run idempotent."""
    out = add_run_context(df, eval_timestamp_utc, run_id, ingested_at_utc)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("eval_date", "mlflow_run_id").parquet(path))


def _finite(c: Column, t: T.DataType) -> Column:
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return null_if_not_finite(c)
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _finite(x, t.elementType))
    if isinstance(t, T.MapType):
        return F.transform_values(c, lambda k, v: _finite(v, t.valueType))
    if isinstance(t, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_finite(c.getField(f.name), f.dataType).alias(f.name) for f in t.fields]))
    return c


def json_safe(df: DataFrame) -> DataFrame:
    """NaN/±Inf -> NULL in every float, also inside structs, arrays and map values."""
    return df.select(*[_finite(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def write_json_report(df: DataFrame, path: str) -> None:
    """JSON report; non-finite numbers become null and nulls are kept."""
    json_safe(df).coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_csv_payload(df: DataFrame, features: list[str] = FEATURE_ORDER, keep=()) -> DataFrame:
    """Headerless float32 CSV line per row in model feature order."""
    require_columns(df, features)
    return df.select(*keep, F.concat_ws(",", *[F.col(c).cast("float").cast("string")
                                               for c in features]).alias("value"))
