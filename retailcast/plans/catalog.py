"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL).

Every query reads the driver tables (through the retail view / feature
table derived from lineitem and part, or `events` / `labels` directly).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailcast.contract import FEATURE_ORDER, GBT_PARAMS, NON_FEATURE_COLUMNS, RAW_COLUMNS, RAW_FIELDS
from retailcast.functions import columns as C
from retailcast.functions.features import label_fixed_threshold, label_high_demand, label_if_missing
from retailcast.operators import attribution as A
from retailcast.operators import boosting as BO
from retailcast.operators import bias as B
from retailcast.operators import evaluation as E
from retailcast.operators import knn as KN
from retailcast.operators import model as M
from retailcast.operators import monitoring as W
from retailcast.operators import profile as X
from retailcast.operators import quality as Q
from retailcast.operators import registry as G
from retailcast.operators import split as P
from retailcast.plans import boosted_sql as BQ
from retailcast.plans.base import feat, raw, scored, spread, table, test_scored
from retailcast.plans.oracle import RETAIL_CTE, bigint_counts, with_base
from retailcast.session import materialize, session_table, shared_path
from retailcast.sources import files as S
from retailcast.sources import sinks as K
from retailcast.streaming import stream as ST

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def q(name: str, sql: str | None = None, level: str = "scored", extra: str = ""):
    def deco(fn):
        QUERIES[name] = (fn, with_base(sql, level, extra) if sql is not None else None)
        return fn
    return deco


def plain(name: str, sql: str | None):
    """Register a query whose oracle SQL needs no retail CTEs."""
    def deco(fn):
        QUERIES[name] = (fn, bigint_counts(sql) if sql else sql)
        return fn
    return deco


# =============================================================== F: scalar functions

@q("parse_date", "SELECT record_id, CAST(date AS DATE) AS d FROM retail", "retail")
def _(spark, sf):
    return raw(spark, sf).select("record_id", C.parse_date("date").alias("d"))


@q("event_time_iso", "SELECT record_id, event_time FROM feat", "feat")
def _(spark, sf):
    return raw(spark, sf).select("record_id", C.event_time_iso("date").alias("event_time"))


@q("calendar_features", "SELECT record_id, year, month, day, day_of_year FROM feat", "feat")
def _(spark, sf):
    cal = C.calendar_columns("date")
    return raw(spark, sf).select("record_id", *[cal[k].alias(k) for k in ("year", "month", "day", "day_of_year")])


@q("weekday_index", "SELECT record_id, day_of_week_index FROM feat", "feat")
def _(spark, sf):
    return raw(spark, sf).select("record_id", C.weekday_index("date").alias("day_of_week_index"))


@q("date_string", "SELECT record_id, strftime(CAST(date AS DATE), '%Y-%m-%d') AS date_str FROM retail", "retail")
def _(spark, sf):
    return raw(spark, sf).select("record_id", C.date_string(C.parse_date("date")).alias("date_str"))


@q("discount_amount", "SELECT record_id, base_price * discount_pct AS discount_amount FROM retail", "retail")
def _(spark, sf):
    return raw(spark, sf).select("record_id", C.discount_amount().alias("discount_amount"))


@q("promo_or_holiday", "SELECT record_id, is_promo_or_holiday FROM feat", "feat")
def _(spark, sf):
    return raw(spark, sf).select("record_id", C.promo_or_holiday().alias("is_promo_or_holiday"))


@q("label_high_demand_p75", "SELECT record_id, units_sold, high_demand FROM feat", "feat")
def _(spark, sf):
    return label_high_demand(raw(spark, sf)).select("record_id", "units_sold", "high_demand")


@q("label_fixed_threshold",
   "SELECT record_id, units_sold, CAST(coalesce(units_sold >= 100, false) AS INTEGER) AS high_demand FROM retail",
   "retail")
def _(spark, sf):
    return label_fixed_threshold(raw(spark, sf), 100).select("record_id", "units_sold", "high_demand")


@q("label_if_missing",
   """SELECT record_id, CAST(coalesce(CAST(units_sold AS DOUBLE) >= (SELECT quantile_cont(units_sold, 0.75)
        FROM feat WHERE split_type = 'test'), false) AS INTEGER) AS high_demand
      FROM feat WHERE split_type = 'test'""", "feat")
def _(spark, sf):
    t = feat(spark, sf).filter("split_type = 'test'").drop("high_demand")
    return label_if_missing(t).select("record_id", "high_demand")


@q("select_by_droplist", "SELECT * EXCLUDE (" + ", ".join(NON_FEATURE_COLUMNS) + ") FROM feat", "feat")
def _(spark, sf):
    return C.select_by_droplist(feat(spark, sf), NON_FEATURE_COLUMNS)


@q("select_feature_order", "SELECT " + ", ".join(FEATURE_ORDER) + " FROM feat", "feat")
def _(spark, sf):
    return C.select_feature_order(feat(spark, sf), FEATURE_ORDER)


@q("cast_float32", "SELECT record_id, " + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in FEATURE_ORDER + ["units_sold"])
   + " FROM feat", "feat")
def _(spark, sf):
    return C.cast_float32(feat(spark, sf), FEATURE_ORDER + ["units_sold"]).select(
        "record_id", *FEATURE_ORDER, "units_sold")


@q("cast_strings", "SELECT record_id, date, day_of_week, holiday_name, promo_type, event_time, split_type FROM feat",
   "feat")
def _(spark, sf):
    return C.cast_strings(feat(spark, sf)).select(
        "record_id", "date", "day_of_week", "holiday_name", "promo_type", "event_time", "split_type")


@q("require_features",
   "SELECT count_if(" + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_ORDER) + ") AS n_valid, "
   "count_if(NOT (" + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_ORDER) + ")) AS n_quarantined "
   "FROM (SELECT * REPLACE (CASE WHEN record_id % 11 <> 0 THEN max_temp_c END AS max_temp_c) FROM feat)",
   "feat")
def _(spark, sf):
    df = feat(spark, sf).withColumn("max_temp_c", F.when(F.col("record_id") % 11 != 0, F.col("max_temp_c")))
    C.require_columns(df, FEATURE_ORDER)
    ok = F.greatest(*[F.col(c).isNull() for c in FEATURE_ORDER]) == F.lit(False)
    return df.agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_quarantined"))


RUN_TS, RUN_ID = "2025-12-03T10:51:32.309311Z", "baseline-store-weekday"

RUNS_SQL = """
runs AS (
  SELECT printf('run-%04d-%02d', year, month) AS mlflow_run_id,
         strftime(CAST(last_day(CAST(max(date) AS DATE)) AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS eval_timestamp_utc,
         count(*) AS n_rows,
         sqrt(avg((prediction - units_sold) * (prediction - units_sold))) AS rmse,
         avg(abs(prediction - units_sold)) AS mae,
         CASE WHEN var_pop(CAST(units_sold AS DOUBLE)) * count(*) > 0
              THEN 1 - sum((prediction - units_sold) * (prediction - units_sold))
                       / (var_pop(CAST(units_sold AS DOUBLE)) * count(*)) END AS r2
  FROM spread GROUP BY year, month)"""


def runs(spark, sf):
    return X.monthly_runs(spread(spark, sf))


@q("eval_date", "SELECT mlflow_run_id, substr(eval_timestamp_utc, 1, 10) AS eval_date FROM runs", extra=RUNS_SQL)
def _(spark, sf):
    return runs(spark, sf).select("mlflow_run_id", C.eval_date("eval_timestamp_utc").alias("eval_date"))


@q("compact_timestamp",
   "SELECT mlflow_run_id, regexp_replace(eval_timestamp_utc, '[:\\-.Z]', '', 'g') AS safe_ts FROM runs",
   extra=RUNS_SQL)
def _(spark, sf):
    return runs(spark, sf).select("mlflow_run_id", C.compact_timestamp("eval_timestamp_utc").alias("safe_ts"))


@q("add_run_context",
   f"""SELECT '{RUN_ID}' AS mlflow_run_id, '{RUN_TS}' AS eval_timestamp_utc, '{RUN_TS[:10]}' AS eval_date,
             n_rows, rmse FROM runs""", extra=RUNS_SQL)
def _(spark, sf):
    r = runs(spark, sf).drop("eval_timestamp_utc", "mlflow_run_id").select("n_rows", "rmse")
    return C.add_run_context(r, RUN_TS, RUN_ID)


REG_EVENTS_SQL = """
regev AS (
  SELECT event_id, CAST(ts AS TIMESTAMP) AS event_time,
    printf('retail-demand-%d', user_id % 2) AS grp,
    CASE WHEN event_id % 4 = 0 AND event_id % 97 <> 0 THEN 'x' WHEN event_id % 4 IN (1, 2, 3) THEN 'x' END AS has_key,
    printf('arn:registry:model-package/%s/%d', printf('retail-demand-%d', user_id % 2), event_id) AS arn,
    CASE WHEN event_type = 'view' THEN 'PendingManualApproval'
         WHEN event_type IN ('click', 'purchase') THEN 'Approved'
         WHEN event_type = 'error' THEN 'Rejected' ELSE 'PendingManualApproval' END AS approval,
    CASE WHEN event_type = 'click' THEN 'InProgress' ELSE 'Completed' END AS pkg_status
  FROM events)"""


def reg_events(spark, sf):
    return G.registry_events_from(table(spark, sf, "events", "event_id", "ts", "user_id", "event_type"))


@plain("sanitize_names",
       "WITH " + REG_EVENTS_SQL + "\nSELECT event_id, substr(translate(arn, ':/_', '---'), 1, 63) AS safe_name FROM regev")
def _(spark, sf):
    e = G.extract_event_key(reg_events(spark, sf))
    arn = F.get_json_object("event_json", "$.detail.ModelPackageGroupName")
    full = F.format_string("arn:registry:model-package/%s/%d", arn, F.col("event_id"))
    return e.select("event_id", C.safe_resource_name(full).alias("safe_name"))


@q("safe_divide",
   """SELECT store_id, CASE WHEN sum(is_holiday) = 0 THEN NULL
        ELSE CAST(sum(is_promo) AS DOUBLE) / CAST(sum(is_holiday) AS DOUBLE) END AS promo_per_holiday
      FROM retail GROUP BY store_id""", "retail")
def _(spark, sf):
    return raw(spark, sf).groupBy("store_id").agg(
        C.safe_divide(F.sum("is_promo"), F.sum("is_holiday")).alias("promo_per_holiday"))


THR_SQL = """
thr AS (SELECT coalesce(min(CASE WHEN high_demand = 1 THEN CAST(units_sold AS DOUBLE) END),
                        quantile_cont(CAST(units_sold AS DOUBLE), 0.75)) AS t FROM spread),
binned AS (SELECT *, CAST(coalesce(prediction >= (SELECT t FROM thr), false) AS INTEGER) AS pred_bin FROM spread)"""


@q("predicted_label", "SELECT record_id, pred_bin FROM binned", extra=THR_SQL)
def _(spark, sf):
    t = spread(spark, sf)
    return t.select("record_id", C.predicted_label("prediction", B.bias_threshold(t)).alias("pred_bin"))


@q("residual", "SELECT record_id, prediction - units_sold AS residual FROM test")
def _(spark, sf):
    return test_scored(spark, sf).select("record_id", C.residual().alias("residual"))


@plain("json_path_get",
       "SELECT event_id, CAST(coalesce(json_extract_string(props, '$.k'), json_extract_string(props, '$.key')) "
       "AS BIGINT) AS k FROM events")
def _(spark, sf):
    ev = table(spark, sf, "events", "event_id", "props")
    return ev.select("event_id", C.json_path_first("props", "$.k", "$.key").cast("bigint").alias("k"))


@q("sql_predicate",
   "SELECT record_id FROM retail WHERE discount_pct >= 0.05 AND is_weekend = 1", "retail")
def _(spark, sf):
    return raw(spark, sf).filter(C.sql_predicate("discount_pct >= 0.05 AND is_weekend = 1")).select("record_id")


# =============================================================== P: splits

@q("split_hash", "SELECT record_id, split_type FROM feat", "feat")
def _(spark, sf):
    return P.split_hash(raw(spark, sf)).select("record_id", "split_type")


@q("split_tag", "SELECT split_type, count(*) AS n FROM feat GROUP BY split_type", "feat")
def _(spark, sf):
    return P.split_hash(raw(spark, sf)).groupBy("split_type").agg(F.count(F.lit(1)).alias("n"))


@q("split_exact",
   """SELECT record_id, CASE WHEN r < n_test THEN 'test' WHEN r < n_hold THEN 'validation' ELSE 'train' END AS split_type
      FROM (SELECT record_id, row_number() OVER (ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id) - 1 AS r,
                   CAST(ceil((1.0::DOUBLE - 0.9::DOUBLE) * count(*) OVER ()) AS BIGINT) AS n_hold,
                   CAST(ceil(0.05::DOUBLE / (0.05::DOUBLE + 0.05::DOUBLE)
                        * ceil((1.0::DOUBLE - 0.9::DOUBLE) * count(*) OVER ())) AS BIGINT) AS n_test
            FROM retail)""", "retail")
def _(spark, sf):
    return P.split_exact(raw(spark, sf)).select("record_id", "split_type")


@q("sample_cap",
   "SELECT record_id, units_sold FROM retail ORDER BY md5('42:' || CAST(record_id AS VARCHAR)), record_id LIMIT 300",
   "retail")
def _(spark, sf):
    return P.sample_cap(raw(spark, sf), 300).select("record_id", "units_sold")


# =============================================================== Q: data quality

def _metrics_sql(items: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{e}' AS entity, '{i}' AS instance, '{n}' AS name, CAST({x} AS DOUBLE) AS value FROM retail"
        for e, i, n, x in items)


DQ_ITEMS = [
    ("Dataset", "*", "Size", "count(*)"),
    *[("Column", c, "Completeness", f"avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END)")
      for c in ("record_id", "date", "store_id", "units_sold", "base_price")],
    ("Column", "store_id", "ApproxCountDistinct", "count(DISTINCT store_id)"),
    ("Column", "day_of_week", "ApproxCountDistinct", "count(DISTINCT day_of_week)"),
    *[("Column", c, "Mean", f"avg(CAST({c} AS DOUBLE))")
      for c in ("units_sold", "base_price", "discount_pct", "max_temp_c", "rainfall_mm")],
    ("Column", "non_negative_units_sold", "Compliance",
     "avg(CASE WHEN coalesce(units_sold >= 0, false) THEN 1.0 ELSE 0.0 END)"),
    ("Column", "valid_discount_range", "Compliance",
     "avg(CASE WHEN coalesce(discount_pct >= 0 AND discount_pct <= 1, false) THEN 1.0 ELSE 0.0 END)"),
    ("Column", "positive_base_price", "Compliance",
     "avg(CASE WHEN coalesce(base_price > 0, false) THEN 1.0 ELSE 0.0 END)"),
    ("Mutlicolumn", "units_sold,base_price", "Correlation", "corr(CAST(units_sold AS DOUBLE), base_price)"),
    ("Mutlicolumn", "units_sold,max_temp_c", "Correlation", "corr(CAST(units_sold AS DOUBLE), max_temp_c)"),
]


def _dq(spark, sf, names: set[str] | None = None):
    an = [a for a in Q.default_analyzers() if names is None or a.name in names]
    return Q.run_analyzers(raw(spark, sf), an)


@q("dq_size", _metrics_sql(DQ_ITEMS[:1]), "retail")
def _(spark, sf):
    return _dq(spark, sf, {"Size"})


@q("dq_completeness", _metrics_sql([i for i in DQ_ITEMS if i[2] == "Completeness"]), "retail")
def _(spark, sf):
    return _dq(spark, sf, {"Completeness"})


@q("dq_approx_distinct", _metrics_sql([i for i in DQ_ITEMS if i[2] == "ApproxCountDistinct"]), "retail")
def _(spark, sf):
    return _dq(spark, sf, {"ApproxCountDistinct"})


@q("dq_mean", _metrics_sql([i for i in DQ_ITEMS if i[2] == "Mean"]), "retail")
def _(spark, sf):
    return _dq(spark, sf, {"Mean"})


@q("dq_compliance", _metrics_sql([i for i in DQ_ITEMS if i[2] == "Compliance"]), "retail")
def _(spark, sf):
    return _dq(spark, sf, {"Compliance"})


@q("dq_correlation", _metrics_sql([i for i in DQ_ITEMS if i[2] == "Correlation"]), "retail")
def _(spark, sf):
    return _dq(spark, sf, {"Correlation"})


@q("dq_metrics_table", _metrics_sql(DQ_ITEMS), "retail")
def _(spark, sf):
    return _dq(spark, sf)


CHECK_ITEMS = [
    ("SizeConstraint(Size(None))", "count(*)", ">= 500", "Dataset", "*", "Size"),
    ("MinimumConstraint(Minimum(units_sold,None))", "min(units_sold)", ">= 0", "Column", "units_sold", "Minimum"),
    ("MaximumConstraint(Maximum(discount_pct,None))", "max(discount_pct)", "<= 1.0", "Column", "discount_pct",
     "Maximum"),
    *[(f"CompletenessConstraint(Completeness({c},None))",
       f"avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END)", "= 1.0", "Column", c, "Completeness")
      for c in ("record_id", "date", "store_id", "units_sold")],
    ("UniquenessConstraint(Uniqueness(List(record_id),None))",
     "CAST(sum(CASE WHEN cnt = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(cnt)",
     "= 1.0", "Column", "record_id", "Uniqueness",
     "(SELECT record_id, count(*) AS cnt FROM retail WHERE record_id IS NOT NULL GROUP BY record_id) u"),
    ("ComplianceConstraint(Compliance(day_of_week contained in "
     "Monday,Tuesday,Wednesday,Thursday,Friday,Saturday,Sunday,None))",
     "avg(CASE WHEN day_of_week IS NULL OR day_of_week IN ('Monday','Tuesday','Wednesday','Thursday','Friday',"
     "'Saturday','Sunday') THEN 1.0 ELSE 0.0 END)", "= 1.0", "Column", "day_of_week", "Compliance"),
    *[(f"ComplianceConstraint(Compliance({c} contained in 0,1,None))",
       f"avg(CASE WHEN {c} IS NULL OR {c} IN (0, 1) THEN 1.0 ELSE 0.0 END)", "= 1.0", "Column", c, "Compliance")
      for c in ("is_weekend", "is_holiday", "is_hot_day", "is_rainy_day", "is_promo")],
]


def _checks_sql(items, cols: str) -> str:
    vals = "\nUNION ALL ".join(
        f"SELECT '{it[0]}' AS \"constraint\", '{it[3]}' AS entity, '{it[4]}' AS instance, '{it[5]}' AS name, "
        f"CAST({it[1]} AS DOUBLE) AS value, coalesce(CAST({it[1]} AS DOUBLE) {it[2]}, false) AS ok "
        f"FROM {it[6] if len(it) > 6 else 'retail'}"
        for it in items)
    return f"SELECT {cols} FROM ({vals}) v"


CHECK_STATUS = "CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status"


def _check(spark, sf, prefix):
    cs = [c for c in Q.default_constraints() if c.description.startswith(prefix)]
    return Q.check_results(raw(spark, sf), cs).select("constraint", "constraint_status")


for _name, _prefix in (("check_size", "Size"), ("check_min", "Minimum"), ("check_max", "Maximum"),
                       ("check_complete", "Completeness"), ("check_unique", "Uniqueness"),
                       ("check_contained", "Compliance")):
    QUERIES[_name] = (
        (lambda p: (lambda spark, sf: _check(spark, sf, p)))(_prefix),
        with_base(_checks_sql([i for i in CHECK_ITEMS if i[0].startswith(_prefix)],
                              f"\"constraint\", {CHECK_STATUS}"), "retail"))


@q("check_results",
   "SELECT 'daily sales quality' AS \"check\", 'Error' AS check_level, "
   "CASE WHEN bool_and(ok) OVER () THEN 'Success' ELSE 'Error' END AS check_status, \"constraint\", "
   + CHECK_STATUS + ", CASE WHEN ok THEN '' ELSE 'Value: ' || CAST(value AS VARCHAR) || "
   "' does not meet the constraint requirement!' END AS constraint_message FROM ("
   + _checks_sql(CHECK_ITEMS, "*") + ") w", "retail")
def _(spark, sf):
    return Q.check_results(raw(spark, sf))


#: Rows that break most constraints: sizes stay, values, keys, days and flags are spoilt by record id.
_SPOILT = {"record_id": "CASE WHEN record_id % 13 = 0 THEN record_id - record_id % 26 WHEN record_id % 29 <> 0 THEN record_id END",
           "units_sold": "CASE WHEN record_id % 17 <> 0 THEN units_sold - 40 END", "discount_pct": "discount_pct * 20",
           "day_of_week": "CASE WHEN record_id % 5 = 0 THEN 'Funday' ELSE day_of_week END", "is_promo": "is_promo + is_weekend"}


def _spoilt_rows(spark, sf) -> DataFrame:
    return raw(spark, sf).select(*[F.expr(f"CAST({_SPOILT[c]} AS {dict(raw(spark, sf).dtypes)[c]})").alias(c) if c in _SPOILT else F.col(c) for c in RAW_COLUMNS])


FAILING_SQL = "spoilt AS (SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, e in _SPOILT.items()) + ") FROM retail)"


@q("check_results_failing",
   "SELECT 'daily sales quality' AS \"check\", 'Error' AS check_level, "
   "CASE WHEN bool_and(ok) OVER () THEN 'Success' ELSE 'Error' END AS check_status, \"constraint\", "
   + CHECK_STATUS + ", NOT ok AND round(value, 6) IS NOT NULL AS has_message, CASE WHEN NOT ok THEN round(value, 6) END AS message_value FROM ("
   + _checks_sql(CHECK_ITEMS, "*").replace("FROM retail", "FROM spoilt") + ") w", "retail", extra=FAILING_SQL)
def _(spark, sf):
    """The value in a message is read back: the text of a double differs between engines."""
    m = F.col("constraint_message")
    return Q.check_results(_spoilt_rows(spark, sf)).select(
        "check", "check_level", "check_status", "constraint", "constraint_status",
        (m.startswith("Value: ") & m.endswith(" does not meet the constraint requirement!")).alias("has_message"),
        F.round(F.regexp_extract(m, "^Value: (\\S+) ", 1).try_cast("double"), 6).alias("message_value"))


METRIC_COLUMNS = (["units_sold", "base_price", "max_temp_c"], ["store_id", "day_of_week", "record_id"], [("base_price", "units_sold")])
_DISTINCT_TOLERANCE = 0.03


@q("dq_metrics_merged", "SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value FROM retail UNION ALL " + " UNION ALL ".join(
    [f"SELECT 'Column', '{c}', 'Completeness', avg(CASE WHEN {c} IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) FROM retail" for c in METRIC_COLUMNS[0] + METRIC_COLUMNS[1]]
    + [f"SELECT 'Column', '{c}', '{n}', CAST({f}(CAST({c} AS DOUBLE)) AS DOUBLE) FROM retail" for c in METRIC_COLUMNS[0]
       for n, f in (("Mean", "avg"), ("Minimum", "min"), ("Maximum", "max"), ("StandardDeviation", "stddev_pop"))]
    + [f"SELECT 'Column', '{c}', 'ApproxCountDistinct', CAST(count(DISTINCT {c}) AS DOUBLE) FROM retail" for c in METRIC_COLUMNS[1]]
    + ["SELECT 'Mutlicolumn', 'base_price,units_sold', 'Correlation', corr(base_price, CAST(units_sold AS DOUBLE)) FROM retail"]), "retail")
def _(spark, sf):
    """Metrics of months, stored one by one and added up. A distinct estimate within 3 % of the
    exact count is given as that count, so that the comparison states its tolerance."""
    src = raw(spark, sf).withColumn("month", F.substring("date", 1, 7))
    state = materialize(Q.metric_state(src, ["month"], *METRIC_COLUMNS), "metric_state")
    merged = Q.merged_metrics(state, *METRIC_COLUMNS)
    exact = raw(spark, sf).agg(*[F.count_distinct(c).cast("double").alias(c) for c in METRIC_COLUMNS[1]])
    true = F.coalesce(*[F.when(F.col("instance") == c, exact.select(c).scalar()) for c in METRIC_COLUMNS[1]])
    close = (F.col("name") == "ApproxCountDistinct") & (F.abs(F.col("value") - true) <= _DISTINCT_TOLERANCE * true)
    return merged.select("entity", "instance", "name", F.when(close, true).otherwise(F.col("value")).alias("value"))


@q("check_success_metrics", _checks_sql(CHECK_ITEMS, "entity, instance, name, value"), "retail")
def _(spark, sf):
    return Q.success_metrics(raw(spark, sf))


@q("check_unique_composite",
   """SELECT CAST(sum(CASE WHEN cnt = 1 THEN 1 ELSE 0 END) AS DOUBLE) / sum(cnt) AS value
      FROM (SELECT date, store_id, count(*) AS cnt FROM retail
            WHERE date IS NOT NULL AND store_id IS NOT NULL GROUP BY date, store_id)""", "retail")
def _(spark, sf):
    return Q.uniqueness(raw(spark, sf), "date", "store_id")


def _suggest_sql(fields: list[tuple[str, bool]], src: str = "retail", level: str = "retail", extra: str = "") -> str:
    """``fields``: (column, whether it is a string)."""
    stats, rules = ["CAST(count(*) AS DOUBLE) AS n"], []
    for c, is_str in fields:
        extra_col = (f"avg(CASE WHEN {c} IS NOT NULL THEN CASE WHEN TRY_CAST({c} AS DOUBLE) IS NOT NULL "
                     f"THEN 1.0 ELSE 0.0 END END) AS {c}__num" if is_str else f"min(CAST({c} AS DOUBLE)) AS {c}__min")
        order = "v" if is_str else "CAST(v AS DOUBLE)"
        stats.append(f"avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END) AS {c}__compl, "
                     f"count(DISTINCT {c}) AS {c}__card, {extra_col}")
        sel = "SELECT '{c}' AS column_name, '{r}' AS rule, '{d}' AS description, {code} AS code_for_constraint FROM prof WHERE {w}"
        rules.append(sel.format(c=c, r="CompleteIfCompleteRule", d=f"''{c}'' is not null",
                                code=f"'.isComplete(\"{c}\")'", w=f"{c}__compl = 1.0"))
        rules.append(sel.format(c=c, r="RetainCompletenessRule", d=f"''{c}'' has less than full completeness",
                                code=f"printf('.hasCompleteness(\"{c}\", _ >= %.2f)', floor(greatest({c}__compl - 1.96::DOUBLE * sqrt({c}__compl * (1.0::DOUBLE - {c}__compl) / n), 0) * 100) / 100)",
                                w=f"{c}__compl < 1.0 AND {c}__compl > 0"))
        rules.append(sel.format(c=c, r="CategoricalRangeRule", d=f"''{c}'' has value range of at most 10 values",
                                code=f"'.isContainedIn(\"{c}\", Array(' || coalesce((SELECT string_agg('\"' || v || '\"', ', ' ORDER BY {order}) "
                                     f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {src} WHERE {c} IS NOT NULL)), '') || '))'", w=f"{c}__card BETWEEN 1 AND 10"))
        if is_str:
            rules.append(sel.format(c=c, r="RetainTypeRule", d=f"''{c}'' has numeric type",
                                    code=f"'.hasDataType(\"{c}\", ConstrainableDataTypes.Numeric)'",
                                    w=f"{c}__num = 1.0"))
        else:
            rules.append(sel.format(c=c, r="NonNegativeNumbersRule", d=f"''{c}'' has no negative values",
                                    code=f"'.isNonNegative(\"{c}\")'", w=f"{c}__min >= 0"))
    return with_base(" UNION ALL ".join(rules), level, (extra + "," if extra else "") + "prof AS (SELECT " + ", ".join(stats) + f" FROM {src})")


#: Columns with exactly ten and eleven values, text values, gaps and nothing at all, beside two of the table.
GAPS = [("ten", False), ("eleven", False), ("words", True), ("digits", True), ("gaps", False), ("nothing", False), ("promo_type", True), ("units_sold", False)]
GAPS_SQL = """gappy AS (SELECT record_id % 10 AS ten, record_id % 11 - 5 AS eleven, 'w' || CAST(record_id % 3 AS VARCHAR) AS words, CAST(record_id % 4 AS VARCHAR) AS digits,
  CASE WHEN record_id % 7 > 0 THEN record_id % 9 END AS gaps, CAST(NULL AS DOUBLE) AS nothing, promo_type, units_sold FROM retail)"""


@q("suggest_constraints_gaps")
def _(spark, sf):
    i = F.col("record_id")
    return Q.suggest_constraints(raw(spark, sf).select(
        (i % 10).alias("ten"), (i % 11 - 5).alias("eleven"), F.concat(F.lit("w"), (i % 3).cast("string")).alias("words"), (i % 4).cast("string").alias("digits"),
        F.when(i % 7 > 0, i % 9).alias("gaps"), F.lit(None).cast("double").alias("nothing"), "promo_type", "units_sold"))


@q("suggest_constraints")
def _(spark, sf):
    return Q.suggest_constraints(raw(spark, sf))


# =============================================================== E: evaluation

METRICS_SQL = """count(*) AS n_rows,
  sqrt(avg((prediction - units_sold) * (prediction - units_sold))) AS rmse,
  avg(abs(prediction - units_sold)) AS mae,
  CASE WHEN var_pop(CAST(units_sold AS DOUBLE)) * count(*) > 0
       THEN 1 - sum((prediction - units_sold) * (prediction - units_sold))
                / (var_pop(CAST(units_sold AS DOUBLE)) * count(*)) END AS r2"""


@q("eval_rmse", "SELECT sqrt(avg((prediction - units_sold) * (prediction - units_sold))) AS rmse FROM test")
def _(spark, sf):
    return E.regression_metrics(test_scored(spark, sf)).select("rmse")


@q("eval_mae", "SELECT avg(abs(prediction - units_sold)) AS mae FROM test")
def _(spark, sf):
    return E.regression_metrics(test_scored(spark, sf)).select("mae")


@q("eval_r2", f"SELECT r2 FROM (SELECT {METRICS_SQL} FROM test)")
def _(spark, sf):
    return E.regression_metrics(test_scored(spark, sf)).select("r2")


@q("eval_by_split", f"SELECT split_type, {METRICS_SQL} FROM scored GROUP BY split_type")
def _(spark, sf):
    return E.regression_metrics(scored(spark, sf), by=["split_type"])


@q("fit_status",
   f"""SELECT train_rmse, val_rmse, val_rmse - train_rmse AS generalization_gap_rmse,
         val_rmse / (train_rmse + 1e-8) AS val_train_rmse_ratio,
         CASE WHEN val_rmse / (train_rmse + 1e-8) > 1.15 AND val_rmse - train_rmse > 5 THEN 'overfit'
              WHEN val_rmse / (train_rmse + 1e-8) < 1.02 THEN 'underfit' ELSE 'good_fit' END AS fit_status
       FROM (SELECT max(CASE WHEN split_type = 'train' THEN rmse END) AS train_rmse,
                    max(CASE WHEN split_type = 'validation' THEN rmse END) AS val_rmse
             FROM (SELECT split_type, {METRICS_SQL} FROM scored GROUP BY split_type))""")
def _(spark, sf):
    return E.fit_status(E.regression_metrics(scored(spark, sf), by=["split_type"]))


@q("predictions_table", "SELECT record_id, store_id, date, units_sold, high_demand, prediction FROM test")
def _(spark, sf):
    return test_scored(spark, sf).select("record_id", "store_id", "date", "units_sold", "high_demand", "prediction")


@q("baseline_predict", "SELECT record_id, split_type, prediction FROM scored")
def _(spark, sf):
    return E.baseline_predict(feat(spark, sf)).select("record_id", "split_type", "prediction")


@q("residual_histogram",
   """SELECT bin, lo + bin * w AS bin_lo, lo + (bin + 1) * w AS bin_hi, count(*) AS n
      FROM (SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((r - lo) / w), 29) END AS INTEGER) AS bin, lo, w
            FROM (SELECT prediction - units_sold AS r FROM test) x,
                 (SELECT min(prediction - units_sold) AS lo, max(prediction - units_sold) AS hi,
                         (max(prediction - units_sold) - min(prediction - units_sold)) / 30.0::DOUBLE AS w FROM test) s)
      GROUP BY bin, lo, w""")
def _(spark, sf):
    return E.residual_histogram(test_scored(spark, sf), 30)


@q("pred_vs_actual",
   """SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((y - lo) / w), 19) END AS INTEGER) AS actual_bin,
             CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((p - lo) / w), 19) END AS INTEGER) AS pred_bin,
             count(*) AS n
      FROM (SELECT CAST(units_sold AS DOUBLE) AS y, prediction AS p FROM test) x,
           (SELECT least(min(CAST(units_sold AS DOUBLE)), min(prediction)) AS lo,
                   greatest(max(CAST(units_sold AS DOUBLE)), max(prediction)) AS hi,
                   (greatest(max(CAST(units_sold AS DOUBLE)), max(prediction))
                    - least(min(CAST(units_sold AS DOUBLE)), min(prediction))) / 20.0::DOUBLE AS w FROM test) s
      GROUP BY 1, 2""")
def _(spark, sf):
    return E.pred_vs_actual(test_scored(spark, sf), 20)


@q("label_stats", "SELECT avg(CAST(units_sold AS DOUBLE)) AS label_mean, stddev_samp(CAST(units_sold AS DOUBLE)) "
   "AS label_std FROM test")
def _(spark, sf):
    return E.label_stats(test_scored(spark, sf))


@q("label_distribution",
   """SELECT count_if(high_demand = 1) AS n_pos, count_if(high_demand = 0) AS n_neg,
             CAST(count_if(high_demand = 1) AS DOUBLE) / nullif(count_if(high_demand = 1) + count_if(high_demand = 0), 0)
             AS pos_rate_overall FROM test""")
def _(spark, sf):
    return E.label_distribution(test_scored(spark, sf))


# =============================================================== B: bias (pre-training)

def _pre_sql(src: str, label: str, facet: str) -> str:
    return f"""
cnt AS (SELECT {label} AS label_value, count_if(NOT ({facet} = 1)) AS c_a, count_if({facet} = 1) AS c_d
        FROM {src} WHERE {facet} IS NOT NULL AND {label} IS NOT NULL GROUP BY 1),
tot AS (SELECT sum(c_a) AS n_a, sum(c_d) AS n_d FROM cnt),
pp AS (SELECT label_value, CAST(c_a AS DOUBLE) / n_a AS pa, CAST(c_d AS DOUBLE) / n_d AS pd FROM cnt, tot),
pt AS (SELECT *, (pa + pd) / 2 AS m,
         CASE WHEN pa = 0 THEN 0.0 WHEN pd = 0 THEN NULL ELSE pa * ln(pa / pd) END AS kl_t,
         abs(pa - pd) AS abs_t FROM pp),
pre AS (
  SELECT CAST(n_a AS BIGINT) AS n_a, CAST(n_d AS BIGINT) AS n_d,
    CAST(n_a - n_d AS DOUBLE) / nullif(n_a + n_d, 0) AS ci,
    coalesce(max(CASE WHEN label_value = 1 THEN pa END), 0.0) - coalesce(max(CASE WHEN label_value = 1 THEN pd END), 0.0) AS dpl,
    sum((CASE WHEN pa = 0 THEN 0.0 ELSE pa * ln(pa / m) END) + (CASE WHEN pd = 0 THEN 0.0 ELSE pd * ln(pd / m) END)) / 2 AS js,
    CASE WHEN count_if(kl_t IS NULL) = 0 THEN sum(kl_t) END AS kl,
    max(abs_t) AS ks, sqrt(sum(abs_t * abs_t)) AS lp, sum(abs_t) / 2 AS tvd
  FROM pt, tot GROUP BY n_a, n_d)"""


PRE_SQL = _pre_sql("feat", "high_demand", "is_weekend")


def _pre(spark, sf):
    return B.pretraining_bias(feat(spark, sf))


for _m in ("ci", "dpl", "js", "kl", "ks", "lp", "tvd"):
    QUERIES[f"bias_{_m}"] = ((lambda m: (lambda spark, sf: _pre(spark, sf).select(m)))(_m),
                             with_base(f"SELECT {_m} FROM pre", "feat", PRE_SQL))

_PRE_LONG = " UNION ALL ".join(
    f"SELECT 'high_demand' AS label, 'is_weekend' AS facet, '1' AS facet_value, '{n}' AS name, '{d}' AS description, "
    f"{n.lower()} AS value FROM pre" for n, d in B.PRE_METRICS)


@q("bias_pretraining_report", _PRE_LONG, "feat", PRE_SQL)
def _(spark, sf):
    return B.pretraining_report(feat(spark, sf))


@plain("bias_pretraining_labels",
       "WITH " + _pre_sql("labels", "quality", "toxic") + "\nSELECT * FROM pre")
def _(spark, sf):
    return B.pretraining_bias(table(spark, sf, "labels"), label="quality", facet="toxic")


# =============================================================== B: bias (post-training)

POST_SQL = THR_SQL + """,
conf AS (SELECT is_weekend AS facet_value, count(*) AS n,
           count_if(high_demand = 1 AND pred_bin = 1) AS tp, count_if(high_demand <> 1 AND pred_bin = 1) AS fp,
           count_if(high_demand <> 1 AND pred_bin <> 1) AS tn, count_if(high_demand = 1 AND pred_bin <> 1) AS fn
         FROM binned WHERE is_weekend IS NOT NULL AND high_demand IS NOT NULL GROUP BY 1),
rates AS (SELECT *, CAST(tp + fn AS DOUBLE) / nullif(n, 0) AS pos_rate_true,
            CAST(tp + fp AS DOUBLE) / nullif(n, 0) AS pos_rate_pred,
            CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall,
            CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
            CAST(tp + tn AS DOUBLE) / nullif(n, 0) AS accuracy FROM conf),
ga AS (SELECT * FROM rates WHERE facet_value = (SELECT min(facet_value) FROM rates)),
gd AS (SELECT * FROM rates WHERE facet_value = (SELECT min(facet_value) FROM rates
                                                 WHERE facet_value > (SELECT min(facet_value) FROM rates))),
post AS (
  SELECT (SELECT t FROM thr) AS threshold_units_sold,
    CAST(ga.facet_value AS DOUBLE) AS group_a_value, CAST(gd.facet_value AS DOUBLE) AS group_d_value,
    ga.n AS group_a_n, ga.pos_rate_true AS group_a_pos_rate_true, ga.pos_rate_pred AS group_a_pos_rate_pred,
    ga.recall AS group_a_recall, ga.precision AS group_a_precision, ga.accuracy AS group_a_accuracy,
    gd.n AS group_d_n, gd.pos_rate_true AS group_d_pos_rate_true, gd.pos_rate_pred AS group_d_pos_rate_pred,
    gd.recall AS group_d_recall, gd.precision AS group_d_precision, gd.accuracy AS group_d_accuracy,
    ga.pos_rate_true - gd.pos_rate_true AS DPL_labels, ga.pos_rate_pred - gd.pos_rate_pred AS DPPL_predicted,
    ga.recall - gd.recall AS RD_recall_diff, ga.accuracy - gd.accuracy AS AD_accuracy_diff,
    ga.tp AS a_tp, ga.fp AS a_fp, ga.tn AS a_tn, ga.fn AS a_fn, gd.tp AS d_tp, gd.fp AS d_fp, gd.tn AS d_tn, gd.fn AS d_fn
  FROM ga, gd)"""


def _binned(spark, sf):
    return B.with_predicted_label(spread(spark, sf))


@q("bias_confusion", "SELECT * FROM conf", extra=POST_SQL)
def _(spark, sf):
    return B.confusion_by_facet(_binned(spark, sf))


@q("bias_group_rates", "SELECT * FROM rates", extra=POST_SQL)
def _(spark, sf):
    return B.group_rates(B.confusion_by_facet(_binned(spark, sf)))


@q("bias_differences", "SELECT DPL_labels, DPPL_predicted, RD_recall_diff, AD_accuracy_diff FROM post",
   extra=POST_SQL)
def _(spark, sf):
    return B.posttraining_bias(spread(spark, sf)).select(
        "DPL_labels", "DPPL_predicted", "RD_recall_diff", "AD_accuracy_diff")


POST_FIELDS = ["threshold_units_sold", "group_a_value", "group_d_value"] + [
    f"group_{g}_{x}" for g in ("a", "d") for x in ["n"] + B.RATE_COLUMNS] + [
    "DPL_labels", "DPPL_predicted", "RD_recall_diff", "AD_accuracy_diff"]


@q("bias_posttraining_report", "SELECT " + ", ".join(POST_FIELDS) + " FROM post", extra=POST_SQL)
def _(spark, sf):
    return B.posttraining_bias(spread(spark, sf))


@q("bias_long", " UNION ALL ".join(
    f"SELECT 'bias_{c}' AS key, CAST({c} AS DOUBLE) AS value FROM post WHERE {c} IS NOT NULL AND NOT isnan({c})"
    for c in POST_FIELDS), extra=POST_SQL)
def _(spark, sf):
    return B.bias_long(B.posttraining_bias(spread(spark, sf)))


EXT_SQL = """
ext AS (SELECT group_a_value, group_d_value,
  group_a_pos_rate_pred - group_d_pos_rate_pred AS DPPL,
  group_d_pos_rate_pred / nullif(group_a_pos_rate_pred, 0) AS DI,
  CAST(a_tp + a_fn AS DOUBLE) / nullif(a_tp + a_fp, 0) - CAST(d_tp + d_fn AS DOUBLE) / nullif(d_tp + d_fp, 0) AS DCAcc,
  CAST(d_tn + d_fp AS DOUBLE) / nullif(d_tn + d_fn, 0) - CAST(a_tn + a_fp AS DOUBLE) / nullif(a_tn + a_fn, 0) AS DCR,
  group_a_recall - group_d_recall AS RD, group_a_precision - group_d_precision AS DAR,
  CAST(d_tn AS DOUBLE) / nullif(d_tn + d_fn, 0) - CAST(a_tn AS DOUBLE) / nullif(a_tn + a_fn, 0) AS DRR,
  group_a_accuracy - group_d_accuracy AS AD,
  CAST(d_fn AS DOUBLE) / nullif(d_fp, 0) - CAST(a_fn AS DOUBLE) / nullif(a_fp, 0) AS TE
  FROM post)"""


def _ext(spark, sf):
    return B.posttraining_extended(spread(spark, sf))


for _name, _cols in (("bias_dppl", ["DPPL", "DI"]), ("bias_dcacc", ["DCAcc", "DCR"]), ("bias_rd", ["RD", "AD"]),
                     ("bias_dar", ["DAR", "DRR"]), ("bias_te", ["TE"])):
    QUERIES[_name] = ((lambda cs: (lambda spark, sf: _ext(spark, sf).select(*cs)))(_cols),
                      with_base("SELECT " + ", ".join(_cols) + " FROM ext", "scored", POST_SQL + "," + EXT_SQL))


@q("bias_cddpl",
   """SELECT sum(n_i * dd) / nullif(sum(CASE WHEN dd IS NOT NULL THEN n_i END), 0) AS CDDPL,
             count_if(dd IS NULL) AS n_undefined
      FROM (SELECT n_i, CAST(neg_d AS DOUBLE) / nullif(neg, 0) - CAST(pos_d AS DOUBLE) / nullif(pos, 0) AS dd FROM (SELECT store_id, count(*) AS n_i, count_if(pred_bin <> 1) AS neg, count_if(pred_bin = 1) AS pos,
                   count_if(pred_bin <> 1 AND is_weekend = 1) AS neg_d, count_if(pred_bin = 1 AND is_weekend = 1) AS pos_d
            FROM binned WHERE is_weekend IS NOT NULL GROUP BY store_id))""", extra=THR_SQL)
def _(spark, sf):
    return B.cddpl(_binned(spark, sf), group="store_id")


FT_FEATURES = [c for c in FEATURE_ORDER if c != "is_weekend"]
_FT_SCALED = ", ".join(f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN coalesce(floor(1000.0::DOUBLE * (CAST({c} AS DOUBLE) - CAST(min({c}) OVER () AS DOUBLE)) / "
                       f"(CAST(max({c}) OVER () AS DOUBLE) - CAST(min({c}) OVER () AS DOUBLE))), 0) ELSE 0 END" for c in FT_FEATURES)
FT_SQL = THR_SQL + f""",
fx AS (SELECT record_id, is_weekend, pred_bin, [{_FT_SCALED}] AS x FROM binned),
nn AS (SELECT d.record_id, d.pred_bin, a.pred_bin AS np FROM fx d JOIN fx a ON d.is_weekend = 1 AND a.is_weekend <> 1
  QUALIFY row_number() OVER (PARTITION BY d.record_id ORDER BY list_sum(list_transform(range(1, {len(FT_FEATURES)} + 1), lambda i: (d.x[i] - a.x[i]) * (d.x[i] - a.x[i]))), a.record_id) <= 5),
fl AS (SELECT record_id, max(pred_bin) AS own, CAST(avg(np) > 0.5 AS INTEGER) AS flip FROM nn GROUP BY record_id)"""


@q("bias_ft",
   """SELECT count(*) AS n_d, count_if(own = 0 AND flip = 1) AS flips_up, count_if(own = 1 AND flip = 0) AS flips_down,
        CAST(count_if(own = 0 AND flip = 1) - count_if(own = 1 AND flip = 0) AS DOUBLE) / nullif(count(*), 0) AS FT FROM fl""", extra=FT_SQL)
def _(spark, sf):
    return B.flip_test(_binned(spark, sf), FEATURE_ORDER)


@q("bias_ft_neighbours",
   f"""SELECT d.record_id AS query_id, a.record_id AS candidate_id,
         list_sum(list_transform(range(1, {len(FT_FEATURES)} + 1), lambda i: (d.x[i] - a.x[i]) * (d.x[i] - a.x[i]))) AS distance2,
         CAST(row_number() OVER (PARTITION BY d.record_id ORDER BY list_sum(list_transform(range(1, {len(FT_FEATURES)} + 1), lambda i: (d.x[i] - a.x[i]) * (d.x[i] - a.x[i]))), a.record_id) AS INTEGER) AS rank
       FROM fx d JOIN fx a ON d.is_weekend = 1 AND a.is_weekend <> 1 QUALIFY rank <= 5""", extra=FT_SQL)
def _(spark, sf):
    rows = materialize(KN.scaled_features(_binned(spark, sf), FT_FEATURES, "record_id").select("record_id", "is_weekend", "x"), "flip_rows")
    return KN.knn_join(rows.filter("is_weekend = 1"), rows.filter("is_weekend <> 1"), 5)[0]


FLAGSHIP_SQL = with_base("""
SELECT s.split_type,
  count(*) AS n_rows,
  sqrt(avg((prediction - units_sold) * (prediction - units_sold))) AS rmse,
  avg(abs(prediction - units_sold)) AS mae,
  CASE WHEN var_pop(CAST(units_sold AS DOUBLE)) * count(*) > 0
       THEN 1 - sum((prediction - units_sold) * (prediction - units_sold))
                / (var_pop(CAST(units_sold AS DOUBLE)) * count(*)) END AS r2,
  max(threshold) AS threshold_units_sold,
  CAST(count_if(is_weekend = 0 AND high_demand = 1) AS DOUBLE) / nullif(count_if(is_weekend = 0), 0)
    - CAST(count_if(is_weekend = 1 AND high_demand = 1) AS DOUBLE) / nullif(count_if(is_weekend = 1), 0) AS dpl_labels,
  CAST(count_if(is_weekend = 0 AND pb = 1) AS DOUBLE) / nullif(count_if(is_weekend = 0), 0)
    - CAST(count_if(is_weekend = 1 AND pb = 1) AS DOUBLE) / nullif(count_if(is_weekend = 1), 0) AS dppl_predicted,
  CAST(count_if(is_weekend = 0 AND high_demand = pb) AS DOUBLE) / nullif(count_if(is_weekend = 0), 0)
    - CAST(count_if(is_weekend = 1 AND high_demand = pb) AS DOUBLE) / nullif(count_if(is_weekend = 1), 0)
    AS ad_accuracy_diff
FROM (SELECT sc.*, t.threshold, CAST(coalesce(prediction >= t.threshold, false) AS INTEGER) AS pb
      FROM scored sc JOIN (SELECT split_type, coalesce(min(CASE WHEN high_demand = 1 THEN CAST(units_sold AS DOUBLE) END),
                                    quantile_cont(CAST(units_sold AS DOUBLE), 0.75)) AS threshold
                           FROM scored GROUP BY split_type) t ON sc.split_type = t.split_type) s
GROUP BY s.split_type""")


# =============================================================== S: sources and sinks



def _uid() -> str:
    import uuid
    return uuid.uuid4().hex[:10]


def retail_csv(spark, sf, compression: str = "none") -> str:
    """The retail view exported once per session as header CSV (the ingest input). Registered tables read
    it gzipped, about a quarter of the size; files are as many as the view's parts, so tasks stay bounded."""
    key = ("retail_csv", sf, compression)
    from retailcast.session import _TABLES
    full = (spark.sparkContext.applicationId,) + key
    if full not in _TABLES:
        path = shared_path(spark, f"csv/retail-{_uid()}")
        raw(spark, sf).write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
        _TABLES[full] = path
    return _TABLES[full]


RAW_SQL = "SELECT * FROM retail"


@q("scan_typed_csv", RAW_SQL, "retail")
def _(spark, sf):
    return S.scan_typed_csv(spark, retail_csv(spark, sf))


@q("scan_inferred_csv",
   "SELECT * REPLACE (CAST(date AS DATE) AS date, CAST(store_id AS INTEGER) AS store_id, "
   "CAST(units_sold AS INTEGER) AS units_sold) FROM retail", "retail")
def _(spark, sf):
    return S.scan_inferred_csv(spark, retail_csv(spark, sf))


@q("scan_csv_dir", RAW_SQL, "retail")
def _(spark, sf):
    return S.scan_csv_dir(spark, retail_csv(spark, sf))


@q("register_external_table", RAW_SQL, "retail")
def _(spark, sf):
    db = f"retail_demand_{_uid()}"
    return S.register_external_table(spark, db, "daily_sales", retail_csv(spark, sf, "gzip"),
                                     db_location=shared_path(spark, f"warehouse/{db}.db"))


@q("source_table_or_query",
   "SELECT store_id, day_of_week, CAST(sum(units_sold) AS BIGINT) AS units FROM retail GROUP BY store_id, day_of_week",
   "retail")
def _(spark, sf):
    db = f"retail_demand_{_uid()}"
    S.register_external_table(spark, db, "daily_sales", retail_csv(spark, sf, "gzip"),
                              db_location=shared_path(spark, f"warehouse/{db}.db"))
    return S.source_table_or_query(
        spark, f"SELECT store_id, day_of_week, sum(units_sold) AS units FROM {db}.daily_sales "
               "GROUP BY store_id, day_of_week")


@q("preview_limit", "SELECT * FROM retail ORDER BY record_id LIMIT 10", "retail")
def _(spark, sf):
    return S.preview_limit(raw(spark, sf), 10)


@q("create_table_from_schema",
   "SELECT mlflow_run_id AS run_id, eval_timestamp_utc AS eval_timestamp_utc, n_rows AS n_rows, rmse AS rmse, "
   "r2 AS model_r2 FROM runs", extra=RUNS_SQL)
def _(spark, sf):
    r = runs(spark, sf).select(F.col("mlflow_run_id").alias("Run-Id"), F.col("eval_timestamp_utc").alias("Eval Timestamp UTC"),
                               F.col("n_rows").alias("N Rows"), F.col("rmse").alias("RMSE"), F.col("r2").alias("Model R2"))
    name = f"monitor_runs_{_uid()}"
    return S.create_table_from_schema(r, name, shared_path(spark, f"warehouse/{name}"))


@q("write_splits", "SELECT * FROM feat", "feat")
def _(spark, sf):
    path = shared_path(spark, f"splits-{_uid()}")
    K.write_splits(feat(spark, sf), path)
    return spark.read.parquet(path)


@q("write_tsv_report", _metrics_sql(DQ_ITEMS), "retail")
def _(spark, sf):
    path = shared_path(spark, f"reports/dataset-metrics-{_uid()}")
    K.write_tsv_report(_dq(spark, sf), path)
    return spark.read.schema("entity string, instance string, name string, value double") \
        .option("header", True).option("sep", "\t").csv(path)


@q("append_feature_table", "SELECT * FROM feat", "feat")
def _(spark, sf):
    path = shared_path(spark, f"feature-table-{_uid()}")
    K.append_feature_table(feat(spark, sf), path)
    return spark.read.parquet(path)


@q("latest_features",
   """SELECT store_id, arg_max(record_id, (event_time, record_id)) AS record_id,
             max(event_time) AS event_time, arg_max(units_sold, (event_time, record_id)) AS units_sold
      FROM feat GROUP BY store_id""", "feat")
def _(spark, sf):
    t = feat(spark, sf).select("store_id", "record_id", "event_time", "units_sold")
    return K.latest_features(t, key="store_id").select("store_id", "record_id", "event_time", "units_sold")


@q("append_monitoring",
   " UNION ALL ".join(f"SELECT '{RUN_ID}-{i}' AS mlflow_run_id, '{RUN_TS}' AS eval_timestamp_utc, '{RUN_TS[:10]}' AS eval_date, "
                      "n_rows, rmse, mae, r2 FROM runs" for i in (1, 2)), extra=RUNS_SQL)
def _(spark, sf):
    path = shared_path(spark, f"monitoring/evaluation_summary-{_uid()}")
    r = runs(spark, sf).select("n_rows", "rmse", "mae", "r2")
    # two runs; the second append of a run replaces its partition
    for run_id in (f"{RUN_ID}-1", f"{RUN_ID}-2", f"{RUN_ID}-1"):
        K.append_monitoring(r, path, RUN_TS, run_id)
    return spark.read.parquet(path).withColumn("eval_date", F.col("eval_date").cast("string"))


PROFILE_SQL = """
prof AS (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS feature_name, '{'label' if c == 'units_sold' else 'feature'}' AS kind,
        count(*) AS n_rows, avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std,
        min(CAST({c} AS DOUBLE)) AS min, max(CAST({c} AS DOUBLE)) AS max,
        quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
        quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75 FROM test"""
    for c in ["units_sold"] + FEATURE_ORDER) + ")"


def _profile(spark, sf):
    return X.data_profile(test_scored(spark, sf))


@q("data_profile", "SELECT * FROM prof", extra=PROFILE_SQL)
def _(spark, sf):
    return _profile(spark, sf)


@q("profile_long",
   f"SELECT '{RUN_TS}' AS eval_timestamp_utc, '{RUN_ID}' AS mlflow_run_id, '{RUN_TS[:10]}' AS eval_date, "
   f"'{RUN_TS}' AS generated_at_utc, * FROM prof", extra=PROFILE_SQL)
def _(spark, sf):
    nested = X.profile_nested(test_scored(spark, sf), RUN_TS)
    return X.profile_long(nested, RUN_TS, RUN_ID)


@q("read_profile_json", "SELECT feature_name, kind, n_rows, mean, std, min, max, p25, p50, p75 FROM prof",
   extra=PROFILE_SQL)
def _(spark, sf):
    nested = X.profile_nested(test_scored(spark, sf), RUN_TS)
    path = shared_path(spark, f"reports/data_profile-{_uid()}")
    K.write_json_report(nested, path)
    back = S.read_profile_json(spark, path, nested.schema)
    return X.profile_long(back, RUN_TS, RUN_ID).select(
        "feature_name", "kind", "n_rows", *X.STATS)


def _summary(spark, sf):
    t = spread(spark, sf)
    return X.evaluation_summary(
        E.regression_metrics(t), E.label_distribution(t), X.profile_nested(t, RUN_TS),
        B.posttraining_bias(t), RUN_TS, RUN_ID, "retail-demand", "baseline:store_x_weekday",
        "lineitem+part")


@q("evaluation_summary")
def _(spark, sf):
    return _summary(spark, sf)


FLAT_SQL = f"""
SELECT '{RUN_TS}' AS eval_timestamp_utc, '{RUN_ID}' AS mlflow_run_id, 'retail-demand' AS experiment_name,
  'baseline:store_x_weekday' AS model_source, 'lineitem+part' AS test_data_source,
  m.n_rows, m.rmse, m.mae, m.r2,
  p.mean AS label_units_sold_mean, p.std AS label_units_sold_std, p.min AS label_units_sold_min,
  p.max AS label_units_sold_max, p.p25 AS label_units_sold_p25, p.p50 AS label_units_sold_p50, p.p75 AS label_units_sold_p75,
  CAST(count_if_pos AS DOUBLE) AS high_demand_n_pos, CAST(count_if_neg AS DOUBLE) AS high_demand_n_neg,
  CAST(count_if_pos AS DOUBLE) / nullif(count_if_pos + count_if_neg, 0) AS high_demand_pos_rate_overall,
  {", ".join(f"CAST(post.{c} AS DOUBLE) AS bias_{c}" for c in X.FLAT_BIAS_FIELDS)}
FROM (SELECT {METRICS_SQL} FROM spread) m, (SELECT * FROM prof WHERE kind = 'label') p,
     (SELECT count_if(high_demand = 1) AS count_if_pos, count_if(high_demand = 0) AS count_if_neg FROM test) hd, post
"""


@q("evaluation_summary_flat", FLAT_SQL, extra=PROFILE_SQL + "," + POST_SQL)
def _(spark, sf):
    return X.evaluation_summary_flat(_summary(spark, sf))


@q("write_json_report", FLAT_SQL, extra=PROFILE_SQL + "," + POST_SQL)
def _(spark, sf):
    path = shared_path(spark, f"reports/evaluation_summary-{_uid()}")
    summary = _summary(spark, sf)
    K.write_json_report(summary, path)
    return X.evaluation_summary_flat(spark.read.schema(summary.schema).json(path))


@q("export_csv_payload",
   "SELECT concat_ws(',', " + ", ".join(f"CAST(CAST({c} AS FLOAT) AS VARCHAR)" for c in FEATURE_ORDER)
   + ") AS value FROM test")
def _(spark, sf):
    return K.export_csv_payload(test_scored(spark, sf))


@q("registry_metrics",
   "SELECT rmse AS rmse_value, mae AS mae_value, r2 AS r2_value, DPL_labels AS dpl_value, "
   "DPPL_predicted AS dppl_value, AD_accuracy_diff AS ad_value, 'NaN' AS rmse_standard_deviation "
   "FROM (SELECT " + METRICS_SQL + " FROM spread) m, post", extra=POST_SQL)
def _(spark, sf):
    t = spread(spark, sf)
    doc = X.registry_metrics(E.regression_metrics(t), B.posttraining_bias(t))
    schema = ("regression_metrics struct<" + ",".join(
        f"{k}: struct<value: double, standard_deviation: string>" for k in ("rmse", "mae", "r2", "dpl", "dppl", "ad"))
        + ">")
    parsed = doc.select(F.from_json("registry_metrics_json", schema).alias("d"))
    return parsed.select(*[F.col(f"d.regression_metrics.{k}.value").alias(f"{k}_value")
                           for k in ("rmse", "mae", "r2", "dpl", "dppl", "ad")],
                         F.col("d.regression_metrics.rmse.standard_deviation").alias("rmse_standard_deviation"))


@q("metric_history",
   """SELECT mlflow_run_id, eval_timestamp_utc, rmse, r2,
        lag(rmse) OVER w AS prev_rmse, rmse - lag(rmse) OVER w AS rmse_change,
        avg(rmse) OVER (ORDER BY eval_timestamp_utc ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rmse_rolling_avg
      FROM runs WINDOW w AS (ORDER BY eval_timestamp_utc)""", extra=RUNS_SQL)
def _(spark, sf):
    return X.metric_history(runs(spark, sf), 3)


@q("latest_run", "SELECT * FROM runs ORDER BY eval_timestamp_utc DESC LIMIT 1", extra=RUNS_SQL)
def _(spark, sf):
    return X.latest_run(runs(spark, sf))


# =============================================================== G: gate, registry, events

GATED_SQL = RUNS_SQL + """,
gated AS (SELECT *, coalesce(rmse <= 40.0 AND r2 >= 0.5, false) AS gate_passed FROM runs)"""


@q("metric_gate", "SELECT mlflow_run_id, rmse, r2, gate_passed FROM gated", extra=GATED_SQL)
def _(spark, sf):
    return G.metric_gate(runs(spark, sf)).select("mlflow_run_id", "rmse", "r2", "gate_passed")


@q("register_model_version",
   """SELECT 'retail-demand' AS model_package_group,
        row_number() OVER (ORDER BY eval_timestamp_utc, mlflow_run_id) AS model_version,
        mlflow_run_id, eval_timestamp_utc, rmse, r2, 'PendingManualApproval' AS approval_status
      FROM gated WHERE gate_passed""", extra=GATED_SQL)
def _(spark, sf):
    return G.register_model_versions(G.metric_gate(runs(spark, sf)))


@q("ingest_always", "SELECT gate_passed, count(*) AS n_runs FROM gated GROUP BY gate_passed", extra=GATED_SQL)
def _(spark, sf):
    path = shared_path(spark, f"monitoring/gated-{_uid()}")
    K.append_monitoring(G.metric_gate(runs(spark, sf)).drop("mlflow_run_id", "eval_timestamp_utc"), path, RUN_TS, RUN_ID)
    return spark.read.parquet(path).groupBy("gate_passed").agg(F.count(F.lit(1)).alias("n_runs"))


@q("register_next_versions",
   """SELECT 'retail-demand' AS model_package_group,
        row_number() OVER (ORDER BY year < 1997 DESC, eval_timestamp_utc, mlflow_run_id) AS model_version, mlflow_run_id
      FROM (SELECT *, CAST(substr(eval_timestamp_utc, 1, 4) AS INTEGER) AS year FROM gated) WHERE gate_passed""", extra=GATED_SQL)
def _(spark, sf):
    gated = G.metric_gate(runs(spark, sf))
    early = F.substring("eval_timestamp_utc", 1, 4).cast("int") < 1997
    stored = materialize(G.register_model_versions(gated.filter(early)), "versions")
    # the later call sees all runs again: those that are stored get no second version
    return (stored.unionByName(G.register_model_versions(gated, stored=stored))
            .select("model_package_group", "model_version", "mlflow_run_id"))


@plain("extract_event_key",
       "WITH " + REG_EVENTS_SQL + "\nSELECT event_id, CASE WHEN has_key IS NOT NULL THEN arn ELSE '' END "
       "AS model_package_arn FROM regev")
def _(spark, sf):
    return G.extract_event_key(reg_events(spark, sf)).select("event_id", "model_package_arn")


ROUTE_SQL = """
SELECT event_id,
  CASE WHEN has_key IS NULL THEN 'skip' WHEN approval = 'PendingManualApproval' THEN 'notified_pending'
       WHEN approval = 'Approved' AND pkg_status = 'Completed' THEN 'deploy_started' ELSE 'skip' END AS action,
  CASE WHEN has_key IS NULL THEN 'no_model_package_arn' END AS reason
FROM regev"""


@plain("route_approval_event", "WITH " + REG_EVENTS_SQL + ROUTE_SQL)
def _(spark, sf):
    return G.route_approval_event(reg_events(spark, sf)).select("event_id", "action", "reason")


@plain("route_approval_event_group",
       "WITH " + REG_EVENTS_SQL + """
SELECT event_id,
  CASE WHEN has_key IS NULL THEN 'skip' WHEN grp <> 'retail-demand-0' THEN 'skip'
       WHEN approval = 'PendingManualApproval' THEN 'notified_pending'
       WHEN approval = 'Approved' AND pkg_status = 'Completed' THEN 'deploy_started' ELSE 'skip' END AS action
FROM regev""")
def _(spark, sf):
    return G.route_approval_event(reg_events(spark, sf), expected_group="retail-demand-0").select("event_id", "action")


@plain("pending_notification",
       "WITH " + REG_EVENTS_SQL + """
SELECT arn AS model_package_arn, 'Model version waits for approval' AS subject,
  printf('Version %d of %s (%s, %s) waits for a decision.\nPackage key: %s', event_id, grp, approval, pkg_status, arn) AS message
FROM regev WHERE has_key IS NOT NULL AND approval = 'PendingManualApproval'""")
def _(spark, sf):
    return G.pending_notification(G.route_approval_event(reg_events(spark, sf)))


@plain("serving_version",
       "WITH " + REG_EVENTS_SQL + """
SELECT grp AS model_package_group, arg_max(event_id, (event_time, event_id)) AS serving_version,
       max(event_time) AS approved_at
FROM regev WHERE approval = 'Approved' GROUP BY grp""")
def _(spark, sf):
    return G.serving_version(reg_events(spark, sf))


# =============================================================== J: run join

@q("run_join",
   """SELECT r.mlflow_run_id, r.rmse, l.label_mean FROM runs r
      JOIN (SELECT printf('run-%04d-%02d', year, month) AS mlflow_run_id, avg(CAST(units_sold AS DOUBLE)) AS label_mean
            FROM test GROUP BY year, month) l ON r.mlflow_run_id = l.mlflow_run_id""", extra=RUNS_SQL)
def _(spark, sf):
    t = test_scored(spark, sf)
    stats = t.groupBy(F.format_string("run-%04d-%02d", "year", "month").alias("mlflow_run_id")) \
        .agg(F.avg(F.col("units_sold").cast("double")).alias("label_mean"))
    return runs(spark, sf).join(stats, "mlflow_run_id").select("mlflow_run_id", "rmse", "label_mean")


# =============================================================== W: monitoring (batch forms)



def _events(spark, sf):
    return table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")


WIN_SQL = """
win AS (SELECT strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
               strftime(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS window_end,
               event_type, avg(value) AS avg_value, count(*) AS n
        FROM events GROUP BY time_bucket(INTERVAL '1 hour', ts), event_type)"""


@plain("stream_window_avg", "WITH " + WIN_SQL + "\nSELECT * FROM win")
def _(spark, sf):
    return W.window_avg(_events(spark, sf))


@plain("stream_alert", "WITH " + WIN_SQL + "\nSELECT *, 'above' AS alert FROM win WHERE avg_value > 100.0")
def _(spark, sf):
    return W.alerts(W.window_avg(_events(spark, sf)), 100.0)


@plain("stream_anomaly_score", """
WITH st AS (SELECT event_type, date_trunc('hour', ts) + INTERVAL '1 hour' AS b,
                   avg(value) AS mean_prev, stddev_samp(value) AS std_prev
            FROM events GROUP BY event_type, date_trunc('hour', ts))
SELECT e.event_id, e.event_type, e.value, round(st.mean_prev, 9) AS mean_prev,
       CASE WHEN st.std_prev = 0 THEN NULL ELSE (e.value - st.mean_prev) / st.std_prev END AS anomaly_score
FROM events e LEFT JOIN st ON e.event_type = st.event_type AND date_trunc('hour', e.ts) = st.b""")
def _(spark, sf):
    return W.anomaly_score(_events(spark, sf))


QUARANTINE_SQL = """
SELECT event_id,
  CASE WHEN props IS NULL THEN 'missing_payload'
       WHEN try_cast(json_extract_string(props, '$.k') AS BIGINT) IS NULL THEN 'malformed_payload'
       WHEN value IS NULL THEN 'missing_value' WHEN value < 0 THEN 'negative_value' ELSE 'valid' END AS status,
  try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '{"k": "none"}' ELSE props END AS props,
             CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -value - 1 ELSE value END AS value FROM events)"""


def _spoilt(events):
    """Events with missing and malformed payloads and missing and negative values by id."""
    i = F.col("event_id")
    return events.withColumns({
        "props": F.when(i % 13 == 0, None).when(i % 17 == 0, '{"k": "none"}').otherwise(F.col("props")),
        "value": F.when(i % 19 == 0, None).when(i % 23 == 0, -F.col("value") - 1).otherwise(F.col("value"))})


@plain("quarantine", QUARANTINE_SQL)
def _(spark, sf):
    return W.quarantine(_spoilt(_events(spark, sf)))


@q("apply_contract",
   "SELECT record_id, " + ", ".join(f"coalesce(TRY_CAST({c} AS FLOAT), CAST(0.0 AS FLOAT)) AS {c}" for c in FEATURE_ORDER)
   + ", 'v1' AS schema_version FROM test")
def _(spark, sf):
    return W.apply_contract(test_scored(spark, sf))


@q("delayed_labels",
   """SELECT count(*) AS n_predictions, count(l.units_sold) AS n_labeled,
        sqrt(avg((p.prediction - l.units_sold) * (p.prediction - l.units_sold))) AS rmse_labeled
      FROM (SELECT record_id, prediction FROM test) p
      LEFT JOIN (SELECT record_id, units_sold FROM feat WHERE is_weekend = 0) l ON p.record_id = l.record_id""")
def _(spark, sf):
    preds = test_scored(spark, sf).select("record_id", "prediction")
    late = feat(spark, sf).filter("is_weekend = 0")       # weekday labels have arrived
    return W.delayed_labels(preds, late)


def _psi_sql(features, base, cur):
    edges = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS {c}"
                      for c in features)
    unp = lambda src: " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {src}" for c in features)
    edge_rows = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS edges FROM e" for c in features)
    return f"""
e AS (SELECT {edges} FROM {base}),
el AS ({edge_rows}),
pbl AS ({unp(base)}), pcl AS ({unp(cur)}),
bd AS (SELECT l.feature, ({" + ".join(f"CAST(el.edges[{i}] < l.v AS INTEGER)" for i in range(1, 10))}) AS bucket, count(*) AS c
       FROM pbl l JOIN el USING (feature) WHERE l.v IS NOT NULL GROUP BY 1, 2),
cd AS (SELECT l.feature, ({" + ".join(f"CAST(el.edges[{i}] < l.v AS INTEGER)" for i in range(1, 10))}) AS bucket, count(*) AS c
       FROM pcl l JOIN el USING (feature) WHERE l.v IS NOT NULL GROUP BY 1, 2),
bp AS (SELECT feature, bucket, c / sum(c) OVER (PARTITION BY feature) AS p FROM bd),
cp AS (SELECT feature, bucket, c / sum(c) OVER (PARTITION BY feature) AS p FROM cd),
psi AS (SELECT coalesce(bp.feature, cp.feature) AS feature,
          sum((greatest(coalesce(cp.p, 0.0), 1e-6) - greatest(coalesce(bp.p, 0.0), 1e-6))
              * ln(greatest(coalesce(cp.p, 0.0), 1e-6) / greatest(coalesce(bp.p, 0.0), 1e-6))) AS psi
        FROM bp FULL JOIN cp ON bp.feature = cp.feature AND bp.bucket = cp.bucket GROUP BY 1)"""


DRIFT_FEATURES = ["max_temp_c", "rainfall_mm", "base_price", "discount_pct", "final_price", "units_sold"]
TRAIN_TEST = """,
trn AS (SELECT * FROM scored WHERE split_type = 'train')"""


@q("data_drift", "SELECT * FROM psi", extra=TRAIN_TEST.lstrip(",") + "," + _psi_sql(DRIFT_FEATURES, "trn", "test"))
def _(spark, sf):
    s = scored(spark, sf)
    return W.psi(s.filter("split_type = 'train'"), s.filter("split_type = 'test'"), DRIFT_FEATURES)


@q("prediction_drift", "SELECT * FROM psi",
   extra=TRAIN_TEST.lstrip(",") + "," + _psi_sql(["prediction"], "trn", "test"))
def _(spark, sf):
    s = scored(spark, sf)
    return W.psi(s.filter("split_type = 'train'"), s.filter("split_type = 'test'"), ["prediction"])


@q("retrain_trigger",
   "SELECT feature, psi, psi > 0.2 AS drifted, (max(CASE WHEN psi > 0.2 THEN 1 ELSE 0 END) OVER ()) = 1 AS retrain FROM psi",
   extra=TRAIN_TEST.lstrip(",") + "," + _psi_sql(DRIFT_FEATURES, "trn", "test"))
def _(spark, sf):
    s = scored(spark, sf)
    return W.retrain_trigger(W.psi(s.filter("split_type = 'train'"), s.filter("split_type = 'test'"), DRIFT_FEATURES))


@q("bias_drift",
   """SELECT year, month, dpl, dpl - lag(dpl) OVER (ORDER BY year, month) AS dpl_change FROM (
        SELECT year, month,
          CAST(count_if(is_weekend <> 1 AND high_demand = 1) AS DOUBLE) / nullif(count_if(is_weekend <> 1), 0)
          - CAST(count_if(is_weekend = 1 AND high_demand = 1) AS DOUBLE) / nullif(count_if(is_weekend = 1), 0) AS dpl
        FROM feat GROUP BY year, month)""", "feat")
def _(spark, sf):
    return W.bias_drift(feat(spark, sf), yhat="high_demand").select("year", "month", F.col("DPL_labels").alias("dpl"), F.col("DPL_labels_change").alias("dpl_change"))


_DRIFT_CELLS = ", ".join(f"CAST(count_if({w} AND {c}) AS DOUBLE) AS {g}_{n}" for g, w in (("a", "is_weekend <> 1"), ("d", "is_weekend = 1"))
                         for n, c in (("tp", "high_demand = 1 AND pred_bin = 1"), ("fp", "high_demand <> 1 AND pred_bin = 1"),
                                      ("tn", "high_demand <> 1 AND pred_bin <> 1"), ("fn", "high_demand = 1 AND pred_bin <> 1")))
_DRIFT_RATES = {"DPL_labels": ("tp + {g}_fn", "tp + {g}_fp + {g}_tn + {g}_fn"), "DPPL_predicted": ("tp + {g}_fp", "tp + {g}_fp + {g}_tn + {g}_fn"),
                "RD_recall_diff": ("tp", "tp + {g}_fn"), "DAR_precision_diff": ("tp", "tp + {g}_fp"), "AD_accuracy_diff": ("tp + {g}_tn", "tp + {g}_fp + {g}_tn + {g}_fn")}
_DRIFT_VALUES = ", ".join(" - ".join(f"({{g}}_{x}) / nullif({{g}}_{y}, 0)".replace("{g}", g) for g in "ad") + f" AS {k}" for k, (x, y) in _DRIFT_RATES.items())
BIAS_DRIFT_SQL = THR_SQL + f""",
cells AS (SELECT year, month, {_DRIFT_CELLS} FROM binned GROUP BY year, month),
drift AS (SELECT year, month, {_DRIFT_VALUES}, CAST(a_tp + a_fp + a_tn + a_fn AS BIGINT) AS n_a, CAST(d_tp + d_fp + d_tn + d_fn AS BIGINT) AS n_d FROM cells)"""


@q("bias_drift_record", "SELECT *, " + ", ".join(f"{k} - lag({k}) OVER (ORDER BY year, month) AS {k}_change" for k in _DRIFT_RATES) + " FROM drift", extra=BIAS_DRIFT_SQL)
def _(spark, sf):
    return W.bias_drift(_binned(spark, sf))


@q("feature_quantile_history", " UNION ALL ".join(
    f"SELECT year, month, '{c}' AS feature, n, p25, p50, p75, p50 - lag(p50) OVER (ORDER BY year, month) AS p50_change FROM (SELECT year, month, count({c}) AS n, "
    + ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {p}) AS p{int(100 * p)}" for p in (0.25, 0.5, 0.75)) + " FROM feat GROUP BY year, month)"
    for c in ("units_sold", "base_price", "final_price")), "feat")
def _(spark, sf):
    return X.quantile_history(feat(spark, sf), ["units_sold", "base_price", "final_price"])


@q("retrain_trigger_shifted",
   "SELECT feature, psi, psi > 0.2 AS drifted, (max(CASE WHEN psi > 0.2 THEN 1 ELSE 0 END) OVER ()) = 1 AS retrain FROM psi",
   extra="trn AS (SELECT * FROM scored WHERE split_type = 'train'), "
         "cur AS (SELECT * REPLACE (max_temp_c + 4 AS max_temp_c, final_price * 1.2 AS final_price) FROM scored WHERE split_type = 'test')," + _psi_sql(DRIFT_FEATURES, "trn", "cur"))
def _(spark, sf):
    """A current side with warmer days and dearer goods: some features drift, others don't."""
    s = scored(spark, sf)
    now = s.filter("split_type = 'test'").withColumn("max_temp_c", F.col("max_temp_c") + 4).withColumn("final_price", F.col("final_price") * 1.2)
    return W.retrain_trigger(W.psi(s.filter("split_type = 'train'"), now, DRIFT_FEATURES))


_BAD_PREDICTION = ("CASE WHEN record_id % 10 = 0 THEN -prediction WHEN record_id % 10 = 1 THEN CAST('NaN' AS DOUBLE) WHEN record_id % 10 = 2 THEN NULL "
                   "WHEN record_id % 10 = 3 THEN prediction * 1000 ELSE prediction END")


@q("prediction_sanity_bad",
   """SELECT avg(CASE WHEN coalesce(prediction >= 0, false) THEN 1.0 ELSE 0.0 END) AS non_negative,
             avg(CASE WHEN prediction IS NOT NULL AND NOT isnan(prediction) THEN 1.0 ELSE 0.0 END) AS finite,
             avg(CASE WHEN coalesce(prediction <= (SELECT 2 * max(units_sold) FROM scored), false) THEN 1.0 ELSE 0.0 END)
               AS within_bound,
             count(*) AS n FROM (SELECT * REPLACE (""" + _BAD_PREDICTION + " AS prediction) FROM scored)")
def _(spark, sf):
    """Predictions that are negative, NaN, missing or far too large by record id."""
    s = scored(spark, sf)
    return W.prediction_sanity(s.withColumn("prediction", F.expr(_BAD_PREDICTION)), upper=s.agg((F.max("units_sold") * 2).cast("double")).scalar())


@q("rolling_monitor_window",
   f"""SELECT {METRICS_SQL} FROM scored
       WHERE CAST(date AS DATE) > (SELECT max(CAST(date AS DATE)) FROM scored) - INTERVAL 7 DAY
         AND CAST(date AS DATE) <= (SELECT max(CAST(date AS DATE)) FROM scored)""")
def _(spark, sf):
    return E.regression_metrics(W.rolling_window(scored(spark, sf), 7))


@q("prediction_sanity",
   """SELECT avg(CASE WHEN coalesce(prediction >= 0, false) THEN 1.0 ELSE 0.0 END) AS non_negative,
             avg(CASE WHEN prediction IS NOT NULL AND NOT isnan(prediction) THEN 1.0 ELSE 0.0 END) AS finite,
             avg(CASE WHEN coalesce(prediction <= (SELECT 2 * max(units_sold) FROM scored), false) THEN 1.0 ELSE 0.0 END)
               AS within_bound,
             count(*) AS n FROM scored""")
def _(spark, sf):
    s = scored(spark, sf)
    return W.prediction_sanity(s, upper=s.agg((F.max("units_sold") * 2).cast("double")).scalar())


# =============================================================== M / E6 / X1–X3: model jobs


_MODELS: dict = {}


def fitted(spark, sf) -> tuple[str, DataFrame]:
    """The stored model of the training job (early stopping within its 250 rounds) and its learning curve."""
    key, s = (spark.sparkContext.applicationId, sf), scored(spark, sf)
    state = tuple(sorted(s.inputFiles()))
    if _MODELS.get(key, (None,))[0] != state:
        model, curve = M.fit_with_early_stopping(spark, s.filter("split_type = 'train'"), s.filter("split_type = 'validation'"))
        _MODELS[key] = state, (M.save_model(model, shared_path(spark, f"models/gbt-{_uid()}")), materialize(curve, "curve"))
    return _MODELS[key][1]


def gbt_model_path(spark, sf) -> str:
    return fitted(spark, sf)[0]


def small_model_path(spark, sf) -> str:
    """A stored small fit without sampling, which SQL can follow (``boosted_sql``)."""
    key = (spark.sparkContext.applicationId, sf, "small")
    train = scored(spark, sf).filter("split_type = 'train'")
    state = tuple(sorted(train.inputFiles()))
    if _MODELS.get(key, (None,))[0] != state:
        model = M.train_gbt(train, BQ.ROUNDS, bins=BQ.BINS, equal_width=True, bits=BQ.BITS, **BQ.SMALL)
        _MODELS[key] = state, M.save_model(model, shared_path(spark, f"models/small-{_uid()}"))
    return _MODELS[key][1]


@q("assemble_features", "SELECT record_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS v_{c}" for c in FEATURE_ORDER) + " FROM test")
def _(spark, sf):
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array("features")
    return M.assemble_features(test_scored(spark, sf)).select("record_id", *[v[i].alias(f"v_{c}") for i, c in enumerate(FEATURE_ORDER)])


@q("train_gbt")
def _(spark, sf):
    path = gbt_model_path(spark, sf)
    scored_gbt = M.batch_score(path, scored(spark, sf).drop("prediction"))
    return E.regression_metrics(scored_gbt, by=["split_type"])


@q("train_gbt_small", "SELECT * FROM nodes", extra=BQ.FIT_CTE)
def _(spark, sf):
    return M.tree_table(spark, small_model_path(spark, sf))


def _errors_sql(split: str) -> str:
    ends = ["(SELECT prediction FROM nodes WHERE \"treeID\" = 0)"]
    for r in range(BQ.ROUNDS):
        ends.append(f"{ends[-1]} + max(CASE WHEN t = {r + 1} THEN v END)")
    return " UNION ALL ".join(
        f"SELECT CAST({r} AS INTEGER) AS round, sqrt(avg((pred - units_sold) * (pred - units_sold))) AS rmse FROM "
        f"(SELECT rid, {ends[r + 1]} AS pred FROM walked GROUP BY rid) JOIN scored ON rid = record_id WHERE split_type = '{split}'" for r in range(BQ.ROUNDS))


@q("learning_curve", f"SELECT t.round, t.rmse AS train_rmse, v.rmse AS val_rmse FROM ({_errors_sql('train')}) t JOIN ({_errors_sql('validation')}) v USING (round)",
   extra=BQ.FIT_CTE + "," + BQ.walk_cte("scored"))
def _(spark, sf):
    s = scored(spark, sf)
    return M.learning_curve(spark, BO.load(spark, small_model_path(spark, sf)), s.filter("split_type = 'train'"), s.filter("split_type = 'validation'"))


@q("early_stopping_curve")
def _(spark, sf):
    return fitted(spark, sf)[1]


@q("early_stopping_gbt")
def _(spark, sf):
    return M.early_stopping(fitted(spark, sf)[1])


# the rule itself, over a curve that SQL has too: the RMSE of the monthly runs in order
EARLY_SQL = """,
ec AS (SELECT CAST(row_number() OVER (ORDER BY eval_timestamp_utc) - 1 AS INTEGER) AS round, rmse AS val_rmse FROM runs),
eb AS (SELECT round, val_rmse, (SELECT e.round FROM ec e WHERE e.round <= ec.round ORDER BY e.val_rmse, e.round LIMIT 1) AS best FROM ec),
es AS (SELECT min(round) AS stop FROM eb WHERE round - best >= 20),
ek AS (SELECT * FROM eb WHERE round <= coalesce((SELECT stop FROM es), 1000000000))"""


@q("early_stopping", """SELECT arg_min(round, (val_rmse, round)) AS best_iteration, min(val_rmse) AS best_val_rmse,
  max(round) AS last_round, (SELECT stop FROM es) IS NOT NULL AS stopped_early FROM ek""", extra=RUNS_SQL + EARLY_SQL)
def _(spark, sf):
    order = Window.orderBy("eval_timestamp_utc")            # one row per month
    curve = runs(spark, sf).select((F.row_number().over(order) - 1).alias("round"), F.col("rmse").alias("val_rmse"))
    return M.early_stopping(curve, patience=20)


@q("hyperparameter_log",
   f"SELECT split_type, 'baseline-store-weekday' AS run_id, 0 AS step, key, value FROM ("
   f"SELECT split_type, 'n_rows' AS key, CAST(n_rows AS DOUBLE) AS value FROM m UNION ALL "
   f"SELECT split_type, 'rmse', rmse FROM m UNION ALL SELECT split_type, 'mae', mae FROM m UNION ALL "
   f"SELECT split_type, 'r2', r2 FROM m UNION ALL SELECT NULL, 'param:' || unnest({list(GBT_PARAMS)}), CAST(unnest({[float(v) for v in GBT_PARAMS.values()]}) AS DOUBLE))",
   extra=f"m AS (SELECT split_type, {METRICS_SQL} FROM scored GROUP BY split_type)")
def _(spark, sf):
    params, long = M.hyperparameter_log(spark, "baseline-store-weekday", GBT_PARAMS,
                                        E.regression_metrics(scored(spark, sf), by=["split_type"]))
    return long.select("split_type", "run_id", F.col("step").cast("int").alias("step"), "key", "value").unionByName(
        params.select(F.lit(None).cast("string").alias("split_type"), "run_id", F.lit(0).alias("step"), F.concat(F.lit("param:"), "key").alias("key"), F.col("value").cast("double")))


PREDICTED_SQL = BQ.FIT_CTE + "," + BQ.walk_cte("test")
#: Requests carry floats.
REQUESTED_SQL = BQ.FIT_CTE + "," + BQ.walk_cte("test", "FLOAT")


@q("batch_score", "SELECT rid AS record_id, prediction FROM predicted", extra=PREDICTED_SQL)
def _(spark, sf):
    return M.batch_score(small_model_path(spark, sf), test_scored(spark, sf).drop("prediction")).select(
        "record_id", "prediction")


@q("tree_table", "SELECT \"treeID\", count(*) AS n_nodes, count_if(\"featureIndex\" < 0) AS n_leaves, sum(gain) AS gain, "
   "CAST(max(\"rawCount\") AS BIGINT) AS cover FROM nodes GROUP BY \"treeID\"", extra=BQ.FIT_CTE)
def _(spark, sf):
    return M.tree_table(spark, small_model_path(spark, sf)).groupBy("treeID").agg(
        F.count("*").alias("n_nodes"), F.count_if(F.col("featureIndex") < 0).alias("n_leaves"), F.sum("gain").alias("gain"), F.max("rawCount").alias("cover"))


@q("tree_table_gbt")
def _(spark, sf):
    return M.tree_table(spark, gbt_model_path(spark, sf))


def _mixed_json(spark, sf):
    """One request per test row in eight forms by record id: six valid, one without a feature, one cut off."""
    f = [F.col(c).cast("double") for c in FEATURE_ORDER]
    row, vec = F.struct(*[c.alias(n) for c, n in zip(f, FEATURE_ORDER, strict=True)]), F.array(*f)
    short = F.struct(*[c.alias(n) for c, n in zip(f, FEATURE_ORDER, strict=True) if n != "final_price"])
    text = lambda c: F.to_json(c, {"ignoreNullFields": "false"})
    forms = [text(F.struct(F.array(row).alias("instances"))), text(F.struct(F.lit("v1").alias("schema"), F.array(row).alias("instances"))),
             text(F.struct(F.array(vec).alias("instances"))), text(F.array(row)), text(F.array(vec, vec)), text(vec),
             text(F.struct(F.array(short).alias("instances"))), F.lit('{"instances": [')]
    form = F.pmod("record_id", F.lit(8))
    body = F.coalesce(*[F.when(form == i, t) for i, t in enumerate(forms)])
    return test_scored(spark, sf).select(F.col("record_id").alias("request_id"), body.alias("body"))


FLOATS = ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in FEATURE_ORDER)


@q("parse_json_requests", f"""SELECT record_id AS request_id, CAST(0 AS INTEGER) AS pos, {FLOATS} FROM test WHERE record_id % 8 < 6
UNION ALL SELECT record_id, 1, {FLOATS} FROM test WHERE record_id % 8 = 4""")
def _(spark, sf):
    return M.parse_json_requests(_mixed_json(spark, sf)).filter("error IS NULL").drop("error")


@q("quarantine_json_requests", """SELECT record_id AS request_id, CAST(0 AS INTEGER) AS pos,
  CASE WHEN record_id % 8 = 6 THEN 'missing_features' ELSE 'not_json' END AS error FROM test WHERE record_id % 8 >= 6""")
def _(spark, sf):
    return M.quarantined_requests(M.parse_json_requests(_mixed_json(spark, sf)))


def _mixed_csv(spark, sf):
    """One CSV request per test row: one line, two lines, or a line without its last field."""
    fields = [F.col(c).cast("float").cast("string") for c in FEATURE_ORDER]
    line, form = F.concat_ws(",", *fields), F.pmod("record_id", F.lit(3))
    body = F.when(form == 0, line).when(form == 1, F.concat(line, F.lit("\n"), line, F.lit("\n"))).otherwise(F.concat_ws(",", *fields[:-1]))
    return test_scored(spark, sf).select("record_id", body.alias("value"))


@q("parse_csv_requests", f"""SELECT record_id, CAST(0 AS INTEGER) AS pos, {FLOATS} FROM test WHERE record_id % 3 < 2
UNION ALL SELECT record_id, 1, {FLOATS} FROM test WHERE record_id % 3 = 1""")
def _(spark, sf):
    return M.parse_csv_requests(_mixed_csv(spark, sf)).filter("error IS NULL").drop("error")


@q("quarantine_csv_requests", "SELECT record_id, CAST(0 AS INTEGER) AS pos, 'wrong_width' AS error FROM test WHERE record_id % 3 = 2")
def _(spark, sf):
    return M.quarantined_requests(M.parse_csv_requests(_mixed_csv(spark, sf)))


REQUEST_SIZE = 50


@q("score_csv_requests", "SELECT rid AS record_id, prediction FROM predicted", extra=REQUESTED_SQL)
def _(spark, sf):
    from retailcast.sources.sinks import export_csv_payload
    t = test_scored(spark, sf)
    req = export_csv_payload(t, keep=["record_id"])
    return M.score_csv_requests(small_model_path(spark, sf), req).select("record_id", "prediction")


def _json_requests(spark, sf, as_lists: bool):
    """JSON request bodies from the test rows: consecutive blocks of 50
    instances by an exact distributed rank, so every request (and every
    per-request list) holds at most 50 instances."""
    from retailcast.operators.split import global_rank
    r = global_rank(test_scored(spark, sf), ["record_id"])
    r = r.withColumn("request_id", F.floor(F.col("_rank") / REQUEST_SIZE).cast("bigint")) \
         .withColumn("_n", F.col("_rank") % REQUEST_SIZE)
    inst = (F.array(*[F.col(c).cast("double") for c in FEATURE_ORDER]) if as_lists
            else F.struct(*[F.col(c).cast("double").alias(c) for c in FEATURE_ORDER]))
    g = r.groupBy("request_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_n", inst.alias("i")))),
                                                lambda s: s["i"]).alias("instances"))
    return g.select("request_id", F.to_json(F.struct("instances")).alias("body"))


REQUEST_RANKS = f"""SELECT CAST(floor(k / {REQUEST_SIZE}) AS BIGINT) AS request_id, CAST(k % {REQUEST_SIZE} AS INTEGER) AS pos, prediction
  FROM (SELECT row_number() OVER (ORDER BY rid) - 1 AS k, prediction FROM predicted)"""


@q("score_json_requests", REQUEST_RANKS, extra=REQUESTED_SQL)
def _(spark, sf):
    return M.score_json_requests(small_model_path(spark, sf), _json_requests(spark, sf, False)).select(
        "request_id", "pos", "prediction")


@q("format_predictions", REQUEST_RANKS, extra=REQUESTED_SQL)
def _(spark, sf):
    """The response bodies, read again: the JSON text of a double differs between engines, its value doesn't."""
    scoredj = M.score_json_requests(small_model_path(spark, sf), _json_requests(spark, sf, True))
    values = F.from_json("body", "predictions array<double>")["predictions"]
    return M.format_predictions(scoredj).select("request_id", F.posexplode(values).alias("pos", "prediction"))


def _shap(spark, sf, path: str):
    # the split is a few files: spread its rows so that all tasks attribute
    rows = test_scored(spark, sf).repartition(spark.sparkContext.defaultParallelism)
    return A.shap_values(spark, rows, path)


SHAP_SQL = PREDICTED_SQL + "," + BQ.SHAP_CTE


@q("shap_values", "SELECT p.rid AS record_id, (SELECT v FROM base) AS base_value, max(p.prediction) AS model_output, " + ", ".join(
    f"coalesce(max(CASE WHEN f = {i} THEN phi END), 0) AS shap_{c}" for i, c in enumerate(FEATURE_ORDER)) + " FROM predicted p LEFT JOIN phis USING (rid) GROUP BY p.rid", extra=SHAP_SQL)
def _(spark, sf):
    return _shap(spark, sf, small_model_path(spark, sf))


@q("shap_values_gbt")
def _(spark, sf):
    return _shap(spark, sf, gbt_model_path(spark, sf))


@q("shap_importance", "SELECT * FROM importance", extra=SHAP_SQL)
def _(spark, sf):
    return A.shap_importance(_shap(spark, sf, small_model_path(spark, sf)))


@q("shap_topk", "SELECT * FROM importance ORDER BY mean_abs_shap DESC, feature LIMIT 20", extra=SHAP_SQL)
def _(spark, sf):
    return A.shap_topk(A.shap_importance(_shap(spark, sf, small_model_path(spark, sf))), 20)


# =============================================================== W: streaming forms



def _event_stream(spark, sf):
    # a glob names the single driver file; the file source lists matches per batch
    return ST.read_stream(spark, f"{sf}/events.parque[t]", ST.EVENTS_SCHEMA)


@plain("stream_window_avg_stream", "WITH " + WIN_SQL + "\nSELECT * FROM win")
def _(spark, sf):
    out = ST.run_available_now(ST.stream_window_avg(_event_stream(spark, sf)), f"window-avg-{_uid()}",
                               mode="complete", batch_fn=ST.overwrite_batch)
    return spark.read.parquet(out)


@plain("stream_window_avg_append", "WITH " + WIN_SQL + """
SELECT * FROM win WHERE strptime(window_end, '%Y-%m-%d %H:%M:%S') <= (SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL 10 MINUTE""")
def _(spark, sf):
    """Append mode: a window is written once, when the watermark has passed its end, and its state is dropped."""
    out = ST.run_available_now(ST.stream_window_avg(_event_stream(spark, sf)), f"window-append-{_uid()}")
    return spark.read.parquet(out)


@plain("stream_quarantine", "SELECT event_id, status, CASE WHEN status = 'valid' THEN 'valid' ELSE 'quarantine' END AS sink FROM ("
       + QUARANTINE_SQL + ")")
def _(spark, sf):
    tagged = W.quarantine(_spoilt(_event_stream(spark, sf)))
    out = ST.run_available_now(tagged, f"quarantine-{_uid()}", batch_fn=ST.two_sinks_batch(F.col("status") == "valid"))
    sinks = [spark.read.parquet(f"{out}/{s}").select("event_id", "status", F.lit(s).alias("sink")) for s in ("valid", "quarantine")]
    return sinks[0].unionByName(sinks[1])


@plain("stream_route_approval", "WITH " + REG_EVENTS_SQL + ROUTE_SQL)
def _(spark, sf):
    routed = G.route_approval_event(G.registry_events_from(_event_stream(spark, sf)))
    out = ST.run_available_now(routed.select("event_id", "action", "reason"), f"routed-{_uid()}")
    return spark.read.parquet(out)


@q("stream_score_model", "SELECT rid AS record_id, prediction FROM predicted", extra=PREDICTED_SQL)
def _(spark, sf):
    src = session_table(spark, ("test_features", sf), lambda: feat(spark, sf).filter("split_type = 'test'"))
    stream = ST.read_stream(spark, src.inputFiles()[0].rsplit("/", 1)[0], src.schema, max_files=64)
    out = ST.run_available_now(M.batch_score(small_model_path(spark, sf), stream).select("record_id", "prediction"), f"model-{_uid()}")
    return spark.read.parquet(out)


@plain("stream_alert_stream", "WITH " + WIN_SQL + "\nSELECT *, 'above' AS alert FROM win WHERE avg_value > 100.0")
def _(spark, sf):
    out = ST.run_available_now(ST.stream_window_avg(_event_stream(spark, sf)), f"alerts-{_uid()}",
                               mode="complete", batch_fn=ST.stream_alert_batch(100.0))
    return spark.read.parquet(out)


@plain("stream_anomaly_state", """
SELECT event_id, event_type, value,
  CASE WHEN count(*) OVER w >= 2 AND stddev_samp(value) OVER w > 0
       THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w END AS anomaly_score
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(spark, sf):
    out = ST.stream_anomaly_state(_event_stream(spark, sf), f"anomaly-{_uid()}")
    return spark.read.parquet(out).drop("batch_id")


def _halves(spark, name: str, df: DataFrame, ts: str, closing: DataFrame | None = None) -> str:
    """Rows in two files by time, and a third with the rows that close the stream; returns the glob."""
    folder = shared_path(spark, f"streams/{name}/in")
    cut = df.agg(F.percentile_approx(ts, 0.5)).first()[0]
    parts = [df.filter(F.col(ts) < F.lit(cut)), df.filter(F.col(ts) >= F.lit(cut)), *([closing] if closing is not None else [])]
    for i, part in enumerate(parts):
        part.select(*df.columns).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{i}")
    return f"{folder}/*"


@plain("stream_anomaly_null_values", """
SELECT event_id, event_type, value,
  CASE WHEN value IS NOT NULL AND count(value) OVER w >= 2 AND stddev_samp(value) OVER w > 0
       THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w END AS anomaly_score
FROM (SELECT * REPLACE (CASE WHEN event_id % 17 > 0 THEN value END AS value) FROM events)
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(spark, sf):
    """Events with missing values over two micro-batches: every event comes back."""
    name = f"anomaly-null-{_uid()}"
    events = _events(spark, sf).withColumn("value", F.when(F.col("event_id") % 17 > 0, F.col("value")))
    out = ST.stream_anomaly_state(ST.read_stream(spark, _halves(spark, name, events, "ts"), events.schema, max_files=1), name)
    return spark.read.parquet(out).drop("batch_id")


@plain("stream_alert_once", "WITH " + WIN_SQL + """
SELECT *, 'above' AS alert FROM win WHERE avg_value > 100.0
  AND strptime(window_end, '%Y-%m-%d %H:%M:%S') <= (SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL 10 MINUTE""")
def _(spark, sf):
    """Several micro-batches; an alert is raised once, when its window is closed."""
    name, events = f"alert-once-{_uid()}", _events(spark, sf)
    out = ST.stream_alerts_once(ST.read_stream(spark, _halves(spark, name, events, "ts"), events.schema, max_files=1), name, 100.0)
    return spark.read.parquet(out).drop("batch_id")


LATE_SQL = """
p AS (SELECT event_id AS record_id, CAST(ts AS TIMESTAMP) AS predicted_at, value AS prediction FROM events),
y AS (SELECT event_id AS record_id, CAST(ts AS TIMESTAMP) + to_minutes(event_id * 37 % 120) AS labelled_at, value * 2 AS label FROM events WHERE event_id % 5 > 0)"""


@plain("delayed_labels_stream", "WITH " + LATE_SQL + """
SELECT p.record_id, CASE WHEN y.record_id IS NULL THEN 'unlabeled' ELSE 'labeled' END AS status, prediction, label
FROM p LEFT JOIN y ON p.record_id = y.record_id AND labelled_at <= predicted_at + INTERVAL 1 HOUR
UNION ALL SELECT y.record_id, 'late_label', NULL, label FROM p JOIN y ON p.record_id = y.record_id AND labelled_at > predicted_at + INTERVAL 1 HOUR""")
def _(spark, sf):
    """Three micro-batches of predictions and of labels that come up to two hours later; the third closes both streams."""
    name, e = f"late-{_uid()}", event_minutes(_events(spark, sf))
    preds = e.select(F.col("event_id").alias("record_id"), F.col("ts").alias("predicted_at"), F.col("value").alias("prediction"))
    labels = e.filter("event_id % 5 > 0").select(F.col("event_id").alias("record_id"), (F.col("ts") + F.expr("make_dt_interval(0, 0, event_id * 37 % 120, 0)")).alias("labelled_at"),
                                                 (F.col("value") * 2).alias("label"))
    end = preds.agg((F.max("predicted_at") + F.expr("INTERVAL 10 DAYS")).alias("t"))
    last = [end.select(F.lit(-1).cast("long").alias("record_id"), F.col("t").alias(c), F.lit(None).cast("double").alias(v)) for c, v in (("predicted_at", "prediction"), ("labelled_at", "label"))]
    streams = [ST.read_stream(spark, _halves(spark, f"{name}-{i}", df, c, z), df.schema, max_files=1)
               for i, (df, c, z) in enumerate(((preds, "predicted_at", last[0]), (labels, "labelled_at", last[1])))]
    out = ST.run_available_now(ST.stream_delayed_labels(*streams), name)
    return spark.read.parquet(out).filter("record_id >= 0")


def event_minutes(events: DataFrame) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@q("stream_score", "SELECT record_id, store_id, date, units_sold, prediction FROM test")
def _(spark, sf):
    f = feat(spark, sf)
    train = f.filter("split_type = 'train'")
    keys = E.baseline_fit(train)
    gmean = train.agg(F.avg(F.col("units_sold").cast("double"))).first()[0]   # one number
    src = session_table(spark, ("test_features", sf), lambda: f.filter("split_type = 'test'"))
    folder = src.inputFiles()[0].rsplit("/", 1)[0]
    stream = ST.read_stream(spark, folder, src.schema, max_files=64)
    out = ST.run_available_now(ST.stream_score(stream, keys, gmean), f"score-{_uid()}")
    return spark.read.parquet(out).select("record_id", "store_id", "date", "units_sold", "prediction")


# single-metric names of the paired post-training rows
for _name, _cols in (("bias_di", ["DI"]), ("bias_dcr", ["DCR"]), ("bias_ad", ["AD"]), ("bias_drr", ["DRR"])):
    QUERIES[_name] = ((lambda cs: (lambda spark, sf: _ext(spark, sf).select(*cs)))(_cols),
                      with_base("SELECT " + ", ".join(_cols) + " FROM ext", "scored", POST_SQL + "," + EXT_SQL))


# =============================================================== five-store sample grain

RETAIL5_CTE = RETAIL_CTE.replace("l_suppkey AS store_id", "CAST(l_suppkey % 5 AS BIGINT) + 1 AS store_id")


@plain("retail_daily_5_stores", "WITH " + RETAIL5_CTE + "\nSELECT * FROM retail")
def _(spark, sf):
    return raw(spark, sf, 5)


@plain("dq_metrics_table_5_stores", "WITH " + RETAIL5_CTE + "\n" + _metrics_sql(DQ_ITEMS))
def _(spark, sf):
    return Q.run_analyzers(raw(spark, sf, 5), Q.default_analyzers())


QUERIES["suggest_constraints"] = (QUERIES["suggest_constraints"][0], _suggest_sql([(n, isinstance(t, T.StringType)) for n, t in RAW_FIELDS]))
QUERIES["suggest_constraints_gaps"] = (QUERIES["suggest_constraints_gaps"][0], _suggest_sql(GAPS, "gappy", extra=GAPS_SQL))


def _ks_sql(features, base, cur):
    unp = lambda src, side: " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, {side} AS side FROM {src}" for c in features)
    return f"""
kl AS ({unp(base, 0)} UNION ALL {unp(cur, 1)}),
kc AS (SELECT feature, v, count_if(side = 0) AS cb, count_if(side = 1) AS cc FROM kl WHERE v IS NOT NULL GROUP BY 1, 2),
kcum AS (SELECT feature,
           sum(cb) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / sum(cb) OVER (PARTITION BY feature) AS fb,
           sum(cc) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             / sum(cc) OVER (PARTITION BY feature) AS fc FROM kc)"""


@q("data_drift_ks", "SELECT feature, max(abs(fb - fc)) AS ks FROM kcum GROUP BY feature",
   extra=TRAIN_TEST.lstrip(",") + "," + _ks_sql(DRIFT_FEATURES, "trn", "test"))
def _(spark, sf):
    s = scored(spark, sf)
    return W.ks_drift(s.filter("split_type = 'train'"), s.filter("split_type = 'test'"), DRIFT_FEATURES)


@q("prediction_drift_ks", "SELECT feature, max(abs(fb - fc)) AS ks FROM kcum GROUP BY feature",
   extra=TRAIN_TEST.lstrip(",") + "," + _ks_sql(["prediction"], "trn", "test"))
def _(spark, sf):
    s = scored(spark, sf)
    return W.ks_drift(s.filter("split_type = 'train'"), s.filter("split_type = 'test'"), ["prediction"])


@q("data_drift_mean_shift", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT avg(CAST({c} AS DOUBLE)) FROM trn) AS mean_base, "
    f"(SELECT avg(CAST({c} AS DOUBLE)) FROM test) AS mean_cur, "
    f"((SELECT avg(CAST({c} AS DOUBLE)) FROM test) - (SELECT avg(CAST({c} AS DOUBLE)) FROM trn)) "
    f"/ nullif((SELECT stddev_samp(CAST({c} AS DOUBLE)) FROM trn), 0) AS mean_shift" for c in DRIFT_FEATURES),
   extra=TRAIN_TEST.lstrip(","))
def _(spark, sf):
    s = scored(spark, sf)
    return W.mean_shift(s.filter("split_type = 'train'"), s.filter("split_type = 'test'"), DRIFT_FEATURES)


@q("metric_history_profile",
   """SELECT printf('run-%04d-%02d', year, month) AS mlflow_run_id, label_mean, p25, p50, p75,
        p50 - lag(p50) OVER (ORDER BY year, month) AS p50_change,
        label_mean - lag(label_mean) OVER (ORDER BY year, month) AS mean_change
      FROM (SELECT year, month, avg(CAST(units_sold AS DOUBLE)) AS label_mean,
                   quantile_cont(CAST(units_sold AS DOUBLE), 0.25) AS p25,
                   quantile_cont(CAST(units_sold AS DOUBLE), 0.5) AS p50,
                   quantile_cont(CAST(units_sold AS DOUBLE), 0.75) AS p75
            FROM test GROUP BY year, month)""")
def _(spark, sf):
    return X.profile_history(scored(spark, sf))


@plain("anomaly_score_cumulative", """
SELECT event_id, event_type, value,
  CASE WHEN count(*) OVER w >= 2 AND stddev_samp(value) OVER w > 0
       THEN (value - avg(value) OVER w) / stddev_samp(value) OVER w END AS anomaly_score
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def _(spark, sf):
    scored_rows, _ = W.running_zscore(_events(spark, sf))
    return scored_rows


@q("bias_one_vs_rest", """
SELECT CAST(c.facet_value AS DOUBLE) AS facet_value, c.n AS n_d, CAST(t.n - c.n AS BIGINT) AS n_a,
  CAST((t.tp - c.tp) + (t.fn - c.fn) AS DOUBLE) / nullif(t.n - c.n, 0) - CAST(c.tp + c.fn AS DOUBLE) / nullif(c.n, 0)
    AS DPL_labels,
  CAST((t.tp - c.tp) + (t.fp - c.fp) AS DOUBLE) / nullif(t.n - c.n, 0) - CAST(c.tp + c.fp AS DOUBLE) / nullif(c.n, 0)
    AS DPPL_predicted,
  CAST(t.tp - c.tp AS DOUBLE) / nullif((t.tp - c.tp) + (t.fn - c.fn), 0) - CAST(c.tp AS DOUBLE) / nullif(c.tp + c.fn, 0)
    AS RD_recall_diff,
  CAST((t.tp - c.tp) + (t.tn - c.tn) AS DOUBLE) / nullif(t.n - c.n, 0) - CAST(c.tp + c.tn AS DOUBLE) / nullif(c.n, 0)
    AS AD_accuracy_diff
FROM conf c, (SELECT sum(n) AS n, sum(tp) AS tp, sum(fp) AS fp, sum(tn) AS tn, sum(fn) AS fn FROM conf) t""",
   extra=POST_SQL)
def _(spark, sf):
    return B.posttraining_one_vs_rest(spread(spark, sf))


@q("bias_excluded_rows",
   "SELECT count_if(is_weekend IS NULL OR high_demand IS NULL) AS n_excluded, count(*) AS n_rows FROM test")
def _(spark, sf):
    return B.excluded_rows(test_scored(spark, sf))
