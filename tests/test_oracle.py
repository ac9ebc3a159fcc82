"""Registered queries vs their DuckDB oracle on sf0.001 (the driver runs the
same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as ent
from tests.conftest import SF0001

TABLES = ["lineitem", "part", "events", "labels"]
FAST = ["flagship", "parse_date", "label_high_demand_p75", "split_exact", "dq_metrics_table", "check_results",
        "eval_by_split", "bias_pretraining_report", "bias_posttraining_report", "bias_long", "data_profile",
        "evaluation_summary_flat", "latest_features", "route_approval_event", "serving_version",
        "stream_window_avg", "stream_anomaly_score", "data_drift", "metric_history", "stream_anomaly_state",
        "suggest_constraints", "scan_typed_csv", "append_monitoring", "pending_notification", "data_drift_ks",
        "anomaly_score_cumulative", "residual_histogram", "bias_dcacc", "bias_cddpl", "retail_daily_5_stores",
        "export_csv_payload", "metric_history_profile", "quarantine", "delayed_labels"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "to_pydatetime"):
        v = v.to_pydatetime()
        return v.date() if (v.hour, v.minute, v.second, v.microsecond) == (0, 0, 0, 0) else v
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    got = _rows(ent.queries()[name](spark, SF0001).toPandas())
    exp = _rows(con.execute(ent.oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert len(got[1]) == len(exp[1])
    for a, b in zip(got[1], exp[1]):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert abs(x - y) <= 1e-6 * max(1, abs(y))
            else:
                assert x == y


def test_entry(spark):
    df = ent.entry(spark)
    assert df.count() == 3 and "rmse" in df.columns


def test_every_oracle_has_query():
    assert set(ent.oracle_sql()) <= set(ent.queries())
