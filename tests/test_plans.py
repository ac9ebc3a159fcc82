"""Plan properties: no Python in the hot path, no single-partition windows
over data, filters and projections reach the scan."""

import pytest

import __spark_entry__ as ent
from tests.conftest import SF0001

PYTHON_OPS = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "PythonUDF")
NO_PYTHON = ["flagship", "dq_metrics_table", "check_results", "split_exact", "eval_by_split",
             "bias_posttraining_report", "data_profile", "data_drift", "latest_features", "stream_anomaly_score"]


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_and_no_window(spark, name):
    plan = _plan(ent.queries()[name](spark, SF0001))
    assert not any(op in plan for op in PYTHON_OPS), plan
    if name == "data_drift":
        # the only windows normalise bucket counts per feature (feature x bucket rows)
        assert plan.count("windowspecdefinition(") == plan.count("windowspecdefinition(feature"), plan
    elif name == "data_profile":
        # the quantiles are found before: a few numbers per column
        assert "Window [" not in plan and "percentile" not in plan, plan
    else:
        assert "Window" not in plan, plan


def test_projection_and_filter_pushdown(spark):
    from retailcast.sources.tables import retail_daily
    from pyspark.sql import functions as F
    df = retail_daily(spark, SF0001).filter(F.col("store_id") == 3).select("record_id", "units_sold")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate" in plan
    assert "l_extendedprice" not in plan                       # unused columns never read
    assert "EqualTo(l_suppkey,3)" in plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]   # store filter at the scan


def test_attribution_is_the_python_operator(spark):
    plan = _plan(ent.queries()["shap_values"](spark, SF0001))
    assert "MapInPandas" in plan or "PythonMapInArrow" in plan or "MapInArrow" in plan
