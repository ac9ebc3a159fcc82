from retailcast.operators import quality as Q


def test_analyzers_with_nulls(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (2, None, "b"), (2, 3.0, None)], "id long, x double, s string")
    m = {(r["instance"], r["name"]): r["value"] for r in Q.run_analyzers(
        df, [Q.size(), Q.completeness("x"), Q.mean("x"), Q.compliance("pos", "x > 4"),
             Q.approx_distinct("s")]).collect()}
    assert m[("*", "Size")] == 3.0
    assert abs(m[("x", "Completeness")] - 2 / 3) < 1e-12
    assert m[("x", "Mean")] == 4.0
    assert abs(m[("pos", "Compliance")] - 1 / 3) < 1e-12      # NULL counts as not compliant
    assert m[("s", "ApproxCountDistinct")] == 2.0


def test_uniqueness(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id long")
    assert abs(Q.uniqueness(df, "id").first()["value"] - 2 / 4) < 1e-12


def test_check_results_failure(spark):
    df = spark.createDataFrame([(1, -1, 0.5)], "record_id long, units_sold long, discount_pct double")
    cs = [c for c in Q.default_constraints() if c.description.startswith(("Size", "Minimum", "Maximum"))]
    rows = {r["constraint"]: r for r in Q.check_results(df, cs).collect()}
    assert all(r["check_status"] == "Error" for r in rows.values())
    assert rows["SizeConstraint(Size(None))"]["constraint_status"] == "Failure"
    assert rows["MaximumConstraint(Maximum(discount_pct,None))"]["constraint_status"] == "Success"


def test_one_scan_for_all_analyzers(spark):
    from retailcast.sources.tables import retail_daily
    from tests.conftest import SF0001
    plan = Q.run_analyzers(retail_daily(spark, SF0001), Q.default_analyzers())._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("FileScan parquet") == 2   # lineitem + part, each scanned once


def test_suggestions(spark):
    df = spark.createDataFrame([(1, "3"), (2, "4")], "a long, s string")
    rules = {(r["column_name"], r["rule"]) for r in Q.suggest_constraints(df).collect()}
    assert ("a", "CompleteIfCompleteRule") in rules and ("s", "RetainTypeRule") in rules
    assert ("a", "NonNegativeNumbersRule") in rules
