"""Stored features joined by their facts only, sibling histograms, folder writers with bounded tasks."""

import numpy as np
from pyspark.sql import functions as F

from retailcast.functions.features import engineer
from retailcast.operators import boosting as O
from retailcast.operators.evaluation import baseline_predict
from retailcast.plans import base
from retailcast.session import shared_path
from retailcast.sources import sinks as K
from retailcast.sources.tables import retail_daily

SF0001 = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_facts_travel_to_the_baseline(spark):
    rows = spark.createDataFrame([(f"1996-0{1 + d % 9}-1{d % 10}", s, u, 10.0 * u, 0.05 * (u % 4)) for d in range(40) for s, u in ((1, d % 7), (2, d % 5), (None, 3))],
                                 "date string, store_id long, units_sold long, base_price double, discount_pct double")
    rows = base.describe(rows.select(F.to_date("date").alias("d"), *base.FACTS[1:]).unionByName(spark.createDataFrame([(None, 1, 4, 2.0, 0.1), (None, None, 5, None, None)], "d date, store_id long, units_sold long, base_price double, discount_pct double")))
    before, now = baseline_predict(engineer(rows)), base.predicted_features(rows)
    assert now.dtypes == before.dtypes
    assert sorted(map(repr, now.collect())) == sorted(map(repr, before.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = base.predicted_features(retail_daily(spark, SF0001))._jdf.queryExecution().optimizedPlan().toString()
        joined = plan[plan.index("Join LeftOuter"):]
        assert "holiday_name" in plan and not any(c in joined for c in ("holiday_name", "event_time", "rainfall_mm", "promo_type"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_siblings_are_counted_once(spark, monkeypatch):
    """Of two siblings the one with fewer rows is counted, over the tree's columns only."""
    seen, kept = [], O._histogram_pass

    def watched(trees, now, counted, width, bits, columns, packed):
        seen.append((list(counted), int(columns.sum())))
        return kept(trees, now, counted, width, bits, columns, packed)
    monkeypatch.setattr(O, "_histogram_pass", watched)
    df = spark.createDataFrame([(i, float(i % 10), float(i % 7), float(i % 3), float((i % 10 > 7) * 9 + i % 7)) for i in range(200)], "record_id long, a double, b double, c double, y double")
    p = {"max_depth": 3, "learning_rate": 0.5, "subsample": 1.0, "colsample_bytree": 0.7, "min_child_weight": 1, "reg_lambda": 1.0, "seed": 1}
    model, _ = O.fit(df, ["a", "b", "c"], "y", p, 1, id_col="record_id")
    t = model.trees[0]
    assert len(seen) == 3 and seen[0] == ([0], 2) and all(n == 2 for _, n in seen)
    for counted, _ in seen[1:]:
        for i in counted:
            other = i - 1 if i % 2 == 0 else i + 1
            assert other not in counted and t.cover[i] <= t.cover[other]
    rows = df.toPandas()
    x = rows[["a", "b", "c"]].to_numpy()
    where = np.zeros(len(x), int)
    for _ in range(3):
        where = np.where(t.feature[where] < 0, where, 2 * where + 2 - (x[np.arange(len(x)), np.maximum(t.feature[where], 0)] <= t.threshold[where]))
    for i in np.unique(where):
        assert t.cover[i] == (where == i).sum()
        assert abs(t.value[i] + 0.5 * (model.base - rows["y"])[where == i].sum() / ((where == i).sum() + 1)) < 1e-5


def test_labels_that_are_no_floats_stay_doubles():
    whole, fine = np.array([1.0, 2.0]), np.array([0.1, 2.0])
    assert len(O._short(whole)) == 8 and np.array_equal(np.frombuffer(O._short(fine)), fine)


def test_folder_writers_deal_their_rows_out(spark, monkeypatch):
    seen, kept = [], K._dealt
    monkeypatch.setattr(K, "_dealt", lambda df, *folders: seen.append(kept(df, *folders)) or seen[-1])
    rows, path = engineer(retail_daily(spark, SF0001)), shared_path(spark, "dealt")
    K.append_feature_table(rows, f"{path}/features")
    K.write_splits(rows, f"{path}/splits")
    assert all("REBALANCE" in _plan(df) for df in seen) and len(seen) == 2
    want = sorted(map(repr, K.contract_select(rows).collect()))
    for name in ("features", "splits"):
        assert sorted(map(repr, K.contract_select(spark.read.parquet(f"{path}/{name}")).collect())) == want


def test_registered_tables_read_compressed_files(spark):
    from retailcast.plans.catalog import QUERIES
    found = QUERIES["source_table_or_query"][0](spark, SF0001)
    assert all(f.endswith(".csv.gz") for f in found.inputFiles())
    want = retail_daily(spark, SF0001).groupBy("store_id", "day_of_week").agg(F.sum("units_sold").alias("units"))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
