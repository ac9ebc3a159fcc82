"""Streams over several micro-batches, sketch-bracketed quantiles, metrics that add up, exact category values."""

import math
import random
import uuid

import pytest
from pyspark.sql import functions as F

from retailcast.operators import monitoring as W
from retailcast.operators import quality as Q
from retailcast.operators import quantile as N
from retailcast.session import shared_path
from retailcast.streaming import stream as ST


def stream_of(spark, name, batches, schema):
    """A stream of one file, and so one micro-batch, per list of rows."""
    folder = shared_path(spark, f"test-streams/{name}")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{i}")
    return ST.read_stream(spark, f"{folder}/*", spark.createDataFrame([], schema).schema, max_files=1)


def at(minute):
    from datetime import datetime, timedelta
    return datetime(2024, 1, 1) + timedelta(minutes=minute)


def test_late_labels_over_three_batches(spark):
    name = uuid.uuid4().hex[:8]
    preds = [[(1, at(0), 1.0), (2, at(5), 2.0)], [(3, at(60), 3.0), (4, at(70), 4.0)], [(-1, at(9000), None)]]
    labels = [[(1, at(20), 10.0)], [(3, at(119), 30.0), (2, at(100), 20.0)], [(4, at(140), 40.0), (-2, at(9000), None)]]
    p = stream_of(spark, f"{name}-p", preds, "record_id long, predicted_at timestamp, prediction double")
    y = stream_of(spark, f"{name}-y", labels, "record_id long, labelled_at timestamp, label double")
    query = (ST.stream_delayed_labels(p, y, "1 hour").writeStream.outputMode("append").option("checkpointLocation", shared_path(spark, f"test-streams/{name}-c"))
             .trigger(availableNow=True).format("parquet").option("path", shared_path(spark, f"test-streams/{name}-out")).start())
    query.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(shared_path(spark, f"test-streams/{name}-out")).filter("record_id > 0").collect()))
    assert got == [(1, "labeled", 1.0, 10.0), (2, "late_label", None, 20.0), (2, "unlabeled", 2.0, None), (3, "labeled", 3.0, 30.0), (4, "late_label", None, 40.0), (4, "unlabeled", 4.0, None)]
    assert len([x for x in query.recentProgress if x["numInputRows"] > 0]) >= 3
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2           # the two closing rows
    flat = lambda rows: [r for b in rows for r in b]
    batch = W.labels_within(spark.createDataFrame(flat(preds), "record_id long, predicted_at timestamp, prediction double"),
                            spark.createDataFrame(flat(labels), "record_id long, labelled_at timestamp, label double"), "1 hour")
    assert sorted(map(tuple, batch.filter("record_id > 0").collect())) == got


def test_an_alert_is_raised_once(spark):
    name = uuid.uuid4().hex[:8]
    schema = "event_id long, ts timestamp, event_type string, value double"
    batches = [[(1, at(1), "a", 200.0), (2, at(2), "b", 1.0)], [(3, at(50), "a", 300.0), (4, at(130), "a", 400.0)], [(5, at(400), "a", 1.0)]]
    out = ST.stream_alerts_once(stream_of(spark, name, batches, schema), f"alert-{name}", 100.0)
    alerts = spark.read.parquet(out)
    assert sorted((r["window_start"][11:16], r["event_type"], r["avg_value"]) for r in alerts.collect()) == [("00:00", "a", 250.0), ("02:00", "a", 400.0)]
    last = alerts.agg(F.max("batch_id")).first()[0]
    again = alerts.filter(F.col("batch_id") == last).drop("batch_id", "alert")
    ST.alerts_once_batch(100.0)(spark.createDataFrame(again.collect(), again.schema), last, out)              # the batch is replayed
    assert spark.read.parquet(out).count() == 2


def test_anomaly_state_keeps_valueless_rows_and_expires_keys(spark):
    name = uuid.uuid4().hex[:8]
    schema = "event_id long, ts timestamp, event_type string, value double"
    batches = [[(i, at(i), "a", float(i % 5)) for i in range(6)] + [(10, at(3), "a", None), (11, at(2), None, 1.0), (12, at(4), "old", 5.0)],
               [(20, at(600), "a", 9.0), (21, at(601), None, 2.0), (22, at(602), "a", None)], [(30, at(700), "old", 5.0), (31, at(701), "a", 1.0)]]
    out = ST.stream_anomaly_state(stream_of(spark, name, batches, schema), f"anom-{name}", expire="5 HOURS")
    got = {r["event_id"]: r["anomaly_score"] for r in spark.read.parquet(out).collect()}
    assert set(got) == {e[0] for b in batches for e in b} and got[10] is None and got[22] is None and got[20] is not None
    root = shared_path(spark, f"streams/anom-{name}/state")
    newest = {r["event_type"]: r["n0"] for r in spark.read.parquet(f"{root}/slot-0").collect()}
    assert newest["a"] == 8 and newest["old"] == 1              # forgotten after the second batch, begun anew in the third
    assert set(r["event_type"] for r in spark.read.parquet(f"{root}/slot-1").collect()) == {"a", None}


def interpolated(values, p):
    v = sorted(values)
    k = (len(v) - 1) * p
    lo, hi = v[math.floor(k)], v[math.ceil(k)]
    return lo if lo == hi else lo * (1 - (k - math.floor(k))) + hi * (k - math.floor(k))


@pytest.mark.parametrize("margin,windowed", [(0.006, 10**6), (0.0, 10**6), (0.006, 0)])
def test_quantiles_through_sketches(spark, monkeypatch, margin, windowed):
    """The brackets as they are, brackets that miss, and brackets too full for one window."""
    monkeypatch.setattr(N, "MARGIN", margin)
    monkeypatch.setattr(N, "WINDOWED", windowed)
    monkeypatch.setattr(N, "SKETCH", 64)
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1), rng.randrange(3), None, float(rng.randrange(10**6)) if rng.random() < 0.7 else None) for _ in range(4000)] + [(1.0, 5, None, -2.5)] * 1500
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r["feature"]: (r["n"], r["q"]) for r in N.exact_quantiles(df, ["a", "b", "c", "d"], probs).collect()}
    assert set(got) == {"a", "b", "d"}
    for i, c in ((0, "a"), (1, "b"), (3, "d")):
        own = [r[i] for r in rows if r[i] is not None]
        assert got[c] == (len(own), [interpolated(own, p) for p in probs])


def test_quantiles_with_nan_and_without_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),)], "a double")
    assert N.exact_quantiles(df, ["a"], [0.5]).first()["q"] == [2.0]
    assert N.exact_quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_metrics_of_days_add_up(spark):
    rng = random.Random(2)
    rows = [(d, rng.choice([None, rng.random() * 50]), rng.randrange(400), rng.choice("xyz")) for d in range(6) for _ in range(300)]
    df = spark.createDataFrame(rows, "day int, v double, k int, t string")
    names = (["v", "k"], ["k", "t"], [("v", "k")])
    parts = [Q.metric_state(df.filter(F.col("day") == d), ["day"], *names) for d in range(6)]
    merged = parts[0]
    for x in parts[1:]:
        merged = merged.unionByName(x)
    got = {(r["instance"], r["name"]): r["value"] for r in Q.merged_metrics(merged, *names).collect()}
    whole = {(r["instance"], r["name"]): r["value"] for r in Q.merged_metrics(Q.metric_state(df, [], *names), *names).collect()}
    exact = df.agg(F.corr("v", "k"), F.stddev_pop("v"), F.avg("v"), F.count_distinct("k")).first()
    assert set(got) == set(whole) and all(abs(got[k] - whole[k]) <= 1e-6 * max(1, abs(whole[k])) for k in got if k[1] != "ApproxCountDistinct")
    assert abs(got["v,k", "Correlation"] - exact[0]) < 1e-9 and abs(got["v", "StandardDeviation"] - exact[1]) < 1e-9 and abs(got["v", "Mean"] - exact[2]) < 1e-9
    assert abs(got["k", "ApproxCountDistinct"] - exact[3]) <= 0.03 * exact[3] and got["t", "ApproxCountDistinct"] == 3


def test_categories_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(Q, "PROOF_ROWS", 5)
    rows = [(i % 10, i % 11, 0.5 * (i % 3), "q\"x" if i % 2 else "b\\", None) for i in range(400)]
    df = spark.createDataFrame(rows, "ten int, eleven int, d double, s string, none string").repartition(6)
    assert Q.few_values(df, df.columns, 10) == {"ten": [str(i) for i in range(10)], "d": ["0.0", "0.5", "1.0"], "s": ["b\\", "q\"x"]}
    code = {r["column_name"]: r["code_for_constraint"] for r in Q.suggest_constraints(df).collect() if r["rule"] == "CategoricalRangeRule"}
    assert code == {"ten": '.isContainedIn("ten", Array(' + ", ".join(f'"{i}"' for i in range(10)) + "))", "d": '.isContainedIn("d", Array("0.0", "0.5", "1.0"))',
                    "s": '.isContainedIn("s", Array("b\\\\", "q\\"x"))'}
