"""Stream forms equal their batch definitions, across several micro-batches."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from retailcast.operators import monitoring as W
from retailcast.session import shared_path
from retailcast.streaming import stream as ST
from tests.conftest import SF0001


def _two_files(spark, name):
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    cut = ev.agg(F.percentile_approx("ts", 0.5)).first()[0]
    folder = shared_path(spark, f"test-streams/{name}/in")
    ev.filter(F.col("ts") < cut).coalesce(1).write.mode("overwrite").parquet(folder + "/a")
    ev.filter(F.col("ts") >= cut).coalesce(1).write.mode("overwrite").parquet(folder + "/b")
    return ev, folder + "/*"


def test_anomaly_state_across_batches(spark):
    import uuid
    name = uuid.uuid4().hex[:8]
    ev, glob = _two_files(spark, name)
    src = ST.read_stream(spark, glob, ST.EVENTS_SCHEMA, max_files=1)
    out = ST.stream_anomaly_state(src, f"t-anom-{name}")
    res = spark.read.parquet(out)
    assert res.select("batch_id").distinct().count() == 2          # two micro-batches, state carried over
    got = {r["event_id"]: r["anomaly_score"] for r in res.collect()}
    w = Window.partitionBy("event_type").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    exp = ev.select("event_id", F.when((F.count("value").over(w) >= 2) & (F.stddev_samp("value").over(w) > 0),
                                       (F.col("value") - F.avg("value").over(w)) / F.stddev_samp("value").over(w))
                    .alias("z")).collect()
    assert len(got) == len(exp)
    for r in exp:
        a, b = got[r["event_id"]], r["z"]
        if b is None:
            assert a is None
        else:
            assert abs(a - b) <= 1e-9 * max(1, abs(b))


def test_window_avg_stream_equals_batch(spark):
    import uuid
    name = uuid.uuid4().hex[:8]
    ev, glob = _two_files(spark, name)
    src = ST.read_stream(spark, glob, ST.EVENTS_SCHEMA, max_files=1)
    out = ST.run_available_now(ST.stream_window_avg(src), f"t-win-{name}", mode="complete",
                               batch_fn=ST.overwrite_batch)
    got = spark.read.parquet(out)
    exp = W.window_avg(ev)
    key = ["window_start", "event_type"]
    j = got.join(exp.withColumnRenamed("avg_value", "e"), key, "full")
    assert j.filter(F.col("avg_value").isNull() | F.col("e").isNull()).count() == 0
    assert j.select(F.max(F.abs(F.col("avg_value") - F.col("e")))).first()[0] < 1e-9
