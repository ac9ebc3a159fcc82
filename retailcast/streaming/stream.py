"""Structured Streaming operators (W1–W4 stream forms).

Sources are file streams (no servers, no ports); sinks write Parquet under
the shared checkpoint folder, with a checkpoint per query so a restarted
query resumes exactly once. `run_available_now` drains what is there and
stops — the daily-job trigger of the monitoring design.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailcast.operators.monitoring import TS_FMT, labels_within
from retailcast.session import shared_path
from retailcast.sources.sinks import read_if_exists

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def read_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def run_available_now(df: DataFrame, name: str, mode: str = "append",
                      batch_fn: Callable[[DataFrame, int], None] | None = None) -> str:
    """Run a stream to completion of the data present now; return the output path."""
    spark = df.sparkSession
    out = shared_path(spark, f"streams/{name}/out")
    ckpt = shared_path(spark, f"streams/{name}/checkpoint")
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    if batch_fn is None:
        q = w.format("parquet").option("path", out).start()
    else:
        q = w.foreachBatch(lambda b, i: batch_fn(b, i, out)).start()
    q.awaitTermination()
    return out


def overwrite_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Complete-mode sink: each micro-batch carries the whole result table."""
    batch.write.mode("overwrite").parquet(out)


def stream_score(features: DataFrame, key_table: DataFrame, global_mean: float,
                 keys=("store_id", "day_of_week_index")) -> DataFrame:
    """Each feature record -> record + prediction (stream-static join with
    the fitted baseline table; the same plan scores batch input)."""
    return (features.join(key_table, list(keys), "left")
            .withColumn("prediction", F.coalesce(F.col("_key_mean"), F.lit(global_mean)))
            .drop("_key_mean"))


def stream_window_avg(events: DataFrame, size: str = "1 hour", watermark: str = "10 minutes",
                      key: str = "event_type") -> DataFrame:
    """Event-time tumbling-window average per key with a watermark."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    return (e.groupBy(F.window("ts", size).alias("w"), F.col(key))
            .agg(F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n"))
            .select(F.date_format("w.start", TS_FMT).alias("window_start"),
                    F.date_format("w.end", TS_FMT).alias("window_end"), key, "avg_value", "n"))


def two_sinks_batch(condition, valid: str = "valid", other: str = "quarantine"):
    """W5 (stream form): foreachBatch writer of two sinks. A batch goes to folders
    under its own id, so a replayed batch replaces what it wrote."""
    def fn(batch: DataFrame, batch_id: int, out: str) -> None:
        batch = batch.persist()
        batch.filter(condition).write.mode("overwrite").parquet(f"{out}/{valid}/batch_id={batch_id}")
        batch.filter(~condition).write.mode("overwrite").parquet(f"{out}/{other}/batch_id={batch_id}")
        batch.unpersist()
    return fn


def stream_alert_batch(threshold: float, above: bool = True):
    """foreachBatch writer that appends only windows crossing the threshold."""
    def fn(batch: DataFrame, batch_id: int, out: str) -> None:
        cond = F.col("avg_value") > threshold if above else F.col("avg_value") < threshold
        batch.filter(cond).withColumn("alert", F.lit("above" if above else "below")) \
            .write.mode("overwrite").parquet(out)
    return fn


def alerts_once_batch(threshold: float, above: bool = True):
    """foreachBatch writer for closed windows (append mode): each window comes once, so each raises
    at most one alert. A batch's alerts go to the folder of its id; a replayed batch
    replaces what it wrote and changes nothing."""
    def fn(batch: DataFrame, batch_id: int, out: str) -> None:
        cond = F.col("avg_value") > threshold if above else F.col("avg_value") < threshold
        batch.filter(cond).withColumn("alert", F.lit("above" if above else "below")).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return fn


def stream_alerts_once(events: DataFrame, name: str, threshold: float, above: bool = True, size: str = "1 hour", watermark: str = "10 minutes") -> str:
    """Alerts of the windows that the watermark has closed; returns the output folder (by batch id).

    The window state is freed as windows close."""
    return run_available_now(stream_window_avg(events, size, watermark), name, batch_fn=alerts_once_batch(threshold, above))


def stream_delayed_labels(predictions: DataFrame, labels: DataFrame, bound: str = "1 hour", lateness: str = "0 minutes", key: str = "record_id") -> DataFrame:
    """Stream-stream full outer join of predictions (key, predicted_at, prediction) and labels (key,
    labelled_at, label) with a watermark on each side and the interval ``bound`` between them.

    A match comes out at once; a prediction without a label in time, and a label that came too late,
    come out when the watermarks have passed them, and their state is dropped."""
    p = predictions.withColumn("predicted_at", F.col("predicted_at").cast("timestamp")).withWatermark("predicted_at", lateness)
    y = labels.withColumn("labelled_at", F.col("labelled_at").cast("timestamp")).withWatermark("labelled_at", lateness)
    return labels_within(p, y, bound, key)


def anomaly_state_writer(state_dir: str, key: str = "event_type", expire: str | None = None):
    """W3 (stream form) as a foreachBatch writer with an explicit state table.

    Each micro-batch reads the per-key state of the previous batch, scores its
    rows against all earlier values of their key (a row that arrives late
    is scored against the newer state it meets; exact distributed prefix
    sums, so a hot key is split across tasks), then writes its output under its
    batch id and the new state into one of two slots by turns. A replayed batch reads
    the slot before it again and overwrites the same places, so the sink is idempotent, restarts
    resume exactly once, and no older state is kept or listed."""
    from retailcast.operators.monitoring import running_zscore

    def fn(batch: DataFrame, batch_id: int, out: str) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        prior = read_if_exists(spark, f"{state_dir}/slot-{(batch_id - 1) % 2}") if batch_id else None
        scored, new_state = running_zscore(batch, prior, key, expire=expire)
        scored.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        new_state.write.mode("overwrite").parquet(f"{state_dir}/slot-{batch_id % 2}")
        batch.unpersist()
    return fn


def stream_anomaly_state(events: DataFrame, name: str, key: str = "event_type", expire: str | None = None) -> str:
    """Run the stateful anomaly stream to completion of the present data;
    returns the output folder (partitioned by batch id). Keys not seen for ``expire`` leave the state."""
    state_dir = shared_path(events.sparkSession, f"streams/{name}/state")
    cols = events.select("event_id", F.col("ts"), key, "value")
    return run_available_now(cols, name, batch_fn=anomaly_state_writer(state_dir, key, expire))
