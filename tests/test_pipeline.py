from pyspark.sql import functions as F

from retailcast.plans.pipeline import run_pipeline
from retailcast.session import shared_path
from tests.conftest import SF0001


def test_pipeline_end_to_end(spark):
    import uuid
    out = shared_path(spark, f"test-pipeline-{uuid.uuid4().hex[:8]}")
    res = run_pipeline(spark, SF0001, out, "2025-12-03T10:51:32Z", "run-1", rounds=3, stores=5,
                       rmse_max=1e9, r2_min=-1e9)
    flat = res["summary"].first()
    assert flat["n_rows"] > 0 and flat["rmse"] > 0
    assert res["gate"].first()["gate_passed"]
    assert res["versions"].count() == 1
    mon = spark.read.parquet(f"{out}/monitoring/evaluation_summary")
    assert mon.count() == 1 and mon.select(F.col("eval_date").cast("string")).first()[0] == "2025-12-03"
    # re-appending the same run replaces its monitoring partition (idempotent)
    from retailcast.sources.sinks import append_monitoring
    append_monitoring(res["summary"], f"{out}/monitoring/evaluation_summary", "2025-12-03T10:51:32Z", "run-1")
    assert spark.read.parquet(f"{out}/monitoring/evaluation_summary").count() == 1
    metrics = spark.read.option("header", True).option("sep", "\t").csv(f"{out}/quality/dataset-metrics")
    assert metrics.count() == 18
