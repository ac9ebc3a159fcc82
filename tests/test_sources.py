import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from retailcast.contract import RAW_COLUMNS, RAW_SCHEMA
from retailcast.session import shared_path
from retailcast.sources import files as S
from retailcast.sources import sinks as K
from retailcast.sources.tables import retail_daily
from tests.conftest import SF0001


def _uid():
    import uuid
    return uuid.uuid4().hex[:8]


def test_retail_view_contract(spark):
    df = retail_daily(spark, SF0001)
    assert df.columns == RAW_COLUMNS
    assert [f.dataType for f in df.schema.fields] == [f.dataType for f in RAW_SCHEMA.fields]
    assert df.select("record_id").distinct().count() == df.count()
    five = retail_daily(spark, SF0001, stores=5)
    assert sorted(r[0] for r in five.select("store_id").distinct().collect()) == [1, 2, 3, 4, 5]


def test_csv_roundtrip_and_empty_folder(spark):
    path = shared_path(spark, f"test-csv-{_uid()}")
    df = retail_daily(spark, SF0001)
    df.write.option("header", True).csv(path)
    back = S.scan_csv_dir(spark, path)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    empty = shared_path(spark, f"test-empty-{_uid()}")
    spark.range(0).write.parquet(empty)
    with pytest.raises(RuntimeError):
        S.scan_csv_dir(spark, empty)


def test_source_requires_query_or_table(spark):
    with pytest.raises(ValueError):
        S.source_table_or_query(spark)


def test_create_table_sanitizes_names(spark):
    df = spark.createDataFrame([(1, 2.0)], "`Run-Id` long, `Model R2` double")
    name = f"t_{_uid()}"
    out = S.create_table_from_schema(df, name, shared_path(spark, f"warehouse/{name}"))
    assert out.columns == ["run_id", "model_r2"]


def test_latest_features_newest_wins(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", 5), (1, "2024-01-02T00:00:00Z", 7),
                                (2, "2024-01-01T00:00:00Z", 3)], "record_id long, event_time string, v int")
    got = {r["record_id"]: r["v"] for r in K.latest_features(df).collect()}
    assert got == {1: 7, 2: 3}
    newest = df.withColumn("rn", F.row_number().over(Window.partitionBy("record_id").orderBy(F.desc("event_time"))))
    assert {r["record_id"]: r["v"] for r in newest.filter("rn = 1").collect()} == got


def test_json_report_nulls_non_finite(spark):
    path = shared_path(spark, f"test-json-{_uid()}")
    df = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    K.write_json_report(df, path)
    txt = spark.read.text(path).first()[0]
    assert '"a":null' in txt and '"b":1.0' in txt


def test_export_payload_requires_features(spark):
    with pytest.raises(ValueError):
        K.export_csv_payload(spark.range(1))


def test_typed_csv_keeps_corrupt_lines(spark):
    path = shared_path(spark, f"test-bad-{_uid()}")
    spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-02")], "record_id string, date string") \
        .coalesce(1).write.option("header", True).csv(path)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("record_id", T.LongType()), T.StructField("date", T.StringType())])
    rows = S.scan_typed_csv(spark, path, schema, corrupt_col="_corrupt").orderBy("date").collect()
    assert rows[0]["record_id"] == 1 and rows[0]["_corrupt"] is None
    assert rows[1]["record_id"] is None and rows[1]["_corrupt"] == "x,2024-01-02"
