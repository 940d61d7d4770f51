import datetime as dt

import pytest
from pyspark.sql import functions as F

from kelvibra import fixtures
from kelvibra import settings as S
from kelvibra.operators.evaluation import classification_metrics, latest_per_model
from kelvibra.operators.rules import apply_rules, format_reading
from kelvibra.operators.scans import device_filter, scan_range
from kelvibra.sources import tables as T
from kelvibra.sources.messages import message_batch
from tests.helpers import plan_of, same_rows


def readings(spark, sf):
    rows = fixtures.readings(spark, sf).withColumn("location", F.lit(None).cast(S.LOCATION))
    stamp = F.lit("2024-03-01 00:00:00").cast("timestamp")
    return format_reading(apply_rules(rows), stamp).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


@pytest.fixture(scope="module")
def table(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "sensor_data")
    T.append_readings(readings(spark, sf), path)
    return path


def test_append_and_read_back(spark, sf, table):
    same_rows(spark.read.parquet(table).drop("event_date"), readings(spark, sf))


def test_second_append_adds(spark, sf, tmp_path):
    path = str(tmp_path / "t")
    some = readings(spark, sf).limit(10).cache()
    T.append_readings(some, path)
    T.append_readings(some, path)
    assert spark.read.parquet(path).count() == 20


def test_append_needs_all_columns(spark, sf, tmp_path):
    with pytest.raises(ValueError, match="temp_z_score"):
        T.append_readings(readings(spark, sf).drop("temp_z_score"), str(tmp_path / "t"))


def test_range_scan_prunes_days_and_pushes_filters(spark, table):
    as_of = dt.datetime(2024, 1, 30, 12)
    rows = scan_range(spark.read.parquet(table), "7 DAYS", as_of).select("device_id", "temperature")
    plan = plan_of(rows)
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan.split("PartitionFilters")[1][:120]
    assert "GreaterThanOrEqual(timestamp" in plan
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert schema == "struct<device_id:string,timestamp:timestamp,temperature:double>"
    assert rows.count() == spark.read.parquet(table).filter(
        "timestamp BETWEEN '2024-01-23 12:00:00' AND '2024-01-30 12:00:00'").count()


def test_range_scan_ends_with_a_past_moment_and_survives_another_time_zone(spark, table):
    as_of = dt.datetime(2024, 1, 10)
    want = scan_range(spark.read.parquet(table), "7 DAYS", as_of).count()
    assert want == spark.read.parquet(table).filter(
        "timestamp BETWEEN '2024-01-03' AND '2024-01-10'").count() > 0
    newest = scan_range(spark.read.parquet(table), "2 DAYS").count()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert scan_range(spark.read.parquet(table), "2 DAYS").count() == newest
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_streams_with_other_checkpoints_keep_each_others_rows(spark, tmp_path):
    from kelvibra.streaming.jobs import streaming_row_sink
    spark.range(3).write.parquet(str(tmp_path / "in"))
    for state in ("a", "b"):
        rows = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        streaming_row_sink(rows, str(tmp_path / "out"), str(tmp_path / state)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_a_large_day_is_split(spark, tmp_path):
    rows = spark.range(4000).select(
        F.concat(F.lit("d"), (F.col("id") % 3).cast("string")).alias("device_id"), F.lit("t").alias("device_type"),
        (F.lit("2024-01-01").cast("timestamp") + F.expr("make_interval(0,0,0,0,0,0,id)")).alias("timestamp"))
    path = str(tmp_path / "day")
    T.partition_and_cluster(rows.repartition(4), path, rows_per_file=500)
    out = spark.read.parquet(path)
    assert out.count() == 4000 and len(out.inputFiles()) >= 8


def test_device_filter_is_literal(spark):
    df = spark.createDataFrame([("a_1",), ("ab1",), ("x%",)], "device_id string")
    assert [r[0] for r in device_filter(df, "_1").collect()] == ["a_1"]
    assert device_filter(df, "%").count() == 1
    assert device_filter(df, "").count() == 3


def test_materialize_and_view(spark, sf):
    rows = readings(spark, sf).select("device_id", "temperature")
    for _ in range(2):
        same_rows(T.materialize(rows, "kept_readings"), rows)
    same_rows(T.register_view(rows, "seen_readings"), rows)
    assert spark.sql("select count(*) from seen_readings").first()[0] == 1000


def test_metrics_accumulate(spark, sf, tmp_path):
    path = str(tmp_path / "perf")
    metrics = classification_metrics(fixtures.scored_models(spark, sf), ["model_name"])
    for version, day in (("1", "2024-01-01"), ("2", "2024-01-02")):
        T.append_metrics(metrics, path, version, F.lit(day).cast("timestamp"), 800, 200)
    perf = T.read_metrics(spark, path)
    assert perf.count() == 6
    newest = latest_per_model(perf).collect()
    assert {r["model_version"] for r in newest} == {"2"} and {r["auc_roc"] for r in newest} == {None}


def test_export_csv(spark, sf, tmp_path):
    path = str(tmp_path / "csv")
    rows = readings(spark, sf).select("device_id", "temperature", "is_anomaly")
    T.export_csv(rows, path)
    same_rows(spark.read.csv(path, header=True, schema=rows.schema), rows)


def test_conform_to_the_superset(spark, sf):
    narrow, wide = T.conform(readings(spark, sf)), T.conform(fixtures.readings_wide(spark, sf))
    assert narrow.columns == wide.columns == S.SENSOR_DATA.names
    assert narrow.filter("humidity is not null").count() == 0


def test_message_batch(spark, sf, tmp_path):
    path = str(tmp_path / "messages")
    raw = fixtures.raw_messages(spark, sf)
    raw.write.text(path)
    same_rows(message_batch(spark, path), raw)
