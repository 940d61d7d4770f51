"""Streams against the same work in batch."""

import json
import time

import pytest
from pyspark.sql import functions as F

from kelvibra import fixtures
from kelvibra.operators import features as W
from kelvibra.operators import parsing as P
from kelvibra.operators.rules import apply_rules, format_alert, format_reading, rule_score
from kelvibra.sources.messages import alert_values, message_batch, message_stream, publish_alerts
from kelvibra.sources.tables import write_once
from kelvibra.streaming import jobs
from kelvibra.streaming.features import stream_features
from kelvibra.streaming.rates import anomaly_rate_alert, anomaly_rates
from tests.helpers import same_rows


@pytest.fixture(scope="module")
def inbox(spark, sf, tmp_path_factory):
    """The messages of the test table in eight files."""
    path = str(tmp_path_factory.mktemp("inbox") / "messages")
    fixtures.raw_messages(spark, sf).repartition(8).write.text(path)
    return path


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


def stored(spark, path):
    return spark.read.parquet(path).drop("batch_id", "event_date", "processed_at")


def test_detection_stream_equals_batch(spark, inbox, tmp_path):
    table, alerts, rejects, state = (str(tmp_path / n) for n in ("table", "alerts", "rejects", "state"))
    stream = message_stream(spark, "text", inbox, maxFilesPerTrigger="3")
    drain(jobs.run_detection(stream, table, alerts, rejects, state))

    parsed = P.parse_messages(message_batch(spark, inbox))
    ruled = apply_rules(P.validate_required(parsed))
    same_rows(stored(spark, table), format_reading(ruled).drop("processed_at"))
    same_rows(spark.read.text(alerts).select("value"), alert_values(format_alert(ruled)))
    same_rows(spark.read.parquet(rejects).drop("batch_id"), P.quarantine(parsed))
    assert spark.read.parquet(table).select("batch_id").distinct().count() == 3

    # a restart from the checkpoint adds new files only
    more = json.dumps({"device_id": "late", "timestamp": "2024-02-01T00:00:00", "device_type": "hvac_monitor",
                       "sensor_data": {"temperature": 50.0, "vibration": 9.0}})
    spark.createDataFrame([(more,)], "value string").coalesce(1).write.mode("append").text(inbox)
    drain(jobs.run_detection(message_stream(spark, "text", inbox), table, alerts, rejects, state))
    assert stored(spark, table).count() == ruled.count() + 1
    assert spark.read.text(alerts).filter(F.col("value").contains('"late"')).count() == 1


def test_replayed_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10)
    write_once(rows, path, 7)
    write_once(rows, path, 7)
    write_once(rows, path, 8)
    assert spark.read.parquet(path).count() == 20


def test_consume_and_score(spark, sf, tmp_path):
    wide = fixtures.readings_wide(spark, sf).withColumn("timestamp", F.col("timestamp").cast("string"))
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    columns = ["device_id", "timestamp", "device_type", "temperature", "humidity", "pressure",
               "vibration_level", "power_consumption"]
    wide.select(F.to_json(F.struct(*columns)).alias("value")) \
        .unionByName(spark.createDataFrame([("{broken",)], "value string")).write.text(source)
    drain(jobs.consume_and_score(message_stream(spark, "text", source), table, str(tmp_path / "state")))
    out = spark.read.parquet(table)
    assert out.filter("reject_reason = 'malformed_json' and anomaly_score is null").count() == 1
    same_rows(out.filter("reject_reason is null").select("device_id", "anomaly_score", "rule_based_anomaly"),
              rule_score(wide).select("device_id", "anomaly_score", "rule_based_anomaly"))


@pytest.fixture(scope="module")
def flagged_files(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flagged") / "rows")
    rows = fixtures.flagged(spark, sf).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    rows = rows.select("device_id", "timestamp", "temperature", "vibration", "is_anomaly", "anomaly_score")
    # six days per file, written one after the other: a stream reads older files first
    for part in range(5):
        in_part = F.floor((F.dayofyear("timestamp") - 1) / 6) == part
        rows.filter(in_part).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


def open_stream(spark, path, files="1"):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files).parquet(path)


def to_memory(df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).start()
    query.processAllAvailable()
    query.stop()
    return df.sparkSession.table(name)


def test_anomaly_rate_alert(spark, flagged_files):
    live = to_memory(anomaly_rate_alert(open_stream(spark, flagged_files, "5")), "rates")
    batch = anomaly_rates(spark.read.parquet(flagged_files))
    # windows still open at the end of the stream have not been reported
    closed = live.agg(F.max("window_end")).first()[0]
    assert live.count() > 100
    same_rows(live, batch.filter(F.col("window_end") <= F.lit(closed)))


@pytest.mark.parametrize("salts", [1, 4])
def test_replay_safe_ingest(spark, flagged_files, salts):
    rows = open_stream(spark, flagged_files, "5").select("device_id", "timestamp", "temperature")
    twice = rows.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).drop("copy")
    out = to_memory(jobs.replay_safe_ingest(twice, salts=salts), f"once{salts}")
    same_rows(out, spark.read.parquet(flagged_files).select("device_id", "timestamp", "temperature"))


def test_alert_handler_and_subscription(spark, flagged_files, tmp_path):
    log = str(tmp_path / "log")
    drain(jobs.alert_handler(open_stream(spark, flagged_files), log, str(tmp_path / "state")))
    expected = spark.read.parquet(flagged_files).filter("is_anomaly")
    out = spark.read.parquet(log)
    assert out.count() == expected.count()
    assert out.first()["line"].startswith("Anomaly detected: Device sensor_")
    live = to_memory(jobs.anomaly_subscription(open_stream(spark, flagged_files)), "anomalies")
    same_rows(live, expected)


def test_publish_alerts_stream_and_batch(spark, inbox, tmp_path):
    def alerts(raw):
        return format_alert(apply_rules(P.validate_required(P.parse_messages(raw))))
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    drain(publish_alerts(alerts(message_stream(spark, "text", inbox)), a, checkpoint=str(tmp_path / "state")))
    publish_alerts(alerts(message_batch(spark, inbox)), b)
    same_rows(spark.read.text(a), spark.read.text(b))
    first = json.loads(spark.read.text(b).first()["value"])
    assert set(first) == {"alert_id", "device_id", "timestamp", "severity", "message", "details"}


FEATURES = ["device_id", "timestamp", "temperature", "vibration", "temp_change", "vibration_change",
            "temp_avg_5min", "vibration_avg_5min", "temp_stddev_10min", "vibration_stddev_10min"]


def test_stream_features_equal_the_view(spark, flagged_files):
    live = to_memory(stream_features(open_stream(spark, flagged_files)), "features")
    rows = spark.read.parquet(flagged_files).withColumnRenamed("vibration", "vibration_level") \
        .withColumn("device_type", F.lit("x"))
    same_rows(live.select(*FEATURES), W.training_view(rows, days=60).select(*FEATURES), digits=6)


def test_late_reading_is_scored_but_not_kept(spark, tmp_path):
    path = str(tmp_path / "late")
    schema = "device_id string, timestamp timestamp, temperature double, vibration double"

    def add(*rows):
        frame = spark.createDataFrame([("d", m, t, 1.0) for m, t in rows], schema.replace("timestamp timestamp", "m int"))
        frame.withColumn("timestamp", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,m,0)")) \
            .select("device_id", "timestamp", "temperature", "vibration").coalesce(1).write.mode("append").parquet(path)

    add((1, 10.0), (3, 20.0))
    query = stream_features(spark.readStream.schema(schema).parquet(path)).writeStream.format("memory") \
        .queryName("late").start()
    query.processAllAvailable()
    add((2, 50.0))
    query.processAllAvailable()
    add((4, 26.0))
    query.processAllAvailable()
    query.stop()
    change = {r["temperature"]: r["temp_change"] for r in spark.table("late").collect()}
    assert change == {10.0: None, 20.0: 10.0, 50.0: 30.0, 26.0: 6.0}
