"""Telemetry tables derived from the `events` test table by plain column arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.functions.expressions import choose, iso_text
from kelvibra.operators.evaluation import evaluate
from kelvibra.operators.rules import apply_rules, wide_features
from kelvibra.plans.lineage import cut
from kelvibra.settings import MODEL_PERFORMANCE

EVENT_DEVICES = {"click": "industrial_sensor", "view": "hvac_monitor", "error": "machinery_sensor"}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("double")


def _readings(ev: DataFrame, *extra) -> DataFrame:
    return ev.select(
        F.col("event_id").alias("reading_id"),
        F.format_string("sensor_%04d", "user_id").alias("device_id"),
        F.coalesce(choose("event_type", EVENT_DEVICES, None), "event_type").alias("device_type"),
        F.col("ts").alias("timestamp"),
        (F.lit(9.0) + F.col("value") / F.lit(4.0)).alias("temperature"),
        F.round(_k() * _k() / F.lit(1200.0), 3).alias("vibration"),
        (F.col("event_type") == "error").alias("true_anomaly"),
        *extra)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(events(spark, sf_dir))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with the rules applied; is_anomaly is the verdict."""
    return apply_rules(readings(spark, sf_dir)).withColumn("is_anomaly", F.col("anomaly_detected"))


def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as the stored table has them, as far as the features need it."""
    return flagged(spark, sf_dir).select(
        "reading_id", "device_id", "device_type", "timestamp", "temperature",
        F.col("vibration").alias("vibration_level"), "is_anomaly", "true_anomaly")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages, five in fifty damaged in five ways."""
    user = F.col("user_id")
    location = F.struct(
        F.concat(F.lit("Building_"), F.substring(F.lit("ABC"), (user % 3 + 1).cast("int"), F.lit(1)))
        .alias("building"),
        (user % 10 + 1).alias("floor"),
        F.concat(F.lit("Room_"), (user % 900 + 100).cast("string")).alias("room"))
    rows = _readings(events(spark, sf_dir), location.alias("location"))
    case = F.col("reading_id") % 50

    def message(temperature):
        return F.to_json(F.struct(
            F.when(case != 5, F.col("device_id")).alias("device_id"),
            F.when(case == 4, "nope").otherwise(iso_text("timestamp")).alias("timestamp"),
            "device_type", "location",
            F.struct(temperature.alias("temperature"), F.col("vibration").alias("vibration"))
            .alias("sensor_data"),
            F.col("true_anomaly").alias("is_anomaly")))

    whole = message(F.when(case != 2, F.col("temperature")))
    texted = message(F.col("temperature").cast("string"))
    raw = F.when(case == 1, F.substring(whole, F.lit(1), F.length(whole) - 20)) \
        .when(case == 3, texted).otherwise(whole)
    return rows.select(raw.alias("raw"))


def readings_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event = F.col("user_id"), F.col("event_id")
    rows = _readings(events(spark, sf_dir), "user_id", "event_id", "value", _k().alias("k"))
    temperature = F.when(event % 97 == 0, F.lit(-999.0)) \
        .when(event % 13 == 0, F.lit(-60.0) + F.col("value")).otherwise(F.col("temperature"))
    rows = rows.withColumns({
        "temperature": temperature,
        "humidity": F.col("k") * F.lit(1.2) - F.lit(5.0),
        "pressure": (F.lit(780) + event % 450).cast("double"),
        "vibration_level": F.when(event % 11 != 0, F.col("vibration")),
        "power_consumption": F.when(event % 7 != 0, F.col("value") * F.lit(2.0)),
        "zone": F.substring(F.lit("ABCD"), (user % 4 + 1).cast("int"), F.lit(1)),
        "criticality": F.when(user % 4 == 0, "low").when(user % 4 == 1, "medium")
        .when(user % 4 == 2, "high"),
    })
    return rows.withColumn("heat_index", F.col("temperature") + F.lit(0.05) * F.col("humidity")) \
        .drop("user_id", "event_id", "value", "k")


def wide_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide readings with the detectors' features."""
    return wide_features(readings_wide(spark, sf_dir))


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three threshold models with their scores, one line per model and reading."""
    rows = _readings(events(spark, sf_dir), _k().alias("k"))
    tops = rows.agg(F.max("vibration").alias("v"), F.max("temperature").alias("t"), F.max("k").alias("k"))

    def model(name, column, flag, top):
        return F.struct(F.lit(name).alias("model_name"), flag.cast("int").alias("y_pred"),
                        (F.col(column) / tops.select(top).scalar()).alias("score"))

    models = F.array(
        model("vibration_rule", "vibration", F.col("vibration") > 5, "v"),
        model("temperature_rule", "temperature", F.col("temperature") > 30, "t"),
        model("load_rule", "k", F.col("k") >= 80, "k"))
    return rows.select("reading_id", "timestamp", F.col("true_anomaly").cast("int").alias("y_true"),
                       F.inline(models)).withColumn("model_version", F.lit("1"))


def model_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An evaluation per model and day; the area is missing on even days."""
    day = F.date_trunc("day", "timestamp").cast("timestamp_ntz")
    keys = ["model_name", "model_version", "evaluation_timestamp"]
    scored = scored_models(spark, sf_dir).withColumn("evaluation_timestamp", day)
    sizes = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("evaluation_data_size"))
    lines = evaluate(scored, keys).join(sizes, keys)
    area = F.when(F.dayofmonth("evaluation_timestamp") % 2 == 1, F.col("auc_roc"))
    table = lines.withColumn("auc_roc", area) \
        .withColumn("training_data_size", F.lit(8000).cast("bigint")) \
        .select(*MODEL_PERFORMANCE.names)
    return cut(table)  # a stored table, as the reports read it
