"""Threshold rules on single readings. No joins, no shuffles: every function is one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.functions.expressions import above, below, choose, col, iso_text
from kelvibra.plans.broadcasts import broadcast_if_few


def limits_lookup(df: DataFrame, limits: DataFrame, default: str = S.DEFAULT_DEVICE_TYPE) -> DataFrame:
    """C4. Limits from a table (device_type, then limit columns), for configurations kept as data; the
    row of the default type serves unknown and null types. A short table is broadcast."""
    names = [c for c in limits.columns if c != "device_type"]
    fallback = limits.filter(F.col("device_type") == default)
    joined = df.join(broadcast_if_few(limits), "device_type", "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), fallback.select(c).scalar()) for c in names})


def _text(value: Column) -> Column:
    return value.cast("string")


def _list(reason: Column) -> Column:
    """A list of one reason or of none."""
    return F.when(reason.isNotNull(), F.array(reason)).otherwise(F.array().cast("array<string>"))


def detect_temperature(df: DataFrame, limits: Mapping = S.TEMPERATURE_LIMITS,
                       default: str = S.DEFAULT_DEVICE_TYPE) -> DataFrame:
    """B3. temp_anomaly and temp_reasons. A reading equal to a limit is normal; so is NaN."""
    value = F.col("temperature")
    low = {k: v[0] for k, v in limits.items()}
    high = {k: v[1] for k, v in limits.items()}
    least, most = (choose("device_type", t, t[default]) for t in (low, high))
    cold, hot = below(value, least), above(value, most)
    reason = (
        F.when(cold, F.concat(F.lit("Temperature too low: "), _text(value), F.lit("°C < "),
                              _text(least), F.lit("°C")))
        .when(hot, F.concat(F.lit("Temperature too high: "), _text(value), F.lit("°C > "),
                            _text(most), F.lit("°C")))
    )
    return df.withColumns({"temp_anomaly": cold | hot, "temp_reasons": _list(reason)})


def detect_vibration(df: DataFrame, limits: Mapping = S.VIBRATION_LIMITS,
                     default: str = S.DEFAULT_DEVICE_TYPE) -> DataFrame:
    """B4. vibration_anomaly and vibration_reasons."""
    value = F.col("vibration")
    most = choose("device_type", limits, limits[default])
    shaken = above(value, most)
    reason = F.when(shaken, F.concat(F.lit("Vibration too high: "), _text(value), F.lit(" mm/s > "),
                                     _text(most), F.lit(" mm/s")))
    return df.withColumns({"vibration_anomaly": shaken, "vibration_reasons": _list(reason)})


def combine_flags(df: DataFrame) -> DataFrame:
    """B5. anomaly_detected and anomaly_severity: critical for both flags, warning for one."""
    t, v = F.col("temp_anomaly"), F.col("vibration_anomaly")
    severity = F.when(t & v, "critical").when(t | v, "warning").otherwise("normal")
    return df.withColumns({"anomaly_detected": t | v, "anomaly_severity": severity})


def merge_reasons(df: DataFrame) -> DataFrame:
    """B6. anomaly_reasons: temperature's, then vibration's."""
    return df.withColumn("anomaly_reasons", F.concat("temp_reasons", "vibration_reasons"))


def flag_score(df: DataFrame) -> DataFrame:
    """B7. anomaly_score: 0 without a flag, 0.6 with one, 1 with both."""
    flags = F.col("temp_anomaly").cast("int") + F.col("vibration_anomaly").cast("int")
    factor = choose("anomaly_severity", S.SEVERITY_FACTORS, 1.0)
    return df.withColumn("anomaly_score", F.least(F.lit(1.0), flags * F.lit(S.FLAG_WEIGHT) * factor))


def baseline_zscore(df: DataFrame, baselines: Mapping = S.BASELINES) -> DataFrame:
    """B8. temp_z_score, vibration_z_score against fixed baselines; 0 for a deviation of 0 or less.
    (Other operators give the same names to other z-scores: see features.)"""
    names = {"temperature": "temp_z_score", "vibration": "vibration_z_score"}
    scores = {}
    for source, name in names.items():
        mean, deviation = baselines[source]
        z = (F.col(source) - F.lit(mean)) / F.lit(deviation) if deviation > 0 else \
            F.when(F.col(source).isNotNull(), F.lit(0.0))
        scores[name] = z
    return df.withColumns(scores)


def apply_rules(df: DataFrame) -> DataFrame:
    """B3 to B8 on records with device_type, temperature and vibration."""
    for step in (detect_temperature, detect_vibration, combine_flags, merge_reasons, flag_score,
                 baseline_zscore):
        df = df.transform(step)
    return df


def format_reading(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """B9. The stored reading. is_anomaly is the rule's verdict, anomaly_type repeats the severity,
    location and reasons are JSON text. A record without location gets {}."""
    stamp = F.current_timestamp() if processed_at is None else processed_at
    values = {
        "location": F.coalesce(F.to_json("location"), F.lit("{}")),
        "processed_at": stamp,
        "vibration_level": F.col("vibration"),
        "is_anomaly": F.col("anomaly_detected"),
        "anomaly_type": F.col("anomaly_severity"),
        "anomaly_reasons": F.to_json("anomaly_reasons"),
    }
    return df.select(*[values.get(c, F.col(c)).alias(c) for c in S.READING_COLUMNS])


def format_alert(df: DataFrame) -> DataFrame:
    """B10. One alert per flagged record, with the readings and reasons nested in `details`."""
    when = F.col("timestamp_text") if "timestamp_text" in df.columns else iso_text("timestamp")
    details = F.struct("temperature", "vibration", F.col("anomaly_reasons").alias("reasons"), "location")
    return df.filter("anomaly_detected").select(
        F.concat_ws("_", "device_id", when).alias("alert_id"),
        "device_id",
        when.alias("timestamp"),
        F.col("anomaly_severity").alias("severity"),
        F.concat(F.lit("Anomaly detected on device "), "device_id").alias("message"),
        details.alias("details"),
    )


def rule_score(df: DataFrame) -> DataFrame:
    """B11. anomaly_score and rule_based_anomaly of wide records. Points add up band by band; a failure
    reading sets the score to 1 before vibration is looked at; the cap comes last. Null counts as
    missing."""
    readings = {name: F.coalesce(col(name), F.lit(missing)) for name, missing, _ in S.RULE_BANDS}
    score = F.lit(0.0)
    for name, _, bands in S.RULE_BANDS:
        for low, high, points in bands:
            outside = below(readings[name], low) | above(readings[name], high)
            score = score + F.when(outside, points).otherwise(0.0)
    failed = F.lit(False)
    for name, sentinel in S.FAILURE_READINGS.items():
        failed = failed | (readings[name] == sentinel)
    score = F.when(failed, 1.0).otherwise(score)
    name, missing, limit, points = S.RULE_VIBRATION
    shaken = above(F.coalesce(col(name), F.lit(missing)), limit)
    score = F.least(F.lit(1.0), score + F.when(shaken, points).otherwise(0.0))
    return (df.withColumn("anomaly_score", score)
            .withColumn("rule_based_anomaly", F.col("anomaly_score") > S.RULE_FLAG_ABOVE))


def encode_categories(df: DataFrame, codes: Mapping = S.CATEGORY_CODES) -> DataFrame:
    """B12. <column>_encoded for device type, zone and criticality."""
    return df.withColumns({f"{c}_encoded": choose(c, table, other) for c, (table, other) in codes.items()})


def coalesce_features(df: DataFrame) -> DataFrame:
    """B13. Missing vibration and power count as 0."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0))
                           for c in ("vibration_level", "power_consumption")})


def wide_features(df: DataFrame) -> DataFrame:
    """The numeric features of the wide detectors: B12, B13 and the hour."""
    return (df.transform(encode_categories).transform(coalesce_features)
            .withColumn("hour_of_day", F.hour("timestamp")))
