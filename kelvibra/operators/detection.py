"""Scoring against forecasts and distances; joining, combining and voting detectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.functions.expressions import above


def cross_scalar(df: DataFrame, stats: DataFrame) -> DataFrame:
    """C2. Adds the columns of a one-row frame to every row. They come in as scalar subqueries, so
    there is no join; more than one row in `stats` is an error."""
    return df.withColumns({c: stats.select(c).scalar() for c in stats.columns})


def devices_with_history(df: DataFrame, min_rows: int = 100, history: DataFrame | None = None) -> DataFrame:
    """C3. Rows of devices with more than min_rows readings in the history (by default df itself)."""
    counted = (df if history is None else history).groupBy("device_id").agg(F.count(F.lit(1)).alias("n"))
    return df.join(counted.filter(F.col("n") > min_rows).select("device_id"), "device_id", "left_semi")


def join_forecast(actual: DataFrame, forecast: DataFrame,
                  keep_above: float = S.FORECAST_KEEP_ABOVE) -> DataFrame:
    """C1. Readings with the forecast of their device and hour, where they differ by more than
    keep_above."""
    hourly = actual.withColumn("hour_bucket", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    error = F.abs(F.col("actual_temperature") - F.col("predicted_temperature"))
    return (hourly.join(forecast, ["device_id", "hour_bucket"])
            .withColumn("prediction_error", error).filter(above("prediction_error", keep_above)))


def forecast_anomalies(readings: DataFrame, forecast: DataFrame) -> DataFrame:
    """J10. Scores readings by their forecast: outside the interval, or by the size of the error."""
    actual = readings.select("device_id", "timestamp", F.col("temperature").alias("actual_temperature"))
    value = F.col("actual_temperature")
    outside = (value < F.col("prediction_interval_lower_bound")) | \
        (value > F.col("prediction_interval_upper_bound"))

    def ladder(place: int) -> Column:
        out = F.when(outside, F.lit(S.FORECAST_OUTSIDE[place]))
        for limit, *result in S.FORECAST_STEPS:
            out = out.when(F.col("prediction_error") > limit, F.lit(result[place]))
        return out.otherwise(F.lit(S.FORECAST_ELSE[place]))

    return join_forecast(actual, forecast).select(
        "device_id", "timestamp", "actual_temperature", "predicted_temperature",
        "prediction_interval_lower_bound", "prediction_interval_upper_bound", "prediction_error",
        ladder(0).alias("anomaly_score"), ladder(1).alias("anomaly_severity"),
        F.lit(S.METHODS["forecast"]).alias("detection_method"))


def distance_anomalies(distances: DataFrame, quantiles: DataFrame,
                       column: str = "distance_to_centroid") -> DataFrame:
    """J8, second half. Rows beyond the lowest listed quantile of the distance, scored by the highest
    they exceed."""
    steps = S.DISTANCE_STEPS
    limits = {p: quantiles.select(f"p{round(p * 100)}").scalar() for p, *_ in steps}

    def ladder(place: int) -> Column:
        return reduce(lambda acc, step: acc.when(F.col(column) > limits[step[0]], F.lit(step[place])),
                      steps, F)

    return distances.filter(F.col(column) > limits[min(limits)]).withColumns({
        "anomaly_score": ladder(1), "anomaly_severity": ladder(2),
        "detection_method": F.lit(S.METHODS["clusters"])})


def unified_anomalies(*branches: DataFrame) -> DataFrame:
    """G1. All detections in the five shared columns."""
    return reduce(DataFrame.unionByName, (b.select(*S.DETECTION_COLUMNS) for b in branches))


def ensemble_vote(df: DataFrame, flags: list[str], name: str = "ensemble") -> DataFrame:
    """J15. 1 where more than half of the detectors flag the row; a tie is 0, a null flag is none."""
    votes = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in flags), F.lit(0.0))
    return df.withColumn(name, (votes / F.lit(float(len(flags))) > 0.5).cast("int"))


def join_votes(key: str, **flags: DataFrame) -> DataFrame:
    """J15. Aligns detectors that were scored apart: one row per key, one flag column per detector. A row
    that a detector does not have is not flagged by it."""
    named = [f.select(key, F.col("flag").cast("int").alias(n)) for n, f in flags.items()]
    return reduce(lambda a, b: a.join(b, key, "full"), named).fillna(0, list(flags))


def ensemble_score(df: DataFrame, decisions: list[str], name: str = "ensemble_score") -> DataFrame:
    """J16. Mean of the negated decision values, nulls counting as 0; higher is more anomalous."""
    total = sum((-F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in decisions), F.lit(0.0))
    return df.withColumn(name, total / F.lit(float(len(decisions))))
