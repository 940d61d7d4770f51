"""S3. Anomaly rate over sliding windows, on streams and on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def anomaly_rate_alert(stream: DataFrame, window: str = "5 minutes", slide: str = "1 minute",
                       rate: float = 0.1, delay: str = "10 minutes", flag: str = "is_anomaly") -> DataFrame:
    """Windows whose share of flagged readings exceeds the rate, each once its watermark has passed.
    Counts combine within a partition before the shuffle."""
    counted = (
        stream.withWatermark("timestamp", delay).groupBy(F.window("timestamp", window, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("readings"), F.count_if(F.col(flag)).alias("anomalies")))
    return _over(counted, rate)


def anomaly_rates(df: DataFrame, window_minutes: int = 5, slide_minutes: int = 1, rate: float = 0.1,
                  flag: str = "is_anomaly") -> DataFrame:
    """The same on a table. Readings are first counted per slide step; only those counts are repeated
    for the windows they belong to."""
    if window_minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    kind = dict(df.dtypes)["timestamp"]
    step = F.window("timestamp", f"{slide_minutes} minutes")["start"].cast(kind)
    steps = df.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col(flag)).alias("anomalies"))
    first = F.col("step") - F.expr(f"INTERVAL {window_minutes - slide_minutes} MINUTES")
    starts = F.explode(F.sequence(first, F.col("step"), F.expr(f"INTERVAL {slide_minutes} MINUTES")))
    length = F.expr(f"INTERVAL {window_minutes} MINUTES")
    counted = (
        steps.withColumn("start", starts).groupBy("start")
        .agg(F.sum("readings").alias("readings"), F.sum("anomalies").alias("anomalies"))
        .withColumn("w", F.struct(F.col("start"), (F.col("start") + length).alias("end"))))
    return _over(counted, rate)


def _over(counted: DataFrame, rate: float) -> DataFrame:
    share = F.col("anomalies") / F.col("readings")
    return counted.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "readings",
        "anomalies", share.alias("anomaly_rate")).filter(F.col("anomaly_rate") > F.lit(rate))
