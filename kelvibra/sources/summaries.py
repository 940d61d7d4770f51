"""Summaries by day beside a table of readings, from which common questions are answered without reading it.

Each append adds a line for every day it touches: counts, least and greatest values, sums, a distinct sketch of the devices
(HyperLogLog) and a quantile sketch of each value (KLL). Lines of a day merge, so nothing is rewritten. Counts, sums,
first and last time are exact; the number of devices is off by about 1.04 / sqrt(2^DEVICE_BITS) = 1.6 %, a quantile's rank
by about QUANTILE_ERROR of the readings (both as standard errors of the sketches).

If a job ends between the append and its summary, `rebuild_days` replaces the lines of the days concerned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known

VALUES = ("temperature", "vibration_level")
DEVICE_BITS = 12
QUANTILE_SIZE = 1_000
QUANTILE_ERROR = 0.003


def summarize_days(readings: DataFrame, cols: Sequence[str] = VALUES, flag: str = "is_anomaly") -> DataFrame:
    """A line per day: event_date, readings, anomalies, first, last, devices, and per value its known readings, sum, least,
    greatest and sketch. Rows without a time are a day of their own."""
    measures = [F.count(F.lit(1)).alias("readings"), F.count_if(F.col(flag)).alias("anomalies"),
                F.min("timestamp").alias("first"), F.max("timestamp").alias("last"),
                F.hll_sketch_agg("device_id", F.lit(DEVICE_BITS)).alias("devices")]
    for c in cols:
        value = known(F.col(c).cast("double"))
        measures += [F.count(value).alias(f"{c}_known"), F.sum(value).alias(f"{c}_sum"), F.min(value).alias(f"{c}_min"),
                     F.max(value).alias(f"{c}_max"), F.kll_sketch_agg_double(value, F.lit(QUANTILE_SIZE)).alias(f"{c}_sketch")]
    return readings.groupBy(F.to_date("timestamp").alias("event_date")).agg(*measures)


def append_summaries(readings: DataFrame, path: str, **options) -> None:
    """Adds the lines of a batch of readings; few and small, in one file a batch."""
    summarize_days(readings, **options).coalesce(1).write.mode("append").partitionBy("event_date").parquet(path)


def rebuild_days(readings: DataFrame, path: str, **options) -> None:
    """Replaces the lines of the days that the given readings, all of those days, cover."""
    summarize_days(readings, **options).coalesce(1).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def newest(summaries: DataFrame) -> Column:
    """The time of the newest reading, to be given as `as_of` to range scans: a scalar over one line a day and append."""
    return summaries.agg(F.max("last")).scalar()


def kpis_of(summaries: DataFrame) -> DataFrame:
    """D4 from summaries: the same columns; active_devices is approximate."""
    merged = summaries.agg(
        F.sum("readings").alias("n"), F.sum("anomalies").alias("a"), F.hll_union_agg("devices").alias("d"),
        F.sum("temperature_sum").alias("s"), F.sum("temperature_known").alias("k"))
    return merged.select(
        F.coalesce("n", F.lit(0)).alias("total_readings"), F.coalesce("a", F.lit(0)).alias("anomaly_count"),
        (F.try_divide("a", "n") * 100).alias("anomaly_rate"),
        F.coalesce(F.hll_sketch_estimate("d"), F.lit(0)).alias("active_devices"), F.try_divide("s", "k").alias("avg_temperature"))


def quantiles_of(summaries: DataFrame, column: str, probs: Sequence[float] = (0.95, 0.99)) -> DataFrame:
    """D3 from summaries: one row p95, p99, ..., null without known readings."""
    merged = summaries.filter(F.col(f"{column}_known") > 0).agg(
        F.kll_merge_agg_double(f"{column}_sketch", F.lit(QUANTILE_SIZE)).alias("q"), F.sum(f"{column}_known").alias("n"))
    return merged.select(*[F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("q", F.lit(float(p))))
                           .alias(f"p{round(p * 100)}") for p in probs])
