"""Aggregates behind the monitoring page. All of them combine partially before the shuffle. A reading that is
null or NaN is counted as a row and left out of means, deviations and extremes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvibra.functions.expressions import above, col, known
from kelvibra.functions.quantiles import exact_quantiles
from kelvibra.operators.scans import scan_range

FLAG = "is_anomaly"


def share(flags: Column, of: Column | None = None) -> Column:
    """Share of rows with the flag; 0 when there are none."""
    return F.coalesce(F.try_divide(F.count_if(flags), of if of is not None else F.count(F.lit(1))),
                      F.lit(0.0))


def device_profile(df: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    """D1. Mean, deviation and count per device and type over the last days (stored readings)."""
    return scan_range(df, f"{days} DAYS", as_of).groupBy("device_id", "device_type").agg(
        F.avg(known("temperature")).alias("avg_temperature"),
        F.avg(known("vibration_level")).alias("avg_vibration"),
        F.stddev_samp(known("temperature")).alias("temp_variability"),
        F.stddev_samp(known("vibration_level")).alias("vibration_variability"),
        F.count(F.lit(1)).alias("reading_count"))


def anomaly_summary(detections: DataFrame, as_of=None, days: int = 1) -> DataFrame:
    """D2. Per device and method over the last days: counts by severity, scores, first and last time."""
    def severity(name):
        return F.count_if(F.col("anomaly_severity") == name).alias(f"{name.lower()}_severity_count")
    return scan_range(detections, f"{days} DAYS", as_of).groupBy("device_id", "detection_method").agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        F.avg("anomaly_score").alias("avg_anomaly_score"),
        F.max("anomaly_score").alias("max_anomaly_score"),
        severity("HIGH"), severity("MEDIUM"), severity("LOW"),
        F.min("timestamp").alias("first_anomaly"),
        F.max("timestamp").alias("last_anomaly"))


def order_summary(summary: DataFrame) -> DataFrame:
    """F5. Most anomalies first, then the higher mean score; names settle ties."""
    return summary.orderBy(F.desc("anomaly_count"), F.desc("avg_anomaly_score"),
                           "device_id", "detection_method")


def severity_counts(df: DataFrame) -> DataFrame:
    """Readings per device and severity, and the mean score."""
    return df.groupBy("device_id", "anomaly_severity").agg(
        F.count(F.lit(1)).alias("readings"), F.avg("anomaly_score").alias("avg_score"))


def distance_quantiles(df: DataFrame, column: str, probs=(0.95, 0.99), exact: bool = False,
                       accuracy: int = 10_000) -> DataFrame:
    """D3. One row p95, p99, ... from a bounded sketch, or exact (which runs jobs)."""
    names = [f"p{round(p * 100)}" for p in probs]
    if exact:
        values = exact_quantiles(df, column, probs, "disc")
        schema = ", ".join(f"{n} double" for n in names)
        return df.sparkSession.createDataFrame([tuple(values)], schema)
    sketch = df.agg(F.percentile_approx(column, list(probs), accuracy).alias("q"))
    return sketch.select(*[F.col("q")[i].alias(n) for i, n in enumerate(names)])


def kpis(df: DataFrame, flag: str = FLAG, approx_devices: bool = False) -> DataFrame:
    """D4. Readings, anomalies and their percentage, devices, mean temperature."""
    devices = F.approx_count_distinct("device_id") if approx_devices else F.count_distinct("device_id")
    return df.agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if(F.col(flag)).alias("anomaly_count"),
        (share(F.col(flag)) * 100).alias("anomaly_rate"),
        devices.alias("active_devices"),
        F.avg(known("temperature")).alias("avg_temperature"))


def device_stats(df: DataFrame, digits: int = 2, flag: str = FLAG) -> DataFrame:
    """D5. Per device mean, deviation, least and most of both readings, and the anomalies. Rounds half
    up."""
    measures = []
    for c in ("temperature", "vibration"):
        for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            measures.append(F.round(f(known(c)), digits).alias(f"{c}_{name}"))
    return df.groupBy("device_id").agg(*measures, F.count_if(F.col(flag)).alias(f"{flag}_sum"))


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = FLAG) -> DataFrame:
    """D6. Equal-width bins between the least and the greatest value, the greatest in the last bin; one
    count per bin and class. Null and NaN are left out. A constant column fills bin 0."""
    values = df.filter(F.col(column).isNotNull() & ~F.isnan(column))
    ends = values.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    lo, hi = (ends.select(c).scalar() for c in ("lo", "hi"))
    place = F.try_divide(F.col(column) - lo, hi - lo) * F.lit(float(bins))
    number = F.least(F.lit(bins - 1), F.floor(F.coalesce(place, F.lit(0.0))).cast("int"))
    classes = [by] if by else []
    return (values.groupBy(*classes, number.alias("bin")).agg(F.count(F.lit(1)).alias("readings"))
            .withColumns({"bin_start": lo + (hi - lo) * F.col("bin") / F.lit(float(bins)),
                          "bin_end": lo + (hi - lo) * (F.col("bin") + 1) / F.lit(float(bins))}))


def temp_vibration_relation(df: DataFrame, flag: str = FLAG) -> DataFrame:
    """D7. Per class: readings, correlation of temperature and vibration, their means."""
    return df.groupBy(flag).agg(
        F.count(F.lit(1)).alias("readings"),
        F.corr(known("temperature"), known("vibration")).alias("correlation"),
        F.avg(known("temperature")).alias("avg_temperature"),
        F.avg(known("vibration")).alias("avg_vibration"))


def temp_vibration_grid(df: DataFrame, temperature_step: float = 5.0, vibration_step: float = 1.0,
                        flag: str = FLAG) -> DataFrame:
    """D7. The scatter as counts on a grid, so that its size does not grow with the readings."""
    return df.groupBy(
        flag,
        F.floor(known("temperature") / F.lit(temperature_step)).alias("temperature_cell"),
        F.floor(known("vibration") / F.lit(vibration_step)).alias("vibration_cell"),
    ).agg(F.count(F.lit(1)).alias("readings"))


def anomaly_rate(predictions: DataFrame, flags: list[str]) -> DataFrame:
    """D14. Share of flagged rows per detector column, one row each."""
    shares = predictions.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in flags])
    return shares.unpivot([], flags, "detector", "anomaly_rate")


def split_by_verdict(df: DataFrame, flag: str = FLAG) -> tuple[DataFrame, DataFrame]:
    """B18. Normal and flagged readings."""
    return df.filter(~F.col(flag)), df.filter(F.col(flag))


def zscore_flag(df: DataFrame, columns=("temp_z_score", "vibration_z_score"), k: float = 2.0) -> DataFrame:
    """B19. <column>_outside where abs(z) > k; false where z is null."""
    return df.withColumns({f"{c}_outside": above(F.abs(col(c)), k) for c in columns})
