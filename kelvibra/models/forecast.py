"""J9. Hourly temperature forecast per device: a straight trend plus an hour-of-day effect.

It is not an ARIMA model. Readings are reduced to six sums per device, type and hour before anything is
shuffled; these are written once, and trend, effects and residual deviation follow from them, so the
readings are read once and never joined. An hour with fewer than `min_cell` readings takes its device type's effect.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known
from kelvibra.operators.scans import range_start
from kelvibra.plans.lineage import cut


def _hours_since(moment: Column, origin: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), moment).cast("double")
    return (F.datediff(moment, origin) * F.lit(24.0) + F.hour(moment)
            + F.minute(moment) / F.lit(60.0) + seconds / F.lit(3600.0))


def forecast_temperature(df: DataFrame, as_of=None, horizon: int = 24, level: float = 0.95,
                         min_rows: int = 100, days: int = 14, min_cell: int = 3) -> DataFrame:
    """One line per device and hour: device_id, hour_bucket, predicted_temperature and the bounds of
    the `level` interval. The horizon ends with as_of's hour; training uses the readings of the last
    `days` before the horizon, and devices with more than min_rows readings over all time."""
    kind = dict(df.dtypes)["timestamp"]
    start = range_start(df, f"{days} DAYS", as_of)
    first = F.date_trunc("hour", range_start(df, f"{horizon - 1} HOURS", as_of)).cast(kind)
    origin = start.cast("date")
    t, y = _hours_since(F.col("timestamp"), origin), known("temperature")

    cells = (
        df.filter((F.col("timestamp") >= start) & (F.col("timestamp") < first) & y.isNotNull())
        .select("device_id", "device_type", "timestamp", F.hour("timestamp").alias("hour"),
                y.alias("y"), t.alias("t"))
        .groupBy("device_id", "device_type", "hour")
        .agg(F.count("y").alias("n"), F.sum("y").alias("sy"), F.sum("t").alias("st"),
             F.sum(F.col("y") * F.col("y")).alias("syy"), F.sum(F.col("t") * F.col("y")).alias("sty"),
             F.sum(F.col("t") * F.col("t")).alias("stt"), F.max("timestamp").alias("latest")))
    cells = cut(cells)  # read for the devices and for the types

    device = Window.partitionBy("device_id")
    total = {c: F.sum(c).over(device) for c in ("n", "sy", "st", "sty", "stt")}
    slope = F.coalesce(F.try_divide(total["n"] * total["sty"] - total["st"] * total["sy"],
                                    total["n"] * total["stt"] - total["st"] * total["st"]), F.lit(0.0))
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    trended = (
        cells.withColumn("b", slope)
        .withColumn("a", (total["sy"] - F.col("b") * total["st"]) / total["n"])
        .withColumn("own_type", F.max_by("device_type", "latest").over(device))
        .withColumns({
            "r": F.col("sy") - a * n - b * F.col("st"),
            "rr": F.col("syy") + n * a * a + b * b * F.col("stt") - 2 * a * F.col("sy")
            - 2 * b * F.col("sty") + 2 * a * b * F.col("st")}))

    # at most 24 hours per type and per device: short maps
    by_type = (
        trended.groupBy("device_type", "hour").agg((F.sum("r") / F.sum("n")).alias("effect"))
        .groupBy(F.col("device_type").alias("own_type"))
        .agg(F.map_from_entries(F.collect_list(F.struct("hour", "effect"))).alias("type_effects")))

    def type_effect(hour: Column) -> Column:
        return F.coalesce(F.try_element_at("type_effects", hour), F.lit(0.0))

    hours = (
        trended.groupBy("device_id", "hour")
        .agg(F.sum("n").alias("n"), F.sum("r").alias("r"), F.sum("rr").alias("rr"),
             F.first("a").alias("a"), F.first("b").alias("b"), F.first("own_type").alias("own_type"))
        .join(by_type, "own_type", "left")
        .withColumn("effect", F.when(n >= min_cell, F.col("r") / n).otherwise(type_effect(F.col("hour")))))
    e = F.col("effect")
    squares = F.sum(F.col("rr") - 2 * e * F.col("r") + n * e * e)
    models = hours.groupBy("device_id").agg(
        F.first("a").alias("a"), F.first("b").alias("b"), F.first("type_effects").alias("type_effects"),
        F.map_from_entries(F.collect_list(F.struct("hour", "effect"))).alias("effects"),
        F.sqrt(F.greatest(F.try_divide(squares, F.sum("n") - 1), F.lit(0.0))).alias("deviation"))

    history = df.groupBy("device_id").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > min_rows)
    kept = models.join(history.select("device_id"), "device_id", "left_semi")

    steps = F.explode(F.sequence(first, first + F.expr(f"INTERVAL {horizon - 1} HOURS"),
                                 F.expr("INTERVAL 1 HOURS")))
    lines = kept.withColumn("hour_bucket", steps)
    hour = F.hour("hour_bucket")
    effect = F.coalesce(F.try_element_at("effects", hour), type_effect(hour))
    value = a + b * _hours_since(F.col("hour_bucket"), origin) + effect
    reach = F.lit(NormalDist().inv_cdf(0.5 + level / 2)) * F.col("deviation")
    return lines.select("device_id", "hour_bucket", value.alias("predicted_temperature"),
                        (value - reach).alias("prediction_interval_lower_bound"),
                        (value + reach).alias("prediction_interval_upper_bound"))
