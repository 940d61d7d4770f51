"""J9 from now on: hourly temperature per device after `as_of`, with errors that are correlated in time.

A device's hourly means are a straight trend, an hour-of-day effect and an autoregressive rest. Readings become one line
per device and hour before anything is shuffled; after that a device is at most 24 * days lines, and from the rests on one
line with an array of that length. Autocovariances are sums of products of the array with itself, shifted; pairs with a
missing hour are left out. The Levinson-Durbin recursion turns them into coefficients order by order; a partial
correlation is kept within +-MOST_PARTIAL, so that every model is stationary. Of the orders 0 .. `order` the one of least
AIC stays. An hour without readings takes the value the model expects.

Intervals are of the hour's mean. They widen with the time since the device's last reading, as the errors to come add up,
and hold the uncertainty of the hour's effect.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known
from kelvibra.operators.scans import moment_of, range_start

MOST_PARTIAL = 0.98
MIN_PAIRS = 8  # of hours, for a lag to count


def hourly_rests(df: DataFrame, as_of=None, days: int = 14, min_cell: int = 3) -> DataFrame:
    """A line per device with readings in the last days * 24 hours up to as_of's: origin (its hour), a and b (level and
    slope per hour, the origin being hour 0), effects and cells (per hour of day: effect and number of hours), rests (an
    array by hour, null where there are no readings), used (parameters fitted)."""
    kind = dict(df.dtypes)["timestamp"]
    length = days * 24
    last = range_start(df, "0 HOURS", as_of) if as_of is None else moment_of(df, as_of, "timestamp")
    origin = F.date_trunc("hour", last).cast(kind)
    start = origin - F.expr(f"INTERVAL {length - 1} HOURS")
    y = known("temperature")
    rows = df.filter((F.col("timestamp") >= start) & (F.col("timestamp") <= last) & y.isNotNull())
    hours = (
        rows.select("device_id", "device_type", "timestamp", F.date_trunc("hour", "timestamp").cast(kind).alias("at"), y.alias("y"))
        .groupBy("device_id", "at").agg(F.avg("y").alias("m"), F.max_by("device_type", "timestamp").alias("type"))
        .withColumn("t", F.timestamp_diff("HOUR", origin, F.col("at")).cast("double")))
    device = Window.partitionBy("device_id")
    n, st, sm = F.count("t").over(device), F.sum("t").over(device), F.sum("m").over(device)
    stm, stt = F.sum(F.col("t") * F.col("m")).over(device), F.sum(F.col("t") * F.col("t")).over(device)
    trended = (
        hours.withColumn("hour", F.hour("at"))
        .withColumn("own_type", F.max_by("type", "at").over(device))
        .withColumn("b", F.coalesce(F.try_divide(n * stm - st * sm, n * stt - st * st), F.lit(0.0)))
        .withColumn("a", (sm - F.col("b") * st) / n)
        .withColumn("r", F.col("m") - F.col("a") - F.col("b") * F.col("t")))
    by_type = (
        trended.groupBy(F.col("own_type"), "hour").agg(F.avg("r").alias("type_effect")))
    cell = Window.partitionBy("device_id", "hour")
    found = (
        trended.withColumn("cell", F.count("r").over(cell)).withColumn("own", F.avg("r").over(cell))
        .join(by_type, ["own_type", "hour"])
        .withColumn("effect", F.when(F.col("cell") >= min_cell, F.col("own")).otherwise(F.col("type_effect"))))
    place = (F.col("t") + F.lit(length - 1)).cast("int")
    lines = found.groupBy("device_id", "own_type").agg(
        F.first("a").alias("a"), F.first("b").alias("b"),
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct(
            "hour", F.struct("effect", F.when(F.col("cell") >= min_cell, F.col("cell")).alias("cell")))))).alias("effects"),
        F.map_from_entries(F.collect_list(F.struct(place.alias("k"), (F.col("r") - F.col("effect")).alias("v")))).alias("_r"))
    types = by_type.groupBy("own_type").agg(
        F.map_from_entries(F.collect_list(F.struct("hour", "type_effect"))).alias("type_effects"))
    steps = F.sequence(F.lit(0), F.lit(length - 1))
    return lines.join(types, "own_type").select(
        "device_id", origin.alias("origin"), "a", "b", "effects", "type_effects",
        F.transform(steps, lambda k: F.try_element_at("_r", k)).alias("rests"),
        (F.lit(2) + F.aggregate(F.map_values("effects"), F.lit(0), lambda acc, e: acc + e["cell"].isNotNull().cast("int")))
        .alias("used"))


def _lagged(lag: int) -> tuple[Column, Column]:
    """Sum of the products of rests `lag` hours apart, and the number of pairs."""
    size = F.size("rests") - lag
    pairs = F.filter(F.zip_with(F.slice("rests", F.lit(1), size), F.slice("rests", F.lit(lag + 1), size), lambda x, y: x * y),
                     lambda p: p.isNotNull())
    return F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + p), F.size(pairs)


def fit_rests(lines: DataFrame, order: int = 2) -> DataFrame:
    """Adds phi (coefficients of the order chosen), noise (variance of an hour's new error) and spread (variance of the
    rests)."""
    sums = {f"_s{k}": _lagged(k)[0] for k in range(order + 1)} | {f"_n{k}": _lagged(k)[1] for k in range(order + 1)}
    out = lines.withColumns(sums)
    out = out.withColumn("spread", F.col("_s0") / F.greatest(F.col("_n0") - F.col("used"), F.lit(1)))
    rho = {k: F.coalesce(F.when(F.col(f"_n{k}") >= MIN_PAIRS,
                                F.try_divide(F.col(f"_s{k}") / F.col(f"_n{k}"), F.col("_s0") / F.col("_n0"))), F.lit(0.0))
           for k in range(1, order + 1)}
    out = out.withColumns({f"_rho{k}": c for k, c in rho.items()} | {"_share0": F.lit(1.0), "_phi0": F.array().cast("array<double>")})
    for m in range(1, order + 1):
        before = f"_phi{m - 1}"
        known_part = F.lit(0.0)
        for j in range(1, m):
            known_part = known_part + F.col(before)[j - 1] * F.col(f"_rho{m - j}")
        partial = F.coalesce(F.try_divide(F.col(f"_rho{m}") - known_part, F.col(f"_share{m - 1}")), F.lit(0.0))
        out = out.withColumn("_k", F.greatest(F.lit(-MOST_PARTIAL), F.least(F.lit(MOST_PARTIAL), partial)))
        phi = [F.col(before)[j - 1] - F.col("_k") * F.col(before)[m - j - 1] for j in range(1, m)]
        out = out.withColumns({f"_phi{m}": F.array(*phi, F.col("_k")),
                               f"_share{m}": F.col(f"_share{m - 1}") * (1 - F.col("_k") * F.col("_k"))})
    fits = [F.struct((F.col("_n0") * F.ln(F.col(f"_share{m}")) + 2.0 * m).alias("aic"), F.lit(m).alias("m"),
                     F.col(f"_phi{m}").alias("phi"), F.col(f"_share{m}").alias("share")) for m in range(order + 1)]
    out = out.withColumn("_best", F.array_min(F.array(*fits)))
    return out.select(*lines.columns, F.col("_best.phi").alias("phi"), (F.col("spread") * F.col("_best.share")).alias("noise"), "spread")


def _next(phi: Column, state: Column) -> Column:
    return F.aggregate(F.zip_with(phi, F.slice(state, F.lit(1), F.size(phi)), lambda f, s: f * s), F.lit(0.0),
                       lambda acc, x: acc + x)


def forecast_ahead(df: DataFrame, as_of=None, horizon: int = 24, level: float = 0.95, min_rows: int = 100, days: int = 14,
                   min_cell: int = 3, order: int = 2) -> DataFrame:
    """One line per device with more than min_rows readings and hour after as_of's: device_id, origin, hour_bucket,
    step (1 .. horizon), ar_order, predicted_temperature and the bounds of the `level` interval."""
    history = df.groupBy("device_id").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > min_rows)
    lines = hourly_rests(df, as_of, days, min_cell).join(history.select("device_id"), "device_id", "left_semi")
    lines = fit_rests(lines, order)
    phi, width = F.col("phi"), F.lit(order)
    # the last `order` rests, newest first, hours without readings filled on the way; hours since the last reading
    blank = F.struct(F.array_repeat(F.lit(0.0), order).alias("state"), F.lit(0).alias("since"))
    end = F.aggregate("rests", blank, lambda acc, x: F.struct(
        F.slice(F.concat(F.array(F.coalesce(x, _next(phi, acc["state"]))), acc["state"]), F.lit(1), width).alias("state"),
        F.when(x.isNull(), acc["since"] + 1).otherwise(F.lit(0)).alias("since")))
    ahead = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)), F.struct(F.col("_end.state").alias("state"), F.array().cast("array<double>").alias("out")),
        lambda acc, _: F.struct(
            F.slice(F.concat(F.array(_next(phi, acc["state"])), acc["state"]), F.lit(1), width).alias("state"),
            F.concat(acc["out"], F.array(_next(phi, acc["state"]))).alias("out")))["out"]
    # psi weights: the answer to one error; their squares add up to the variance of a forecast
    first = F.struct(F.concat(F.array(F.lit(1.0)), F.array_repeat(F.lit(0.0), order - 1)).alias("state"),
                     F.array(F.lit(1.0)).alias("sums"))
    answers = F.aggregate(
        F.sequence(F.lit(2), F.lit(horizon) + F.col("_end.since")), first, lambda acc, _: F.struct(
            F.slice(F.concat(F.array(_next(phi, acc["state"])), acc["state"]), F.lit(1), width).alias("state"),
            F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + _next(phi, acc["state"]) * _next(phi, acc["state"]))).alias("sums")))["sums"]
    steps = (
        lines.withColumn("_end", end).withColumns({"_ahead": ahead, "_sums": F.when(F.lit(horizon) + F.col("_end.since") < 2, F.array(F.lit(1.0))).otherwise(answers)})
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
        .withColumn("hour_bucket", F.col("origin") + F.make_interval(hours=F.col("step"))))
    hour = F.hour("hour_bucket")
    own = F.try_element_at("effects", hour)
    effect = F.coalesce(own["effect"], F.try_element_at("type_effects", hour), F.lit(0.0))
    value = F.col("a") + F.col("b") * F.col("step") + effect + F.col("_ahead")[F.col("step") - 1]
    variance = F.col("noise") * F.element_at("_sums", F.col("step") + F.col("_end.since")) \
        + F.coalesce(F.col("spread") / own["cell"], F.lit(0.0))
    reach = F.lit(NormalDist().inv_cdf(0.5 + level / 2)) * F.sqrt(variance)
    return steps.select("device_id", "origin", "hour_bucket", "step", F.size("phi").alias("ar_order"),
                        value.alias("predicted_temperature"), (value - reach).alias("prediction_interval_lower_bound"),
                        (value + reach).alias("prediction_interval_upper_bound"))


def coverage(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Of forecast hours with readings: step, hours, share of hourly means within the interval, mean width, and the root
    mean squared error."""
    kind = dict(actual.dtypes)["timestamp"]
    hours = actual.filter(known("temperature").isNotNull()).groupBy(
        "device_id", F.date_trunc("hour", "timestamp").cast(kind).alias("hour_bucket")).agg(F.avg("temperature").alias("m"))
    low, high = F.col("prediction_interval_lower_bound"), F.col("prediction_interval_upper_bound")
    error = F.col("m") - F.col("predicted_temperature")
    return forecast.join(hours, ["device_id", "hour_bucket"]).groupBy("step").agg(
        F.count(F.lit(1)).alias("hours"), F.avg(F.col("m").between(low, high).cast("double")).alias("covered"),
        F.avg(high - low).alias("width"), F.sqrt(F.avg(error * error)).alias("rmse"))
