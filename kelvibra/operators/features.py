"""Features over a device's readings in time order.

A reading that is null or NaN is missing: frames skip it, and what is derived from it alone is null.

Four z-scores share names here and in rules; they are different measures:
baseline_zscore (fixed baselines), training_zscore (5-row mean with 10-row deviation, absolute),
dashboard_zscore (11 rows, signed), eps_features (5 rows, absolute, deviation + 1e-8).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kelvibra.functions.expressions import eps_ratio, interaction_features, known, safe_ratio
from kelvibra.operators.scans import scan_range
from kelvibra.plans.slices import (KEYS, MAX_ROWS, ORDER, SERIES, cold_rows, hot_series, in_slices,
                                    slice_starts, windowed)

VALUES = ("temperature", "vibration")


def _last(w: WindowSpec, rows: int) -> WindowSpec:
    return w.rowsBetween(1 - rows, Window.currentRow)


def _short(name: str) -> str:
    return {"temperature": "temp", "vibration_level": "vibration"}.get(name, name)


def change_features(df: DataFrame, cols: Sequence[str] = VALUES, **series) -> DataFrame:
    """E1. <col>_change: difference to the device's previous reading."""
    def build(rows, w):
        return rows.withColumns({f"{_short(c)}_change": known(c) - F.lag(known(c), 1).over(w) for c in cols})
    return windowed(df, build, 1, **series)


def rolling_mean(df: DataFrame, cols: Sequence[str] = VALUES, rows: int = 5, **series) -> DataFrame:
    """E2. <col>_avg_<rows>: mean of the last rows, the current one included."""
    def build(data, w):
        return data.withColumns({f"{_short(c)}_avg_{rows}": F.avg(known(c)).over(_last(w, rows)) for c in cols})
    return windowed(df, build, rows - 1, **series)


def rolling_std(df: DataFrame, cols: Sequence[str] = VALUES, rows: int = 10, **series) -> DataFrame:
    """E3. <col>_stddev_<rows>: sample deviation, null for a single row."""
    def build(data, w):
        return data.withColumns({f"{_short(c)}_stddev_{rows}": F.stddev_samp(known(c)).over(_last(w, rows))
                                 for c in cols})
    return windowed(df, build, rows - 1, **series)


def training_features(rows: DataFrame, w: WindowSpec) -> DataFrame:
    """E1 to E3 over one window: a single sort serves all six."""
    t, v = known("temperature"), known("vibration")
    return rows.withColumns({
        "temp_change": t - F.lag(t, 1).over(w),
        "vibration_change": v - F.lag(v, 1).over(w),
        "temp_avg_5min": F.avg(t).over(_last(w, 5)),
        "vibration_avg_5min": F.avg(v).over(_last(w, 5)),
        "temp_stddev_10min": F.stddev_samp(t).over(_last(w, 10)),
        "vibration_stddev_10min": F.stddev_samp(v).over(_last(w, 10)),
    })


def training_view(df: DataFrame, as_of=None, days: int = 30, **series) -> DataFrame:
    """E4. Features and label over the last `days`. "5min" and "10min" are frames of 5 and 10 rows. The
    range filter comes first, so the first reading in range has no change. Takes stored readings
    (vibration_level, is_anomaly as label)."""
    ranged = scan_range(df, f"{days} DAYS", as_of)
    tie = [c for c in ("reading_id",) if c in df.columns]
    rows = ranged.select("device_id", "timestamp", *tie, "device_type",
                         known("temperature").alias("temperature"), known("vibration_level").alias("vibration"), F.col("is_anomaly").alias("label"))
    return windowed(rows, training_features, 9, **series)


def training_zscore(view: DataFrame) -> DataFrame:
    """E5. Absolute distance from the 5-row mean in 10-row deviations; rows without one are left out."""
    usable = view.filter("temp_avg_5min is not null and vibration_avg_5min is not null "
                         "and temp_stddev_10min > 0 and vibration_stddev_10min > 0 "
                         "and temperature is not null and vibration is not null")
    return usable.withColumns({
        f"{p}_z_score": safe_ratio(F.abs(known(c) - F.col(f"{p}_avg_5min")), F.col(f"{p}_stddev_10min"))
        for p, c in (("temp", "temperature"), ("vibration", "vibration"))})


def dashboard_zscore(df: DataFrame, rows: int = 11, **series) -> DataFrame:
    """E6. Signed z over the last 11 rows; null while the deviation is 0 or undefined."""
    def build(data, w):
        frame = _last(w, rows)
        return data.withColumns({
            f"{_short(c)}_z_score": safe_ratio(known(c) - F.avg(known(c)).over(frame),
                                               F.stddev_samp(known(c)).over(frame)) for c in VALUES})
    return windowed(df, build, rows - 1, **series)


def eps_features(df: DataFrame, rows: int = 5, **series) -> DataFrame:
    """E7. Rolling mean and deviation, change, absolute z with 1e-8 added to the deviation, ratio and
    product. Per device, where a single-device frame was assumed."""
    def build(data, w):
        frame = _last(w, rows)
        for c in VALUES:
            p = _short(c)
            data = data.withColumns({
                f"{p}_rolling_mean": F.avg(known(c)).over(frame),
                f"{p}_rolling_std": F.stddev_samp(known(c)).over(frame),
                f"{p}_change": known(c) - F.lag(known(c), 1).over(w),
            })
        return data
    out = windowed(df, build, rows - 1, **series)
    out = out.withColumns({
        f"{_short(c)}_z_score": F.abs(eps_ratio(known(c) - F.col(f"{_short(c)}_rolling_mean"),
                                                F.col(f"{_short(c)}_rolling_std"))) for c in VALUES})
    return interaction_features(out)


def fill_gaps(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS,
              order: Sequence[str] = ORDER, max_rows: int = MAX_ROWS) -> DataFrame:
    """E8. Each null or NaN takes the next known value of its series, else the last one before it.

    Both directions are running windows, backwards on the reversed order: Spark evaluates a frame that
    ends at the partition's end anew for every row. A long series is cut into slices; what a slice
    lacks comes from the first known value of the slices after it or the last of those before, found
    on one line per slice."""
    keys, order = list(keys), [c for c in order if c in df.columns]
    running = (Window.unboundedPreceding, Window.currentRow)

    def latest(value: Column, by: Sequence[str], along: Sequence[Column], frame=running) -> Column:
        window = Window.partitionBy(*by).orderBy(*along).rowsBetween(*frame)
        return F.last(value, ignorenulls=True).over(window)

    def both(names: Sequence[str]) -> tuple[list[Column], list[Column]]:
        return [F.asc(c) for c in names], [F.desc(c) for c in names]

    onwards, backwards = both(order)

    def fill(rows: DataFrame, by: Sequence[str], carried: bool = False) -> DataFrame:
        """The next known value, else what later slices carry, else the last, else what earlier carry."""
        def value(c: str) -> Column:
            ahead, behind = latest(known(c), by, backwards), latest(known(c), by, onwards)
            if carried:
                return F.coalesce(ahead, f"_after_{c}", behind, f"_before_{c}")
            return F.coalesce(ahead, behind)
        return rows.withColumns({c: value(c) for c in cols})

    hot = hot_series(df, keys, max_rows)
    if hot is None:
        return fill(df, keys)
    cold = fill(cold_rows(df, hot, keys), keys)
    rows = in_slices(df, hot, keys, order, max_rows)
    placed = {c: F.when(known(c).isNotNull(), F.struct(*order, F.col(c).alias("_v"))) for c in cols}
    ends = rows.groupBy(SERIES, "_slice").agg(
        *[F.min(v).alias(f"_first_{c}") for c, v in placed.items()],
        *[F.max(v).alias(f"_last_{c}") for c, v in placed.items()])
    others = (Window.unboundedPreceding, -1)
    up, down = both(["_slice"])
    carried = ends.select(
        SERIES, "_slice",
        *[latest(F.col(f"_first_{c}._v"), [SERIES], down, others).alias(f"_after_{c}") for c in cols],
        *[latest(F.col(f"_last_{c}._v"), [SERIES], up, others).alias(f"_before_{c}") for c in cols])
    filled = fill(rows.join(carried, [SERIES, "_slice"]), [SERIES, "_slice"], carried=True)
    return cold.unionByName(filled.select(*cold.columns))


def with_sequences(df: DataFrame, cols: Sequence[str] = VALUES, n: int = 10, **series) -> DataFrame:
    """`sequence`: the last n readings of the device up to the row (array of arrays, oldest first);
    shorter on a device's first rows."""
    def build(rows, w):
        return rows.withColumn("sequence", F.collect_list(F.array(*[F.col(c) for c in cols])).over(_last(w, n)))
    return windowed(df, build, n - 1, **series)


def sequences(df: DataFrame, cols: Sequence[str] = VALUES, n: int = 10, **series) -> DataFrame:
    """E9. The rows that end n readings of their device, with them as `sequence`."""
    return with_sequences(df, cols, n, **series).filter(F.size("sequence") == n)


def scale_standard(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """J17. (x - mean) / population deviation, from one aggregate over the training rows."""
    source = df if fit_on is None else fit_on
    stats = source.agg(*[f(known(c)).alias(f"{n}_{c}") for c in cols
                         for n, f in (("mean", F.avg), ("dev", F.stddev_pop))])
    pick = partial(_scalar, stats)
    return df.withColumns({f"{c}_scaled": (known(c) - pick(f"mean_{c}"))
                           / F.when(pick(f"dev_{c}") == 0, 1.0).otherwise(pick(f"dev_{c}")) for c in cols})


def scale_minmax(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """J17. (x - min) / (max - min); a constant column becomes 0."""
    source = df if fit_on is None else fit_on
    stats = source.agg(*[f(known(c)).alias(f"{n}_{c}") for c in cols
                         for n, f in (("min", F.min), ("max", F.max))])
    pick = partial(_scalar, stats)
    return df.withColumns({
        f"{c}_scaled": F.coalesce(safe_ratio(known(c) - pick(f"min_{c}"),
                                             pick(f"max_{c}") - pick(f"min_{c}")), known(c) * 0.0)
        for c in cols})


def _scalar(stats: DataFrame, name: str) -> Column:
    return stats.select(name).scalar()


def ordered_split(df: DataFrame, share: float = 0.8, keys: Sequence[str] = KEYS,
                  order: Sequence[str] = ORDER, max_rows: int = MAX_ROWS) -> DataFrame:
    """J18. is_train for the first floor(share * n) readings of each device. In a long series a row's
    place is its slice's start plus its place in the slice."""
    keys, order = list(keys), [c for c in order if c in df.columns]

    def mark(place: Column, size: Column) -> Column:
        return place <= F.floor(F.lit(share) * size)

    def plain(rows: DataFrame) -> DataFrame:
        whole = Window.partitionBy(*keys)
        place = F.row_number().over(whole.orderBy(*order))
        return rows.withColumn("is_train", mark(place, F.count(F.lit(1)).over(whole)))

    hot = hot_series(df, keys, max_rows)
    if hot is None:
        return plain(df)
    rows = in_slices(df, hot, keys, order, max_rows)
    rows = rows.join(slice_starts(rows), [SERIES, "_slice"]).join(hot.keys, SERIES)
    place = F.row_number().over(Window.partitionBy(SERIES, "_slice").orderBy(*order)) + F.col("_start")
    hot_out = rows.withColumn("is_train", mark(place, F.col("_n")))
    cold = plain(cold_rows(df, hot, keys))
    return cold.unionByName(hot_out.select(*cold.columns))
