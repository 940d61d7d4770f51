"""Range scans, text filter, top-k."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_start(df: DataFrame, interval: str, as_of=None, timestamp: str = "timestamp") -> Column:
    """as_of minus an interval such as "30 DAYS" or "6 HOURS". as_of is a datetime or a column of
    constants; by default it is the newest timestamp, read by a one-column scalar subquery whose
    result reaches the scan as a filter."""
    back = F.expr(f"INTERVAL {interval}")
    if as_of is None:
        return df.agg((F.max(timestamp) - back).alias("start")).scalar()
    return moment_of(df, as_of, timestamp) - back


def moment_of(df: DataFrame, as_of, timestamp: str) -> Column:
    """A datetime, or none, as a constant of the timestamp's type; columns stay as they are."""
    kind = dict(df.dtypes)[timestamp]
    if as_of is None:
        return F.lit(None).cast(kind)
    return F.lit(as_of.isoformat(sep=" ")).cast(kind) if isinstance(as_of, dt.datetime) else as_of


def scan_range(df: DataFrame, interval: str, as_of=None, timestamp: str = "timestamp",
               date_column: str = "event_date") -> DataFrame:
    """A5. Rows of the last interval before as_of, as_of included. On a table partitioned by date a date
    bound is added, as a bound on the timestamp alone prunes no partitions; it leaves two days of slack, since
    the table's days may be those of another time zone, up to 26 hours away."""
    start = range_start(df, interval, as_of, timestamp)
    rows = df.filter(F.col(timestamp) >= start)
    if as_of is not None:
        rows = rows.filter(F.col(timestamp) <= moment_of(df, as_of, timestamp))
    if date_column in df.columns:
        rows = rows.filter(F.col(date_column) >= F.date_sub(start.cast("date"), 2))
    return rows


def device_filter(df: DataFrame, text: str | None) -> DataFrame:
    """B15. Devices whose id contains the text, taken literally; all when it is empty."""
    return df.filter(F.col("device_id").contains(F.lit(text))) if text else df


def recent_anomalies(df: DataFrame, k: int = 10, flag: str = "is_anomaly") -> DataFrame:
    """F1. The k latest flagged readings."""
    return (df.filter(F.col(flag)).select("timestamp", "device_id", "temperature", "vibration")
            .orderBy(F.desc("timestamp"), "device_id").limit(k))


def raw_page(df: DataFrame, k: int = 100) -> DataFrame:
    """F2. The k latest rows, all columns."""
    return df.orderBy(F.desc("timestamp"), "device_id").limit(k)
