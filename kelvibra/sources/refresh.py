"""A7 by day: a derived table of which only the days are computed whose input has changed.

A day's input is known by its files: their paths, sizes and times of change, which the scan has without reading a column.
Their fingerprint is kept beside the table; a day is computed if it is new or its fingerprint, or that of one of the days
before it that it looks back on, is another one. Days are written by dynamic partition overwrite, so that other days'
files stay as they are; days that have no input any more are removed. Fingerprints are written last: a job that ends
early computes the same days again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "_days"  # a name that scans of the table leave out


def day_fingerprints(source: DataFrame) -> DataFrame:
    """`event_date` and `mark` of a table partitioned by event_date."""
    files = source.select("event_date", F.struct("_metadata.file_path", "_metadata.file_size",
                                                 "_metadata.file_modification_time").alias("file")).distinct()
    return files.groupBy("event_date").agg(F.xxhash64(F.array_sort(F.collect_list("file"))).alias("mark"))


def _kept_marks(spark: SparkSession, path: str) -> DataFrame:
    """The fingerprints of the newest refresh."""
    try:
        kept = spark.read.option("recursiveFileLookup", "true").schema("event_date date, mark long, version long").parquet(f"{path}/{MARKS}")
        newest = kept.agg(F.max("version")).first()[0]
        return kept.filter(F.col("version") == newest)
    except AnalysisException:
        return spark.createDataFrame([], "event_date date, mark long, version long")


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def refresh_days(source: DataFrame, path: str, build: Callable[[DataFrame], DataFrame], lookback: int = 0) -> list[str]:
    """Brings the table at `path` up to date with `build(source)`, which has a column event_date, and returns the days
    computed. `build` may look back on `lookback` days before a row's own."""
    spark = source.sparkSession
    marks = [(r["event_date"], r["mark"]) for r in day_fingerprints(source).collect()]  # one line a day
    kept = _kept_marks(spark, path).collect()
    before, version = {r["event_date"]: r["mark"] for r in kept}, max((r["version"] for r in kept), default=0)
    now = dict(marks)
    moved = {d for d in now.keys() | before.keys() if now.get(d) != before.get(d)}
    if not moved:
        return []
    days = sorted(d for d in now if any(0 <= (d - m).days <= lookback for m in moved))
    if days:
        needed = sorted({d for d in now if any(0 <= (day - d).days <= lookback for day in days)})
        rows = build(source.filter(F.col("event_date").isin(needed))).filter(F.col("event_date").isin(days))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
    for day in before.keys() - now.keys():
        _remove(spark, f"{path}/event_date={day.isoformat()}")
    lines = [(d, m, version + 1) for d, m in now.items()]
    spark.createDataFrame(lines, "event_date date, mark long, version long").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/{MARKS}/{uuid.uuid4().hex}")
    return [d.isoformat() for d in days]


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The derived table."""
    return spark.read.parquet(path)
