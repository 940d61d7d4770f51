"""Summaries by day and tables refreshed by day against the whole tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from kelvibra import fixtures
from kelvibra.operators import stats
from kelvibra.operators.rules import format_reading
from kelvibra.operators.scans import scan_range
from kelvibra.sources import refresh, summaries
from kelvibra.sources.tables import append_readings, partition_and_cluster
from tests.helpers import plan_of, same_rows


@pytest.fixture(scope="module")
def table(spark, sf, tmp_path_factory):
    """The readings appended in three batches, each touching all days."""
    from kelvibra.operators.parsing import parse_messages, validate_required
    from kelvibra.operators.rules import apply_rules
    readings = format_reading(apply_rules(validate_required(parse_messages(fixtures.raw_messages(spark, sf)))))
    readings = readings.withColumn("_deal", F.pmod(F.xxhash64("device_id", "timestamp"), F.lit(3))).cache()
    path, beside = (str(tmp_path_factory.mktemp("t") / n) for n in ("readings", "summaries"))
    for part in range(3):
        append_readings(readings.filter(F.col("_deal") == part), path, beside)
    return spark.read.parquet(path), summaries.read_summaries(spark, beside), path


def test_newest_reading(spark, table):
    rows, lines, _ = table
    assert lines.select(summaries.newest(lines).alias("t")).first()["t"] == rows.agg(F.max("timestamp")).first()[0]
    same_rows(scan_range(rows, "3 DAYS", summaries.newest(lines)).select("device_id", "timestamp"),
              scan_range(rows, "3 DAYS").select("device_id", "timestamp"))


def test_kpis(table):
    rows, lines, path = table
    want, got = stats.kpis(rows).first(), summaries.kpis_of(lines).first()
    for c in ("total_readings", "anomaly_count"):
        assert got[c] == want[c]
    for c in ("anomaly_rate", "avg_temperature"):
        assert got[c] == pytest.approx(want[c], rel=1e-12)
    assert abs(got["active_devices"] - want["active_devices"]) <= max(1, 0.05 * want["active_devices"])
    assert path not in plan_of(summaries.kpis_of(lines))


@pytest.mark.parametrize("column", summaries.VALUES)
def test_quantiles(table, column):
    rows, lines, _ = table
    probs = (0.05, 0.5, 0.95, 0.99)
    got = summaries.quantiles_of(lines, column, probs).first()
    size = rows.filter(F.col(column).isNotNull()).count()
    for p in probs:
        at = rows.filter(F.col(column) <= got[f"p{round(p * 100)}"]).count() / size
        assert at == pytest.approx(p, abs=4 * summaries.QUANTILE_ERROR + 1 / size)


def test_odd_readings(spark, tmp_path):
    schema = "device_id string, timestamp timestamp_ntz, temperature double, vibration_level double, is_anomaly boolean"
    none = spark.createDataFrame([], schema)
    empty = summaries.summarize_days(none)
    assert summaries.kpis_of(empty).first()["total_readings"] == 0
    assert summaries.quantiles_of(empty, "temperature").first()["p95"] is None
    day = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([("a", day, None, float("nan"), None), (None, None, 1.0, 2.0, True)], schema)
    lines = summaries.summarize_days(rows)
    assert lines.count() == 2
    found = summaries.kpis_of(lines).first()
    assert (found["total_readings"], found["anomaly_count"], found["active_devices"], found["avg_temperature"]) == (2, 1, 1, 1.0)
    assert summaries.quantiles_of(lines, "vibration_level", (0.5,)).first()["p50"] == 2.0


def test_rebuilt_days_replace_their_lines(spark, table, tmp_path):
    rows, _, _ = table
    path = str(tmp_path / "s")
    summaries.append_summaries(rows, path)
    summaries.append_summaries(rows.filter("day(timestamp) = 3"), path)  # a repeated batch
    doubled = summaries.kpis_of(summaries.read_summaries(spark, path)).first()["total_readings"]
    summaries.rebuild_days(rows.filter("day(timestamp) = 3"), path)
    assert doubled > rows.count() == summaries.kpis_of(summaries.read_summaries(spark, path)).first()["total_readings"]


DAYS = "device_id string, timestamp timestamp_ntz, temperature double"


def readings_of(spark, days, seed):
    rng = random.Random(seed)
    rows = [(f"d{i % 3}", dt.datetime(2024, 1, d) + dt.timedelta(minutes=rng.randrange(1440)), rng.random()) for d in days for i in range(20)]
    return spark.createDataFrame(rows, DAYS)


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names
            if f.endswith(".parquet") and refresh.MARKS not in d}


@pytest.mark.parametrize("lookback", [0, 1])
def test_refresh_equals_a_rebuild(spark, tmp_path, lookback):
    source, path = str(tmp_path / "source"), str(tmp_path / "derived")
    worked_on = []

    def build(rows):
        worked_on.append(sorted({r["event_date"].day for r in rows.select("event_date").distinct().collect()}))
        daily = rows.groupBy("device_id", "event_date").agg(F.sum("temperature").alias("t"), F.count(F.lit(1)).alias("n"))
        if not lookback:
            return daily
        before = daily.select("device_id", F.date_add("event_date", 1).alias("event_date"), F.col("t").alias("before"))
        return daily.join(before, ["device_id", "event_date"], "left")

    def refreshed():
        rows = spark.read.parquet(source)
        return refresh.refresh_days(rows, path, build, lookback), files(path)

    def same_as_rebuilt():
        want = build(spark.read.parquet(source))
        same_rows(refresh.read_days(spark, path).select(*want.columns), want)
    partition_and_cluster(readings_of(spark, [1, 2, 3, 4, 5], 1), source)
    days, _ = refreshed()
    assert len(days) == 5
    same_as_rebuilt()
    old = files(path)
    assert refreshed() == ([], old)  # nothing has changed
    partition_and_cluster(readings_of(spark, [3], 2), source)  # an append
    days, new = refreshed()
    assert days == [f"2024-01-{d:02d}" for d in ([3, 4] if lookback else [3])]
    assert worked_on[-1] == ([2, 3, 4] if lookback else [3])
    same_as_rebuilt()
    kept = [f for f in old if not any(f"event_date={d}" in f for d in days)]
    assert kept and all(new.get(f) == old[f] for f in kept)
    readings_of(spark, [5], 3).withColumn("event_date", F.to_date("timestamp")).write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(source)  # a day replaced
    assert refreshed()[0] == ["2024-01-05"]
    same_as_rebuilt()
    refresh._remove(spark, f"{source}/event_date=2024-01-02")  # a day taken out
    days, _ = refreshed()
    assert days == (["2024-01-03"] if lookback else [])
    same_as_rebuilt()
