"""Cutting long series must not change any value."""

import pytest
from pyspark.sql import functions as F

from kelvibra import fixtures
from kelvibra.operators import features as W
from kelvibra.plans.slices import hot_series, in_slices, lead_in
from tests.helpers import plan_of, same_rows


@pytest.fixture(scope="module")
def series(spark, sf):
    """One device holds more than a third of the rows, a hundred of them at one instant; some values
    are missing."""
    rows = fixtures.readings(spark, sf).select("reading_id", "device_id", "timestamp", "temperature", "vibration")
    hot = F.col("reading_id") % 5 < 2
    rows = rows.withColumn("device_id", F.when(hot, "hot").otherwise(F.col("device_id")))
    frozen = hot & (F.col("reading_id") < 250)
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return rows.withColumns({
        "timestamp": F.when(frozen, first).otherwise(F.col("timestamp")),
        "gappy": F.when(F.col("reading_id") % 7 < 3, F.col("vibration"))}).cache()


OPERATORS = {
    "change": lambda df, **k: W.change_features(df, **k),
    "mean": lambda df, **k: W.rolling_mean(df, **k),
    "std": lambda df, **k: W.rolling_std(df, **k),
    "dashboard": lambda df, **k: W.dashboard_zscore(df, **k),
    "eps": lambda df, **k: W.eps_features(df, **k),
    "sequences": lambda df, **k: W.sequences(df, **k),
    "fill": lambda df, **k: W.fill_gaps(df, ["gappy"], **k),
    "split": lambda df, **k: W.ordered_split(df, **k),
    "view": lambda df, **k: W.training_view(
        df.withColumnsRenamed({"vibration": "vibration_level"}).withColumns(
            {"device_type": F.lit("x"), "is_anomaly": F.lit(False)}), **k),
}


@pytest.mark.parametrize("max_rows", [4, 57, 150])
@pytest.mark.parametrize("name", OPERATORS)
def test_slices_change_nothing(series, name, max_rows):
    op = OPERATORS[name]
    same_rows(op(series, max_rows=max_rows), op(series))


@pytest.mark.parametrize("name", OPERATORS)
def test_rows_without_device_are_a_series_that_is_cut_too(series, name):
    rows = series.withColumn("device_id", F.when(F.col("device_id") != "hot", F.col("device_id")))
    assert hot_series(rows, ["device_id"], 150).rows == rows.filter("device_id is null").count()
    same_rows(OPERATORS[name](rows, max_rows=57), OPERATORS[name](rows))


def test_slices_are_bounded_and_balanced(series):
    hot = hot_series(series, ["device_id"], 100)
    rows = in_slices(series, hot, ["device_id"], ["timestamp", "reading_id"], 40)
    sizes = [r["count"] for r in rows.groupBy("_slice").count().collect()]
    assert sum(sizes) == 400 and len(sizes) >= 5 and max(sizes) < 160


def test_lead_in_reaches_over_short_slices(spark):
    rows = spark.createDataFrame([("a", i, s) for i, s in enumerate([0, 0, 0, 1, 2, 2, 3])], "k string, t int, _slice int")
    lead = lead_in(rows, ["k"], ["t"], 3)
    got = {}
    for r in lead.collect():
        got.setdefault(r["_slice"], []).append(r["t"])
    assert {s: sorted(v) for s, v in got.items()} == {1: [0, 1, 2], 2: [1, 2, 3], 3: [3, 4, 5]}


def test_null_series_is_kept(spark, series):
    some = series.withColumn("device_id", F.when(F.col("reading_id") % 2 == 0, F.col("device_id")))
    same_rows(W.rolling_mean(some, max_rows=30), W.rolling_mean(some))


def test_no_hot_series(series):
    assert hot_series(series, ["device_id"], 10_000) is None


def test_training_view_sorts_once(spark, sf):
    plan = plan_of(W.training_view(fixtures.stored(spark, sf)), "simple").split("Subqueries")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
