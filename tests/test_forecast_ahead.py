"""Forecasts from now on: recovery of known errors, and coverage on hours held out."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelvibra.models.autoregression import coverage, fit_rests, forecast_ahead, hourly_rests

SCHEMA = "device_id string, device_type string, timestamp timestamp_ntz, temperature double"
START = dt.datetime(2024, 1, 1)
AS_OF = START + dt.timedelta(days=14, seconds=-1)


@pytest.fixture(scope="module")
def fleet(spark):
    """Half of the devices with errors that last, half without; one is silent for the last ten hours."""
    rng = np.random.default_rng(0)
    rows = []
    for d in range(40):
        rest, lasting = 0.0, 0.8 if d < 20 else 0.0
        for h in range(15 * 24):
            rest = lasting * rest + rng.normal()
            if rng.random() < .05 or (d == 0 and 14 * 24 - 10 <= h < 14 * 24):
                continue
            at = START + dt.timedelta(hours=h, minutes=int(rng.integers(0, 60)))
            rows.append((f"{'long' if d < 20 else 'short'}{d}", "t", at, float(20 + 0.01 * h + 5 * np.sin(h % 24 / 24 * 6.283) + rest)))
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def ahead(fleet):
    return forecast_ahead(fleet, AS_OF).cache()


def test_the_next_day_after_the_origin(ahead):
    rows = ahead.filter("device_id = 'long1'").orderBy("step").collect()
    assert [r["step"] for r in rows] == list(range(1, 25))
    assert {r["origin"] for r in rows} == {START + dt.timedelta(hours=14 * 24 - 1)}
    assert [r["hour_bucket"] for r in rows] == [START + dt.timedelta(hours=14 * 24 + i) for i in range(24)]
    assert ahead.count() == 40 * 24


def test_later_readings_change_nothing(fleet, ahead):
    earlier = fleet.filter(F.col("timestamp") <= F.lit(AS_OF.isoformat(sep=" ")).cast("timestamp_ntz"))
    rows = {(r["device_id"], r["step"]): r["predicted_temperature"] for r in forecast_ahead(earlier, AS_OF).collect()}
    assert rows == pytest.approx({(r["device_id"], r["step"]): r["predicted_temperature"] for r in ahead.collect()}, abs=1e-9)


def test_coefficients_of_lasting_errors(fleet):
    fits = fit_rests(hourly_rests(fleet, AS_OF)).select("device_id", "phi", "noise", "spread").collect()
    long = [sum(r["phi"]) for r in fits if r["device_id"].startswith("long")]
    short = [sum(r["phi"]) for r in fits if r["device_id"].startswith("short")]
    assert 0.65 < np.mean(long) < 0.85 and abs(np.mean(short)) < 0.1
    assert all(r["noise"] <= r["spread"] + 1e-12 for r in fits)


def test_against_levinson_in_numpy(fleet):
    for row in fit_rests(hourly_rests(fleet, AS_OF), order=3).limit(8).collect():
        e = np.array([np.nan if x is None else x for x in row["rests"]])
        rho = []
        for k in range(4):
            products = e[:len(e) - k] * e[k:]
            rho.append(np.nanmean(products))
        rho = np.array(rho) / rho[0]
        n, fits = np.isfinite(e).sum(), []
        for m in range(4):
            phi = np.linalg.solve([[rho[abs(i - j)] for j in range(m)] for i in range(m)], rho[1:m + 1]) if m else np.zeros(0)
            share = 1 - phi @ rho[1:m + 1]
            fits.append((n * np.log(share) + 2 * m, phi.tolist(), share))
        _, phi, share = min(fits, key=lambda f: f[0])
        assert row["phi"] == pytest.approx(phi, abs=1e-9)
        assert row["noise"] == pytest.approx(row["spread"] * share, rel=1e-9)


def test_intervals_cover_and_widen(fleet, ahead):
    for kind, low, high in (("long", 0.90, 0.98), ("short", 0.91, 0.99)):
        found = coverage(ahead.filter(F.col("device_id").startswith(kind)), fleet).orderBy("step").collect()
        total = sum(r["hours"] for r in found)
        assert total > 400
        assert low <= sum(r["covered"] * r["hours"] for r in found) / total <= high
        if kind == "long":
            assert found[0]["width"] < 0.75 * found[-1]["width"] and found[0]["rmse"] < found[-1]["rmse"]
    width = F.col("prediction_interval_upper_bound") - F.col("prediction_interval_lower_bound")
    first = {r["device_id"]: r["w"] for r in ahead.filter("step = 1").select("device_id", width.alias("w")).collect()}
    others = [w for d, w in first.items() if d.startswith("long") and d != "long0"]
    assert first["long0"] > 1.3 * np.mean(others)  # its last reading is ten hours old


def test_odd_inputs(spark):
    rows = [("one", "t", START + dt.timedelta(hours=3), 5.0), ("none", "t", START, None), ("nan", "t", START, float("nan")),
            *[("flat", "u", START + dt.timedelta(hours=i), 7.0) for i in range(50)]]
    found = forecast_ahead(spark.createDataFrame(rows, SCHEMA), min_rows=0).collect()
    by_device = {d: [r for r in found if r["device_id"] == d] for d in ("one", "none", "nan", "flat")}
    assert not by_device["none"] and not by_device["nan"]
    assert {r["predicted_temperature"] for r in by_device["one"]} == {5.0}
    assert all(r["predicted_temperature"] == pytest.approx(7.0) and r["prediction_interval_lower_bound"] == pytest.approx(7.0)
               for r in by_device["flat"])
    assert forecast_ahead(spark.createDataFrame([], SCHEMA)).count() == 0
