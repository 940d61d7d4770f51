"""Sequence models against plain arrays."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kelvibra.models import sequences as Q
from kelvibra.models.reconstruct import sequence_anomalies
from kelvibra.models.registry import ModelRegistry
from tests.helpers import same_rows

SCHEMA = "reading_id long, device_id string, timestamp timestamp_ntz, temperature double, vibration double"
START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    rng = random.Random(4)
    rows = []
    for d, size in (("a", 60), ("b", 25), ("c", 9), ("d", 10), (None, 12), ("e", 1)):
        rows += [(d, START + dt.timedelta(minutes=i), 20 + 5 * np.sin(i / 3) + rng.gauss(0, 1),
                  None if rng.random() < .05 else float("nan") if rng.random() < .05 else rng.random()) for i in range(size)]
    return spark.createDataFrame([(i, d, t, float(x), y) for i, (d, t, x, y) in enumerate(rows)], SCHEMA).cache()


def plain_sequences(df, n=10):
    """(reading_id of the last row, sequence) of the scaled values."""
    rows = df.orderBy("device_id", "timestamp").collect()
    table = np.array([[r["temperature"], np.nan if r["vibration"] is None else r["vibration"]] for r in rows], float)
    low, high = np.nanmin(table, axis=0), np.nanmax(table, axis=0)
    table = np.nan_to_num((table - low) / (high - low), nan=0.0)
    out = []
    for i in range(n - 1, len(rows)):
        if len({r["device_id"] for r in rows[i - n + 1:i + 1]}) == 1:
            out.append((rows[i]["reading_id"], table[i - n + 1:i + 1].ravel()))
    return out


@pytest.mark.parametrize("max_rows", [Q.MAX_ROWS, 7])
def test_moments_without_sequences(series, max_rows):
    scale, _ = Q.fit_scale(series)
    found = Q.moments(Q.with_lags(series, scale, 10, max_rows=max_rows), 10, 2)
    want = np.array([x for _, x in plain_sequences(series)])
    assert found.count == len(want)
    np.testing.assert_allclose(found.mean, want.mean(axis=0), atol=1e-12)
    np.testing.assert_allclose(found.covariance, np.cov(want.T), atol=1e-12)


def test_components_are_those_of_the_sequences(spark, series):
    scale, _ = Q.fit_scale(series)
    model = Q.fit_components(Q.with_lags(series, scale, 10), scale, 10, 4)
    want = plain_sequences(series)
    rows = spark.createDataFrame([(x.tolist(),) for _, x in want], "x array<double>").select(array_to_vector("x").alias("x"))
    theirs = PCA(inputCol="x", outputCol="y", k=4).fit(rows).pc.toArray().T
    mine = np.array(model.parts)
    np.testing.assert_allclose(mine, theirs * np.sign((mine * theirs).sum(axis=1))[:, None], atol=1e-9)
    errors = {r["reading_id"]: r["sequence_error"] for r in model.detect(series).collect()}
    for key, x in want:
        centred = x - np.array(model.mean)
        assert errors[key] == pytest.approx(((centred - mine.T @ (mine @ centred)) ** 2).mean(), abs=1e-12)
    assert sum(e is not None for e in errors.values()) == len(want)


def test_few_rows(series):
    few = series.filter("device_id = 'c'")
    assert sequence_anomalies(few).filter("sequence_anomaly = 1 or sequence_error is not null").count() == 0
    assert sequence_anomalies(few.limit(0)).count() == 0
    assert sequence_anomalies(few, kind="network", k=2).filter("sequence_anomaly = 1").count() == 0


def test_gradient():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(7, 12))
    size = sum(int(np.prod(s)) for s in Q.shapes(6, 2, 2).values())
    w = rng.normal(size=size) * 0.5
    found, loss = Q.gradient(x, Q.unpacked(w, 6, 2, 2), 6, 2)
    for at in rng.choice(size, 60, replace=False):
        step = np.zeros(size)
        step[at] = 1e-6
        ahead, behind = (Q.gradient(x, Q.unpacked(w + s, 6, 2, 2), 6, 2)[1] for s in (step, -step))
        assert found[at] == pytest.approx((ahead - behind) / 2e-6, rel=1e-4, abs=1e-6)
    assert (Q.packed(Q.unpacked(w, 6, 2, 2)) == w).all()


@pytest.fixture(scope="module")
def bent(spark):
    """Vibration follows temperature on a bent line, which no plane of few dimensions holds; faults leave that line and
    stay within the range of both."""
    rng = np.random.default_rng(9)
    rows = []
    for d in range(12):
        phase = rng.uniform(0, 6)
        for i in range(150):
            angle = phase + i * 0.25
            fault = d >= 8 and 60 <= i % 100 < 64
            x, y = np.sin(angle), np.cos(2 * angle) + 0.6 * np.sin(3 * angle)
            y = -y if fault else y
            rows.append((len(rows), f"d{d}", START + dt.timedelta(minutes=i), float(x + rng.normal(0, .02)),
                         float(y + rng.normal(0, .02)), fault))
    return spark.createDataFrame(rows, SCHEMA + ", fault boolean").cache()


def test_network_beats_the_components_on_a_bent_line(spark, bent, tmp_path):
    scale, _ = Q.fit_scale(bent)
    lagged = Q.with_lags(bent, scale, 10)
    healthy = lagged.filter("device_id < 'd8' and device_id not in ('d10', 'd11')")
    net = Q.fit_network(healthy, scale, 10, k=2, passes=60)
    one, eight = (Q.fit_network(rows, scale, 10, k=2, passes=6) for rows in (healthy.coalesce(1), healthy.repartition(8, "reading_id")))
    np.testing.assert_allclose(one.weights, eight.weights, atol=1e-9)  # the same model however rows are dealt
    plane = Q.fit_components(healthy, scale, 10, 2)
    mean = lambda m: m.score(healthy).agg(F.avg("sequence_error")).first()[0]
    assert mean(net) < 0.5 * mean(plane)

    def caught(m):
        """Of sequences that end in a fault, the share whose error is beyond that of 99 in 100 healthy ones."""
        rows = m.score(lagged).filter("is_full")
        limit = m.score(healthy).agg(F.percentile("sequence_error", 0.99)).first()[0]
        return rows.filter("fault").agg(F.avg((F.col("sequence_error") > limit).cast("double"))).first()[0]
    assert caught(net) > 0.7 and caught(net) > caught(plane) + 0.2, (caught(net), caught(plane))
    models = ModelRegistry()
    models.add("net", net)
    models.add("plane", plane)
    models.save(spark, str(tmp_path / "m"))
    loaded = ModelRegistry.load(spark, str(tmp_path / "m"))
    for name in ("net", "plane"):
        same_rows(models.predict(name, bent).select("reading_id", "sequence_error"),
                  loaded.predict(name, bent).select("reading_id", "sequence_error"))
