"""Model versions on a stream, and Shapley values against enumeration."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kelvibra import fixtures
from kelvibra.models import attribution as A
from kelvibra.models import regression
from kelvibra.models.versions import ModelVersions, score_live
from kelvibra.operators import features as W
from tests.helpers import same_rows


@pytest.fixture(scope="module")
def inputs(spark, sf):
    rows = regression.classifier_inputs(W.training_view(fixtures.stored(spark, sf)))
    return rows.withColumn("reading_id", F.xxhash64("device_id", "timestamp")).cache()


@pytest.fixture(scope="module")
def fitted(inputs):
    """Two models that differ: of all readings, and of a few."""
    cols, label = list(regression.CLASS_FEATURES), "label"
    return [regression._fit_classifier(rows, cols, None, label, 20) for rows in (inputs, inputs.filter("reading_id % 3 = 0"))]


def test_a_switch_between_batches(spark, inputs, fitted, tmp_path):
    models = ModelVersions(spark, str(tmp_path / "models"))
    assert models.current() is None and models.versions() == []
    for name, model in zip(("1", "2"), fitted):
        models.add(name, model)
    with pytest.raises(ValueError, match="there already"):
        models.add("1", fitted[0])
    with pytest.raises(ValueError, match="no version"):
        models.switch("3")
    models.switch("1")
    source, table, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    halves = [inputs.filter("reading_id % 2 = 0"), inputs.filter("reading_id % 2 <> 0")]

    def run(part):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(inputs.schema).parquet(source)
        query = score_live(stream, ModelVersions(spark, models.path), table, state)
        query.awaitTermination(100)
        assert query.exception() is None
    run(halves[0])
    models.switch("2")
    run(halves[1])
    found = spark.read.parquet(table)
    for version, half, model in zip(("1", "2"), halves, fitted):
        got = found.filter(F.col("model_version") == version)
        same_rows(got.select("reading_id", "anomaly_probability", "prediction"),
                  regression.predict(model, half).select("reading_id", "anomaly_probability", "prediction"))
    first, second = (regression.predict(m, inputs).agg(F.avg("anomaly_probability")).first()[0] for m in fitted)
    assert first != pytest.approx(second, abs=1e-9)
    models.switch("1")
    assert models.current() == "1"


def test_switches_at_once_and_the_best(spark, fitted, tmp_path):
    models = ModelVersions(spark, str(tmp_path / "models"))
    for name, model in zip(("a", "b"), fitted):
        models.add(name, model)
    models.switch("a")
    other = ModelVersions(spark, models.path)
    other._log = lambda: (0, None)  # has not seen that switch
    with pytest.raises(AnalysisException):
        other.switch("b")
    now = dt.datetime(2024, 1, 1)
    lines = spark.createDataFrame(
        [("fault", "a", now, .5), ("fault", "b", now, .7), ("fault", "gone", now, .9), ("other", "a", now, .99)],
        "model_name string, model_version string, evaluation_timestamp timestamp_ntz, f1_score double")
    lines = lines.withColumns({c: F.lit(0.0) for c in ("accuracy", "precision", "recall")})
    assert models.switch_to_best(lines, "fault") == "b" == models.current()
    assert models.switch_to_best(lines.filter("model_name = 'none'"), "fault") is None and models.current() == "b"


def enumerated(x, score, background):
    """Shapley values by all coalitions, against the mean over the background."""
    m = len(x)

    def worth(held):
        rows = background.copy()
        rows[:, list(held)] = x[list(held)]
        return score(rows).mean()
    out = []
    for i in range(m):
        rest = [j for j in range(m) if j != i]
        out.append(sum(math.factorial(len(s)) * math.factorial(m - len(s) - 1) / math.factorial(m) * (worth([*s, i]) - worth(s))
                       for k in range(m) for s in itertools.combinations(rest, k)))
    return np.array(out)


def test_attributions_equal_enumeration_on_four_features():
    rng = np.random.default_rng(3)
    background, x = rng.normal(size=(6, 4)), rng.normal(size=(3, 4))

    def score(rows):  # with interactions
        return 1 / (1 + np.exp(-(rows[:, 0] * rows[:, 1] + 2 * rows[:, 2] - rows[:, 3] ** 2)))
    every = list(itertools.permutations(range(4)))
    order = np.array([every * len(background)] * len(x))
    place = np.array([np.repeat(np.arange(len(background)), len(every))] * len(x))
    given, base = A.shapley(x, score, background, order, place)
    np.testing.assert_allclose(given, [enumerated(row, score, background) for row in x], atol=1e-12)
    np.testing.assert_allclose(given.sum(axis=1) + base, score(x), atol=1e-12)
    order, place = A.coalitions(np.arange(3), 4, 4000, len(background))
    sampled, _ = A.shapley(x, score, background, order, place)
    np.testing.assert_allclose(sampled, given, atol=0.03)


def test_attributions_add_up(spark, inputs, fitted):
    cols = list(regression.CLASS_FEATURES)
    if "device_type" in cols:
        cols.remove("device_type")
    score = A.logistic_score(fitted[0], cols)
    background = A.background_of(inputs, cols, 20)
    given = A.attributions(inputs, cols, score, background, orders=4).cache()
    total = sum((F.col(f"{c}_attribution") for c in cols), F.col("base"))
    assert given.filter(F.abs(total - F.col("prediction")) > 1e-9).count() == 0
    same_rows(given.select("reading_id", F.col("prediction").alias("p")),
              regression.predict(fitted[0], inputs).select("reading_id", F.col("anomaly_probability").alias("p")))
    again = A.attributions(inputs.repartition(5), cols, score, background, orders=4)
    same_rows(given, again)
    ranked = A.global_attribution(given, cols).collect()
    assert len(ranked) == len(cols) and ranked[0]["attribution"] > 0
