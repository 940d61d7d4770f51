import numpy as np
import pytest

from kelvibra.functions.quantiles import exact_quantiles
from kelvibra.operators.stats import distance_quantiles

PROBS = [0.0, 0.02, 0.5, 0.95, 0.99, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double")


DATA = {
    "spread": np.random.default_rng(1).normal(size=3000),
    "ties": np.random.default_rng(2).integers(0, 5, 3000),
    "one third equal": np.where(np.arange(3000) % 3 == 0, 7.0, np.random.default_rng(3).uniform(0, 10, 3000)),
    "constant": np.ones(500),
}


@pytest.mark.parametrize("name", DATA)
@pytest.mark.parametrize("keep", [40, 100_000])
def test_linear(spark, name, keep):
    got = exact_quantiles(frame(spark, DATA[name]), "x", PROBS, keep=keep)
    assert got == pytest.approx(list(np.quantile(DATA[name], PROBS)), abs=1e-12)


@pytest.mark.parametrize("keep", [40, 100_000])
def test_disc(spark, keep):
    values = DATA["spread"]
    want = [float(np.sort(values)[max(0, int(np.ceil(p * len(values))) - 1)]) for p in PROBS]
    assert exact_quantiles(frame(spark, values), "x", PROBS, "disc", keep) == want


def test_empty_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantiles(df, "x", [0.5]) == [None]


def test_sketch_and_exact_agree(spark):
    df = frame(spark, DATA["spread"])
    sketch, exact = distance_quantiles(df, "x").first(), distance_quantiles(df, "x", exact=True).first()
    assert tuple(sketch) == pytest.approx(tuple(exact), abs=0.02)
