"""A reading that is not a number counts as missing, in frames, aggregates and models."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelvibra.functions.quantiles import exact_quantiles
from kelvibra.models.boundary import one_class_boundary
from kelvibra.models.isolation import fit_isolation_forest, isolation_forest
from kelvibra.models.reconstruct import sequence_anomalies
from kelvibra.models.run import model_run
from kelvibra.operators import features as W
from kelvibra.operators import stats

NAN, START = float("nan"), dt.datetime(2024, 1, 1)
SCHEMA = "reading_id long, device_id string, timestamp timestamp_ntz, temperature double, vibration double"


@pytest.fixture(scope="module")
def damaged(spark):
    """1,000 readings of five devices, one of them NaN and one null."""
    rng = np.random.default_rng(5)
    rows = [(i, f"d{i % 5}", START + dt.timedelta(minutes=i), float(t), float(v))
            for i, (t, v) in enumerate(rng.normal((22, 2), (3, 0.5), (1000, 2)))]
    rows[50] = (*rows[50][:3], NAN, rows[50][4])
    rows[203] = (*rows[203][:3], None, rows[203][4])
    return spark.createDataFrame(rows, SCHEMA).cache()


def values(df, column):
    return [r[0] for r in df.orderBy("reading_id").select(column).collect()]


def test_frames_skip_it(spark, damaged):
    plain = damaged.withColumn("temperature", F.when(~F.isnan("temperature"), F.col("temperature")))
    for build in (W.change_features, W.rolling_mean, W.rolling_std, W.dashboard_zscore, W.eps_features):
        names = [c for c in build(damaged).columns if c not in damaged.columns and "ratio" not in c and "product" not in c]
        for c in names:
            assert values(build(damaged), c) == values(build(plain), c)
            assert not any(x is not None and math.isnan(x) for x in values(build(damaged), c))
    assert None not in values(W.rolling_mean(damaged).filter("reading_id >= 5"), "temp_avg_5")


def test_aggregates_skip_it(damaged):
    known = [x for x in values(damaged, "temperature") if x is not None and not math.isnan(x)]
    line = stats.kpis(damaged.withColumn("is_anomaly", F.lit(False))).first()
    assert line["total_readings"] == 1000 and line["avg_temperature"] == pytest.approx(np.mean(known))
    scaled = values(W.scale_standard(damaged, ["temperature"]), "temperature_scaled")
    assert sum(x is None for x in scaled) == 2 and not any(math.isnan(x) for x in scaled if x is not None)


def test_models_stay_finite(damaged):
    forest = isolation_forest(damaged)
    assert forest.select("isolation_score").distinct().count() > 950
    assert forest.filter("isolation_anomaly = 1").count() == 50
    assert one_class_boundary(damaged).filter("boundary_anomaly = 1").count() == 50
    found = sequence_anomalies(damaged)
    assert found.filter("sequence_error is null or isnan(sequence_error)").count() == 5 * 9
    assert found.filter("sequence_anomaly = 1").count() == math.ceil(0.05 * (1000 - 45 - 1))


def test_model_run(damaged):
    labels = damaged.select("reading_id", (F.col("reading_id") % 20 == 0).cast("int").alias("y_true"))
    lines = {r["model_name"]: r for r in model_run(damaged, labels).collect()}
    assert sorted(lines) == ["ensemble", "isolation_forest", "one_class_boundary", "sequences"]
    assert all(0 <= r["accuracy"] <= 1 for r in lines.values())


def test_forest_takes_rows_that_share_a_key(damaged):
    for key in ("device_id", ["device_id", "timestamp"]):
        forest = fit_isolation_forest(damaged, key=key)
        assert forest.sample == 256 and forest.nodes.groupby("tree").ngroups == 100
        assert forest.score(damaged).select("isolation_score").distinct().count() > 950
    assert fit_isolation_forest(damaged.withColumn("k", F.lit(1)), ["vibration"], key="k").sample == 256


def test_forest_of_equal_rows(spark):
    same = spark.range(500).select(F.lit(1).alias("reading_id"), F.lit(2.0).alias("temperature"), F.lit(3.0).alias("vibration"))
    assert isolation_forest(same).filter("isolation_anomaly = 1").count() == 0


def test_quantiles_do_not_depend_on_what_is_kept(damaged):
    few, many = (exact_quantiles(damaged, "vibration", [0.05, 0.37, 0.95], keep=k) for k in (100, 100_000))
    assert few == many
