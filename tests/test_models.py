import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelvibra import fixtures
from kelvibra.models import clusters, reconstruct, regression
from kelvibra.models.boundary import fit_one_class_boundary
from kelvibra.models.forecast import forecast_temperature
from kelvibra.models.isolation import fit_isolation_forest, mean_path
from kelvibra.models.registry import ModelRegistry
from kelvibra.operators import features as W
from kelvibra.operators import rules as R
from kelvibra.operators import stats
from tests.helpers import same_rows


@pytest.fixture(scope="module")
def cloud(spark):
    """1,900 points around (22, 2) and 100 far away."""
    rng = np.random.default_rng(11)
    near, far = rng.normal((22, 2), (1.5, 0.4), (1900, 2)), rng.normal((22, 2), 1, (100, 2))
    far += np.sign(rng.normal(size=(100, 2))) * (15, 7)
    rows = [(i, float(t), float(v), int(i >= 1900)) for i, (t, v) in enumerate(np.vstack([near, far]))]
    return spark.createDataFrame(rows, "reading_id long, temperature double, vibration double, outlier int").cache()


@pytest.fixture(scope="module")
def readings(spark, sf):
    return fixtures.readings(spark, sf).select("reading_id", "device_id", "timestamp", "temperature", "vibration")


@pytest.fixture(scope="module")
def view(spark, sf):
    rows = W.training_view(fixtures.stored(spark, sf)).cache()
    yield rows
    rows.unpersist()


def test_mean_path():
    assert mean_path(1) == 0 and mean_path(2) == 1
    assert float(mean_path(256)) == pytest.approx(10.24, abs=0.01)


def test_isolation_forest_finds_outliers(cloud):
    out = fit_isolation_forest(cloud).detect(cloud)
    assert out.filter("isolation_anomaly = 1").count() == 100
    assert out.filter("isolation_anomaly = 1 and outlier = 1").count() >= 95
    assert out.filter("(isolation_decision < 0) != (isolation_anomaly = 1)").count() == 0


def test_isolation_forest_ignores_partitioning(cloud):
    flags = [fit_isolation_forest(cloud.repartition(n), trees=20).detect(cloud).select("reading_id", "isolation_score", "isolation_anomaly")
             for n in (1, 8)]
    same_rows(*flags)


def test_isolation_trees_use_bounded_samples(cloud):
    forest = fit_isolation_forest(cloud, trees=10, sample=64)
    per_tree = forest.nodes.groupby("tree")["node"].count()
    assert len(per_tree) == 10 and per_tree.max() <= 127


def test_boundary_share_and_outliers(cloud):
    out = fit_one_class_boundary(cloud).detect(cloud)
    flagged = out.filter("boundary_anomaly = 1")
    assert abs(flagged.count() / 2000 - 0.05) <= 0.01
    assert flagged.filter("outlier = 1").count() >= 90


def test_boundary_agrees_with_the_forest(cloud):
    both = fit_one_class_boundary(cloud).decide(fit_isolation_forest(cloud).score(cloud))
    assert both.select(F.corr(-F.col("boundary_decision"), "isolation_score")).first()[0] > 0.3


def test_sequence_flags(readings):
    out = reconstruct.sequence_anomalies(readings)
    full = out.filter("sequence_error is not null").count()
    assert out.count() == 1000 and full == 1000 - 15 * 9
    assert abs(out.filter("sequence_anomaly = 1").count() / full - 0.05) < 0.01
    assert out.filter("sequence_error is null and sequence_anomaly = 1").count() == 0


def test_reconstruction_error_against_numpy(spark, sf):
    wide = fixtures.wide_inputs(spark, sf)
    cols = ["temperature", "humidity", "pressure", "vibration_level"]
    model = reconstruct.fit_autoencoder(wide, cols, k=2)
    got = np.array([r["mse"] for r in reconstruct.reconstruction_error(model, wide).orderBy("reading_id").collect()])
    x = np.array(wide.orderBy("reading_id").select(*cols).collect(), dtype=float)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    parts = np.linalg.svd(z, full_matrices=False)[2][:2]
    want = ((z - z @ parts.T @ parts) ** 2).mean(1)
    assert got == pytest.approx(want, abs=1e-8)


def test_autoencoder_high_share(spark, sf):
    wide = fixtures.wide_inputs(spark, sf)
    out = reconstruct.autoencoder_anomalies(reconstruct.fit_autoencoder(wide), wide, days=30)
    assert out.filter("anomaly_severity = 'HIGH'").count() == 20


def test_linear_models_recover_a_plane(spark, view):
    exact = view.withColumn("temperature", 3 + 2 * F.col("vibration") + F.col("temp_avg_5min"))
    model = regression.fit_temperature(exact, days=30)
    out = regression.predict(model, regression.trend_inputs(exact))
    assert out.select(F.max(F.abs(F.col("temperature") - F.col("predicted_temperature")))).first()[0] < 1e-5
    assert "features" not in out.columns


def test_linear_model_beats_the_mean(view):
    out = regression.predict(regression.fit_vibration(view, days=30), regression.trend_inputs(view))
    model, base = out.select(F.avg(F.pow(F.col("vibration") - F.col("predicted_vibration"), 2)), F.var_pop("vibration")).first()
    assert model < base


def test_classifier(view):
    model = regression.fit_anomaly_classifier(view)
    scored = regression.predict(model, regression.classifier_inputs(view))
    # the two classes weigh the same, so a useful model must find most of both
    recall = scored.groupBy("label").agg(F.avg((F.col("prediction") == F.col("label").cast("int")).cast("int"))).collect()
    assert all(r[1] > 0.6 for r in recall)
    importance = regression.feature_importance(model, regression.classifier_inputs(view)).collect()
    assert [r["place"] for r in importance] == list(range(1, len(importance) + 1))
    names = {r["feature"] for r in importance}
    assert names >= set(regression.CLASS_FEATURES)
    # five levels, one of them the base
    assert sum(n.startswith("device_type=") for n in names) == 4
    explained = regression.global_explain(model, regression.classifier_inputs(view))
    assert explained.count() == 11
    row = regression.evaluate_classifier(model, view, days=30).first()
    assert row["auc_roc"] > 0.7


def test_supervised(spark, sf):
    wide = R.wide_features(R.rule_score(fixtures.readings_wide(spark, sf)).drop("anomaly_score"))
    out = regression.supervised_anomalies(regression.fit_supervised(wide, "rule_based_anomaly"), wide, days=30)
    assert out.filter("anomaly_probability <= 0.5").count() == 0
    assert out.filter("anomaly_severity = 'HIGH' and anomaly_probability <= 0.8").count() == 0


def test_clusters(spark, sf):
    profile = stats.device_profile(fixtures.stored(spark, sf), days=30)
    out = clusters.device_clusters(profile, k=5)
    assert out.count() == profile.count() and out.select("cluster_id").distinct().count() == 5


def test_distance_to_centroid(spark):
    points = spark.createDataFrame([(0.0,), (2.0,), (100.0,), (102.0,)], "x double")
    out = clusters.assign_clusters(clusters.fit_clusters(points, ["x"], k=2), points, ["x"])
    deviation = np.std([0, 2, 100, 102], ddof=1)
    assert [r["distance_to_centroid"] for r in out.orderBy("x").collect()] == pytest.approx([1 / deviation] * 4)


def test_kmeans_anomaly_share(spark, sf):
    wide = fixtures.wide_inputs(spark, sf)
    out = clusters.kmeans_anomalies(clusters.fit_clusters(wide, clusters.WIDE), wide, days=30)
    assert abs(out.count() - 50) <= 1 and abs(out.filter("anomaly_severity = 'HIGH'").count() - 10) <= 1


def test_forecast_recovers_trend_and_hours(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(d, "t", start + dt.timedelta(hours=h), 10.0 + 0.05 * h + 3 * np.sin(h % 24 / 24 * 2 * np.pi))
            for d in ("a", "b") for h in range(24 * 14)]
    df = spark.createDataFrame([(d, k, t, float(y)) for d, k, t, y in rows],
                               "device_id string, device_type string, timestamp timestamp_ntz, temperature double")
    out = forecast_temperature(df).filter("device_id = 'a'").orderBy("hour_bucket").collect()
    assert len(out) == 24
    assert out[-1]["hour_bucket"] == start + dt.timedelta(hours=24 * 14 - 1)
    truth = {t: y for d, _, t, y in rows if d == "a"}
    assert max(abs(r["predicted_temperature"] - truth[r["hour_bucket"]]) for r in out) < 0.6
    assert all(r["prediction_interval_lower_bound"] <= r["predicted_temperature"] for r in out)
    assert forecast_temperature(df, min_rows=24 * 14).count() == 0


def test_registry(spark, cloud, tmp_path):
    models = ModelRegistry()
    with pytest.raises(ValueError, match="not trained"):
        models.predict("isolation_forest", cloud)
    models.add("isolation_forest", fit_isolation_forest(cloud, trees=10))
    models.add("one_class", fit_one_class_boundary(cloud, steps=2))
    models.add("clusters", clusters.fit_clusters(cloud, ["temperature", "vibration"], k=2))
    models.save(spark, str(tmp_path / "models"))
    again = ModelRegistry.load(spark, str(tmp_path / "models"))
    for name, score in (("isolation_forest", "isolation_score"), ("one_class", "boundary_decision")):
        same_rows(models.predict(name, cloud).select("reading_id", score), again.predict(name, cloud).select("reading_id", score))
    filled = cloud.withColumns({"_f_temperature": F.col("temperature"), "_f_vibration": F.col("vibration")})
    same_rows(models.predict("clusters", filled).select("reading_id", "cluster_id"),
              again.predict("clusters", filled).select("reading_id", "cluster_id"))
