import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.operators import detection as D
from kelvibra.operators import evaluation as E
from kelvibra.operators import stats
from tests.helpers import by_key


def labelled(spark, y, p, s=None):
    s = [float(v) for v in (s if s is not None else p)]
    return spark.createDataFrame([("m", int(a), int(b), c) for a, b, c in zip(y, p, s)],
                                 "model_name string, y_true int, y_pred int, score double")


def test_one_class_gives_zeros(spark):
    row = E.evaluate(labelled(spark, [0, 0, 0], [0, 0, 0]), ["model_name"]).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["auc_roc"]) == (0, 0, 0, 0)
    assert row["accuracy"] == 1


def test_auc_against_pairs(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 600)
    for scores in (rng.normal(size=600) + y, rng.integers(0, 4, 600), np.where(rng.random(600) < 0.4, 0.0, rng.random(600))):
        pos, neg = scores[y == 1], scores[y == 0]
        want = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
        table = labelled(spark, y, y, scores)
        for by in (["model_name"], []):
            for max_rows in (100_000, 3, 50):
                got = E.auc_roc(table, by, max_rows=max_rows).first()["auc_roc"]
                assert got == pytest.approx(want, abs=1e-12)


def test_auc_without_scores(spark):
    df = labelled(spark, [0, 1], [0, 1]).withColumn("score", F.lit(None).cast("double"))
    rows = E.auc_roc(df, ["model_name"]).collect()
    assert len(rows) == 1 and rows[0]["auc_roc"] is None


def test_vote_of_equal_models_and_ties(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 1, 0), (1, 1, 1), (1, 0, 0)], "a int, b int, c int")
    assert [r["v"] for r in D.ensemble_vote(df, ["a", "b", "c"], "v").collect()] == [0, 1, 1, 0]
    assert [r["v"] for r in D.ensemble_vote(df, ["a", "b"], "v").collect()] == [0, 1, 1, 0]
    same = D.ensemble_vote(df.select("a", F.col("a").alias("b")), ["a", "b"], "v").collect()
    assert all(r["v"] == r["a"] for r in same)


def test_votes_scored_apart(spark):
    a = spark.createDataFrame([(1, 1), (2, 0)], "reading_id int, flag int")
    b = spark.createDataFrame([(2, 1), (1, 1)], "reading_id int, flag int")
    joined = D.join_votes("reading_id", a=a, b=b)
    assert by_key(D.ensemble_vote(joined, ["a", "b"]))[1]["ensemble"] == 1


PERF = "model_name string, model_version string, evaluation_timestamp timestamp, " + \
    ", ".join(f"{m} double" for m in S.METRIC_COLUMNS) + ", training_data_size bigint, evaluation_data_size bigint"


def perf(spark, *rows):
    def line(name, day, f1, fpr=0.05, fnr=0.1, auc=0.5):
        return (name, "1", dt.datetime(2024, 1, day), 0.9, 0.8, f1, 0.9, auc, fpr, fnr, 10, 10)
    return spark.createDataFrame([line(*r) for r in rows], PERF)


def test_latest_takes_the_newest_known_value(spark):
    row = E.latest_per_model(perf(spark, ("a", 1, 0.5, 0.0, 0.0, 0.7), ("a", 2, 0.6, 0.0, 0.0, None))).first()
    assert (row["f1_score"], row["auc_roc"]) == (0.6, 0.7)


@pytest.mark.parametrize("rows,advice", [
    ([("a", 1, 0.9)], ""),
    ([("a", 1, 0.6)], S.ADVICE[0][3]),
    ([("a", 1, 0.6), ("b", 1, 0.8)], ""),
    ([("a", 1, 0.9, 0.2, 0.3)], f"{S.ADVICE[1][3]}|{S.ADVICE[2][3]}"),
])
def test_advice(spark, rows, advice):
    assert E.performance_report(perf(spark, *rows)).first()["advice"] == advice


def test_report_without_evaluations(spark):
    assert E.performance_report(perf(spark, ("a", 1, 0.9)).filter("false")).count() == 0


def test_best_model(spark):
    table = perf(spark, ("b", 3, 0.9), ("a", 4, 0.9), ("c", 2, None))
    assert E.best_model(table).first()["model_name"] == "a"
    report = E.performance_report(table).first()
    assert report["best_f1_score_model"] == "a" and report["best_f1_score"] == 0.9
    with pytest.raises(ValueError):
        E.best_model(table, "f1_score; drop table x")


def test_compare_is_newest_first(spark):
    days = [r["evaluation_timestamp"].day for r in E.compare_models(perf(spark, ("a", 2, 0.1), ("a", 5, 0.1), ("b", 3, 0.1))).collect()]
    assert days == [5, 3, 2]


def test_histogram_counts_everything_known(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)] + [(None,), (float("nan"),)], "x double")
    rows = stats.histogram(df, "x", bins=10, by=None).orderBy("bin").collect()
    assert [r["readings"] for r in rows] == [10] * 9 + [11]
    constant = stats.histogram(df.filter("x = 3"), "x", by=None).collect()
    assert [(r["bin"], r["readings"]) for r in constant] == [(0, 1)]


def test_kpis_of_nothing(spark):
    empty = spark.createDataFrame([], "device_id string, temperature double, is_anomaly boolean")
    row = stats.kpis(empty).first()
    assert (row["total_readings"], row["anomaly_rate"], row["avg_temperature"]) == (0, 0.0, None)


def test_device_stats_rounds_to_two_places(spark):
    df = spark.createDataFrame([("a", 1.005, 2.0, True), ("a", 2.0, 2.0, False)],
                               "device_id string, temperature double, vibration double, is_anomaly boolean")
    row = stats.device_stats(df).first()
    assert (row["temperature_mean"], row["vibration_std"], row["is_anomaly_sum"]) == (1.5, 0.0, 1)


def test_cross_scalar_refuses_many_rows(spark):
    df = spark.range(3)
    assert D.cross_scalar(df, df.agg(F.max("id").alias("top"))).agg(F.sum("top")).first()[0] == 6
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        D.cross_scalar(df, df.select(F.col("id").alias("top"))).collect()
