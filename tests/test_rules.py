import math

import pytest
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.operators import rules as R
from kelvibra.operators.stats import zscore_flag

SCHEMA = "device_id string, device_type string, temperature double, vibration double"


def ruled(spark, rows):
    return R.apply_rules(spark.createDataFrame([("d", *r) for r in rows], SCHEMA)).collect()


@pytest.mark.parametrize("temperature,vibration,anomalous", [
    (25.0, 2.0, False), (5.0, 2.0, True), (45.0, 2.0, True), (25.0, 10.0, True), (50.0, 12.0, True)])
def test_rule_cases(spark, temperature, vibration, anomalous):
    row = ruled(spark, [("machinery_sensor", temperature, vibration)])[0]
    assert row["anomaly_detected"] is anomalous


def test_limits_are_strict(spark):
    rows = []
    for kind, (lo, hi) in S.TEMPERATURE_LIMITS.items():
        top = S.VIBRATION_LIMITS[kind]
        rows += [(kind, float(lo), top), (kind, float(hi), top)]
        rows += [(kind, lo - 0.01, top), (kind, hi + 0.01, top + 0.01)]
    out = ruled(spark, rows)
    assert [r["anomaly_severity"] for r in out] == ["normal", "normal", "warning", "critical"] * 3


def test_unknown_and_null_type_use_the_default(spark):
    out = ruled(spark, [("toaster", 9.0, 5.1), (None, 9.0, 5.1), (None, 36.0, 1.0), ("toaster", 35.0, 5.0)])
    assert [r["anomaly_score"] for r in out] == [1.0, 1.0, 0.6, 0.0]


def test_nan_and_null_are_not_anomalies(spark):
    out = ruled(spark, [("hvac_monitor", math.nan, math.nan), ("hvac_monitor", None, None)])
    assert [r["anomaly_detected"] for r in out] == [False, False]
    assert out[1]["temp_z_score"] is None


def test_reasons_and_scores(spark):
    row = ruled(spark, [("hvac_monitor", 31.5, 3.25)])[0]
    assert row["anomaly_reasons"] == [
        "Temperature too high: 31.5°C > 30°C", "Vibration too high: 3.25 mm/s > 3.0 mm/s"]
    assert (row["anomaly_score"], row["temp_z_score"], row["vibration_z_score"]) == (1.0, 1.9, 1.25)


def test_score_and_severity_follow_the_flags(spark, sf):
    from kelvibra import fixtures
    rows = fixtures.flagged(spark, sf).select("temp_anomaly", "vibration_anomaly", "anomaly_score",
                                              "anomaly_severity").distinct().collect()
    expected = {0: (0.0, "normal"), 1: (0.6, "warning"), 2: (1.0, "critical")}
    for r in rows:
        assert (r["anomaly_score"], r["anomaly_severity"]) == expected[r["temp_anomaly"] + r["vibration_anomaly"]]


def test_baseline_deviation_of_zero(spark):
    df = spark.createDataFrame([(25.0, 3.0), (None, 3.0)], "temperature double, vibration double")
    out = R.baseline_zscore(df, {"temperature": (22.0, 0.0), "vibration": (2.0, 1.0)}).collect()
    assert [r["temp_z_score"] for r in out] == [0.0, None]


WIDE = "temperature double, humidity double, pressure double, vibration_level double"


@pytest.mark.parametrize("row,score,flag", [
    ((20.0, 50.0, 1013.0, 1.0), 0.0, False),
    ((None, None, None, None), 0.0, False),
    ((41.0, 95.0, 940.0, 0.0), 0.7, False),       # 0.3 + 0.2 + 0.2 stays at the limit
    ((61.0, 50.0, 1013.0, 0.0), 0.8, True),
    ((-999.0, 50.0, 1013.0, 0.0), 1.0, True),     # failure reading
    ((20.0, -1.0, 1013.0, 3.0), 1.0, True),       # failure, then vibration, then the cap
    ((20.0, 50.0, 0.0, 0.0), 1.0, True),
    ((math.nan, 50.0, 1013.0, 2.5), 0.3, False),
])
def test_rule_score(spark, row, score, flag):
    out = R.rule_score(spark.createDataFrame([row], WIDE)).first()
    assert out["anomaly_score"] == pytest.approx(score, abs=1e-12)
    assert out["rule_based_anomaly"] is flag


def test_rules_need_no_shuffle_and_no_python(spark, sf):
    from kelvibra import fixtures
    from tests.helpers import plan_of
    plan = plan_of(R.format_reading(fixtures.flagged(spark, sf).withColumn("location", F.lit(None).cast(S.LOCATION))))
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_limits_table_matches_the_fixed_limits(spark):
    limits = spark.createDataFrame([(k, v) for k, v in S.VIBRATION_LIMITS.items()],
                                   "device_type string, vibration_max double")
    df = spark.createDataFrame([("hvac_monitor",), ("toaster",), (None,)], "device_type string")
    got = {r["device_type"]: r["vibration_max"] for r in R.limits_lookup(df, limits).collect()}
    assert got == {"hvac_monitor": 3.0, "toaster": 5.0, None: 5.0}


def test_zscore_flag(spark):
    df = spark.createDataFrame([(2.0, -2.5), (None, 2.1)], "temp_z_score double, vibration_z_score double")
    rows = zscore_flag(df).collect()
    assert [(r[2], r[3]) for r in rows] == [(False, True), (False, True)]
