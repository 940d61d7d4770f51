import json

import pytest

from kelvibra import fixtures
from kelvibra.operators import parsing as P
from kelvibra.operators.rules import apply_rules, format_alert, format_reading
from kelvibra.settings import READING_COLUMNS
from kelvibra.sources.messages import alert_values

GOOD = {"device_id": "sensor_0001", "timestamp": "2024-05-01T10:00:00.250000", "device_type": "hvac_monitor",
        "location": {"building": "Building_A", "floor": 3, "room": "Room_101"},
        "sensor_data": {"temperature": 35.5, "vibration": 2.0}, "is_anomaly": True}


def parse(spark, *messages):
    raw = [(m if isinstance(m, str) or m is None else json.dumps(m),) for m in messages]
    return P.parse_messages(spark.createDataFrame(raw, "raw string"))


def changed(**values):
    return {**GOOD, **values}


@pytest.mark.parametrize("message,reason", [
    (GOOD, None),
    ("{\"device_id\": \"sens", "malformed_json"),
    ("", "malformed_json"), ("[1, 2]", "malformed_json"), ("null", "malformed_json"), (None, "malformed_json"),
    ({}, "missing_device_id"),
    (changed(device_id=None), "missing_device_id"),
    (changed(timestamp=None), "missing_timestamp"),
    (changed(sensor_data={"vibration": 1.0}), "missing_temperature"),
    (changed(sensor_data={"temperature": 1.0}), "missing_vibration"),
    (changed(sensor_data={"temperature": "25.5", "vibration": 1.0}), "bad_type"),
    (changed(sensor_data={"temperature": True, "vibration": 1.0}), "bad_type"),
    (changed(timestamp="nope"), "bad_timestamp"),
])
def test_reject_reasons(spark, message, reason):
    assert parse(spark, message).first()["reject_reason"] == reason


def test_record(spark):
    row = P.validate_required(parse(spark, GOOD)).first()
    assert row["location"].toPython()["floor"] == 3
    assert row["is_anomaly"] is True
    assert row["timestamp"].microsecond == 250000


def test_defaults(spark):
    message = {k: v for k, v in GOOD.items() if k not in ("is_anomaly", "location", "device_type")}
    row = format_reading(apply_rules(P.validate_required(parse(spark, message)))).first()
    assert row["location"] == "{}" and row["is_anomaly"] is True  # 35.5 is over the default limit of 35
    assert json.loads(row["anomaly_reasons"]) == ["Temperature too high: 35.5°C > 35°C"]


def test_offsets_are_instants(spark):
    rows = parse(spark, changed(timestamp="2024-05-01T12:00:00+02:00"), changed(timestamp="2024-05-01T10:00:00Z"))
    assert rows.select("timestamp").distinct().count() == 1


def test_stored_row_has_sixteen_columns(spark):
    row = format_reading(apply_rules(P.validate_required(parse(spark, GOOD)))).first().asDict()
    assert tuple(row) == READING_COLUMNS
    kinds = {"device_id": str, "temperature": float, "vibration_level": float, "is_anomaly": bool, "anomaly_score": float}
    assert all(isinstance(row[c], k) for c, k in kinds.items())
    assert row["anomaly_type"] == row["anomaly_severity"] == "warning"


def test_alert(spark):
    calm = changed(sensor_data={"temperature": 20.0, "vibration": 1.0})
    alerts = format_alert(apply_rules(P.validate_required(parse(spark, GOOD, calm)))).collect()
    assert len(alerts) == 1
    assert alerts[0]["alert_id"] == "sensor_0001_2024-05-01T10:00:00.250000"
    assert alerts[0]["details"]["location"].toPython()["room"] == "Room_101"


def test_nothing_is_lost(spark, sf):
    raw = fixtures.raw_messages(spark, sf)
    parsed = P.parse_messages(raw)
    kept, rejected = P.validate_required(parsed).count(), P.quarantine(parsed).count()
    assert kept + rejected == raw.count() == 1000
    assert rejected == 100


def test_wide_messages(spark):
    rows = P.parse_wide_messages(spark.createDataFrame(
        [('{"device_id": "a", "timestamp": "2024-01-01T00:00:00", "temperature": 70}',), ("{",)], "raw string")).collect()
    assert [r["reject_reason"] for r in rows] == [None, "malformed_json"]
    assert rows[0]["temperature"] == 70.0


def test_whole_location_is_stored(spark):
    message = {"device_id": "d", "timestamp": "2024-01-01T00:00:00", "device_type": "hvac_monitor",
               "location": {"building": "B", "floor": "G", "room": "R", "zone": {"id": 7}},
               "sensor_data": {"temperature": 50.0, "vibration": 1.0}}
    rows = apply_rules(P.validate_required(parse(spark, message)))
    assert json.loads(format_reading(rows).first()["location"]) == message["location"]
    alert = json.loads(alert_values(format_alert(rows)).first()["value"])
    assert alert["details"]["location"] == message["location"]
