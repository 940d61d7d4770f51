"""Schemas and the fixed numbers of the telemetry domain."""

from pyspark.sql import types as T

# --- Fixed values: limits, baselines, bands, names and texts that results depend on ---------------

DEFAULT_DEVICE_TYPE = "industrial_sensor"

TEMPERATURE_LIMITS = {
    "industrial_sensor": (10, 35),
    "hvac_monitor": (15, 30),
    "machinery_sensor": (12, 40),
}

VIBRATION_LIMITS = {
    "industrial_sensor": 5.0,
    "hvac_monitor": 3.0,
    "machinery_sensor": 8.0,
}

# (mean, deviation) of the fixed-baseline z-scores
BASELINES = {"temperature": (22.0, 5.0), "vibration": (2.0, 1.0)}

# score = 0.5 per raised flag, times the severity's factor, at most 1
FLAG_WEIGHT = 0.5
SEVERITY_FACTORS = {"normal": 1.0, "warning": 1.2, "critical": 1.5}

# wide-message rule: (column, value when missing, ((low, high, points), ...)); points add up in this order
RULE_BANDS = (
    ("temperature", 0.0, ((-10.0, 40.0, 0.3), (-50.0, 60.0, 0.5))),
    ("humidity", 50.0, ((10.0, 90.0, 0.2), (0.0, 100.0, 0.4))),
    ("pressure", 1013.0, ((950.0, 1050.0, 0.2), (800.0, 1200.0, 0.4))),
)
FAILURE_READINGS = {"temperature": -999.0, "humidity": -1.0, "pressure": 0.0}
RULE_VIBRATION = ("vibration_level", 0.0, 2.0, 0.3)
RULE_FLAG_ABOVE = 0.7

CATEGORY_CODES = {
    "device_type": ({"environmental_sensor": 1, "industrial_sensor": 2, "smart_meter": 3}, 0),
    "zone": ({"A": 1, "B": 2, "C": 3}, 0),
    "criticality": ({"low": 1, "medium": 2, "high": 3}, 2),
}

SEVERITY_CUTS = (("HIGH", 0.8), ("MEDIUM", 0.6), ("LOW", 0.4))

# forecast errors: outside the interval, then (error above, score, severity), else the last pair
FORECAST_OUTSIDE = (0.8, "HIGH")
FORECAST_STEPS = ((5.0, 0.6, "MEDIUM"), (3.0, 0.4, "LOW"))
FORECAST_ELSE = (0.2, "NORMAL")
FORECAST_KEEP_ABOVE = 2.0

# distances: (quantile, score, severity) from the far end inwards
DISTANCE_STEPS = ((0.99, 0.9, "HIGH"), (0.95, 0.7, "MEDIUM"))

METHODS = {
    "reconstruction": "autoencoder",
    "clusters": "kmeans",
    "forecast": "time_series_forecast",
    "supervised": "supervised_classification",
}

ADVICE = (
    ("f1_score", "below", 0.7, "Consider retraining models with more data or different hyperparameters."),
    ("false_positive_rate", "above", 0.1, "High false positive rate detected. Consider adjusting decision thresholds."),
    ("false_negative_rate", "above", 0.2, "High false negative rate detected. This could lead to missed anomalies."),
)

EPSILON = 1e-8

# --- Schemas ---------------------------------------------------------------------------------------

REQUIRED_FIELDS = ("device_id", "timestamp", "temperature", "vibration")

# any JSON: what a device adds to its location is stored as well
LOCATION = "variant"

MESSAGE_SCHEMA = (
    "device_id string, timestamp string, device_type string, "
    f"location {LOCATION}, "
    "sensor_data struct<temperature: double, vibration: double, anomaly_type: string>, "
    "is_anomaly boolean"
)

WIDE_MESSAGE_SCHEMA = (
    "device_id string, timestamp string, device_type string, temperature double, humidity double, "
    "pressure double, vibration_level double, power_consumption double, is_anomaly boolean"
)


def _struct(required: str, optional: str) -> T.StructType:
    fields = [(d, False) for d in required.split(", ")] + [(d, True) for d in optional.split(", ")]
    out = T.StructType()
    for declaration, nullable in fields:
        name, kind = declaration.split(" ")
        out = out.add(name, kind, nullable)
    return out


READING_COLUMNS = (
    "device_id", "device_type", "location", "timestamp", "processed_at", "temperature",
    "vibration_level", "is_anomaly", "anomaly_type", "anomaly_score", "anomaly_reasons",
    "anomaly_severity", "temp_anomaly", "vibration_anomaly", "temp_z_score", "vibration_z_score",
)

# One superset of the two layouts in use: what the rule job writes, and the wide provisioned columns.
SENSOR_DATA = _struct(
    "device_id string, timestamp timestamp, temperature double, vibration_level double, is_anomaly boolean",
    "device_type string, location string, processed_at timestamp, anomaly_type string, "
    "anomaly_score double, anomaly_reasons string, anomaly_severity string, temp_anomaly boolean, "
    "vibration_anomaly boolean, temp_z_score double, vibration_z_score double, humidity double, "
    "pressure double, power_consumption double, rule_based_anomaly boolean, ml_anomaly_score double, "
    "ml_anomaly_prediction boolean",
)

ANOMALY_ALERTS = _struct(
    "alert_id string, device_id string, alert_timestamp timestamp, anomaly_type string, "
    "severity string, anomaly_score double, alert_status string",
    "sensor_values string, acknowledged_by string, acknowledged_at timestamp, resolved_at timestamp",
)

METRIC_COLUMNS = (
    "precision", "recall", "f1_score", "accuracy", "auc_roc", "false_positive_rate",
    "false_negative_rate",
)

MODEL_PERFORMANCE = _struct(
    "model_name string, model_version string, evaluation_timestamp timestamp",
    ", ".join(f"{m} double" for m in METRIC_COLUMNS)
    + ", training_data_size long, evaluation_data_size long",
)

DETECTION_COLUMNS = (
    "device_id", "timestamp", "anomaly_score", "anomaly_severity", "detection_method",
)

WIDE_FEATURES = (
    "temperature", "humidity", "pressure", "vibration_level", "power_consumption", "heat_index",
    "hour_of_day", "device_type_encoded", "zone_encoded", "criticality_encoded",
)
