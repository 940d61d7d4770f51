"""The detectors over one table: features, three models, their vote, and the metrics of all four."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvibra.models.boundary import one_class_boundary
from kelvibra.models.isolation import isolation_forest
from kelvibra.models.reconstruct import sequence_anomalies
from kelvibra.operators.detection import ensemble_vote, join_votes
from kelvibra.operators.evaluation import evaluate_all
from kelvibra.operators.features import eps_features, fill_gaps
from kelvibra.plans.lineage import cut

MODEL_FEATURES = ("temperature", "vibration", "temp_z_score", "vibration_z_score", "temp_change",
                  "vibration_change", "temp_vibration_ratio")


def model_votes(readings: DataFrame, key: str = "reading_id") -> DataFrame:
    """A row per reading: the flags of the isolation forest and the boundary (on seven features) and of the
    sequences (on both readings), and their vote. Gaps are filled within a device; what is left counts as 0."""
    rows = fill_gaps(eps_features(readings), MODEL_FEATURES).fillna(0.0, list(MODEL_FEATURES))
    rows = cut(rows.select(key, "device_id", "timestamp", *MODEL_FEATURES))
    found = {
        "isolation_forest": isolation_forest(rows, MODEL_FEATURES, key=key).withColumnRenamed("isolation_anomaly", "flag"),
        "one_class_boundary": one_class_boundary(rows, MODEL_FEATURES).withColumnRenamed("boundary_anomaly", "flag"),
        "sequences": sequence_anomalies(rows.select(key, "device_id", "timestamp", "temperature", "vibration"))
        .withColumnRenamed("sequence_anomaly", "flag"),
    }
    return ensemble_vote(join_votes(key, **found), list(found))


def model_run(readings: DataFrame, labels: DataFrame, key: str = "reading_id") -> DataFrame:
    """J19 over the models: a line of metrics for each detector and for the vote. `labels` has the key and
    y_true."""
    votes = model_votes(readings, key)
    names = [c for c in votes.columns if c != key]
    return evaluate_all(cut(votes.join(labels, key)), names)
