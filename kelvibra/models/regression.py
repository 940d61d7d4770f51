"""Linear models: expected temperature and vibration, and the anomaly classifiers (J1 to J6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.functions.expressions import calendar_features, severity_ladder
from kelvibra.operators.evaluation import evaluate
from kelvibra.operators.features import training_zscore
from kelvibra.operators.scans import scan_range
from kelvibra.plans.lineage import cut, kept

TREND_FEATURES = ("hour_of_day", "day_of_week", "temp_avg_5min", "vibration_avg_5min")
CLASS_FEATURES = (
    "temperature", "vibration", "temp_change", "vibration_change", "temp_avg_5min",
    "vibration_avg_5min", "temp_stddev_10min", "vibration_stddev_10min", "temp_z_score",
    "vibration_z_score",
)
LEAST_LOSS = 1e-15  # the least probability that a log loss counts


def _stages(rows: DataFrame, numeric: Sequence[str], category: str | None) -> list:
    """Feature stages. The rarest level of the category and levels not seen in training share the base
    level, which has no column of its own, so the columns stay independent of the intercept."""
    if category is None:
        return [VectorAssembler(inputCols=list(numeric), outputCol="features")]
    levels = StringIndexer(inputCol=category, outputCol="_index", handleInvalid="keep").fit(rows).labels
    index = StringIndexerModel.from_labels(list(levels[:-1]), inputCol=category, outputCol="_index",
                                           handleInvalid="keep")
    if len(levels) == 1:
        return [index, VectorAssembler(inputCols=list(numeric), outputCol="features")]
    return [
        index,
        OneHotEncoder(inputCols=["_index"], outputCols=["_type"]),
        VectorAssembler(inputCols=["_type", *numeric], outputCol="features"),
    ]


def trend_inputs(view: DataFrame) -> DataFrame:
    usable = view.dropna(subset=["temperature", "vibration", "temp_avg_5min", "vibration_avg_5min"])
    return calendar_features(usable)


def _fit_trend(view: DataFrame, label: str, other: str, as_of, days: int) -> PipelineModel:
    rows = trend_inputs(scan_range(view, f"{days} DAYS", as_of))
    # the normal equations need one pass over the rows
    line = LinearRegression(featuresCol="features", labelCol=label, predictionCol=f"predicted_{label}",
                            solver="normal")
    with kept(rows.select("device_type", *TREND_FEATURES, other, label)) as rows:
        return Pipeline(stages=[*_stages(rows, [*TREND_FEATURES, other], "device_type"), line]).fit(rows)


def fit_temperature(view: DataFrame, as_of=None, days: int = 7) -> PipelineModel:
    """J1. Temperature by device type, hour, weekday, vibration and the 5-row means."""
    return _fit_trend(view, "temperature", "vibration", as_of, days)


def fit_vibration(view: DataFrame, as_of=None, days: int = 7) -> PipelineModel:
    """J2. Vibration by the same, with temperature in its place."""
    return _fit_trend(view, "vibration", "temperature", as_of, days)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds the model's prediction; working columns are dropped."""
    work = ("features", "_index", "_type", "rawPrediction", "probability")
    scored = model.transform(rows)
    if "probability" in scored.columns:
        scored = scored.withColumn("anomaly_probability", vector_to_array("probability")[1])
    return scored.drop(*[c for c in work if c not in rows.columns])


def _balanced(rows: DataFrame, label: Column) -> DataFrame:
    """Weight n / (2 n_class), from one aggregate."""
    counts = rows.agg(F.count_if(label).alias("pos"), F.count_if(~label).alias("neg"))
    pos, neg = (counts.select(c).scalar() for c in ("pos", "neg"))
    own = F.when(label, pos).otherwise(neg)
    return rows.withColumns({"_label": label.cast("double"), "_weight": (pos + neg) / (2.0 * own)})


def _fit_classifier(rows: DataFrame, numeric: Sequence[str], category: str | None, label: str,
                    iterations: int) -> PipelineModel:
    rows = rows.select(*([category] if category else []), *numeric, F.col(label)) \
        .dropna(subset=[*numeric, label])
    curve = LogisticRegression(featuresCol="features", labelCol="_label", weightCol="_weight",
                               maxIter=iterations)
    with kept(rows) as rows:
        return Pipeline(stages=[*_stages(rows, numeric, category), curve]).fit(_balanced(rows, F.col(label)))


def classifier_inputs(view: DataFrame) -> DataFrame:
    """Rows of the training view with z-scores; a device's first row has no change and no deviation.
    Rows that lack a feature are left out."""
    return training_zscore(view).dropna(subset=list(CLASS_FEATURES))


def fit_anomaly_classifier(view: DataFrame, iterations: int = 50) -> PipelineModel:
    """J3. Class-balanced logistic regression of the label on 11 features. The label is the rule's
    verdict on the same readings, so a good fit says nothing about real faults."""
    return _fit_classifier(classifier_inputs(view), CLASS_FEATURES, "device_type", "label", iterations)


def fit_supervised(wide: DataFrame, label: str, iterations: int = 50) -> PipelineModel:
    """The wide classifier that J4 scores with."""
    return _fit_classifier(wide, S.WIDE_FEATURES, None, label, iterations)


def supervised_anomalies(model: PipelineModel, wide: DataFrame, as_of=None, days: int = 1) -> DataFrame:
    """J4. Rows of the last day predicted anomalous, their probability and severity. Rows that lack a feature
    are not predicted."""
    scored = predict(model, scan_range(wide, f"{days} DAYS", as_of).dropna(subset=list(S.WIDE_FEATURES)))
    p = F.col("anomaly_probability")
    return scored.filter(F.col("prediction") == 1.0).select(
        "device_id", "timestamp", "temperature", "humidity", "pressure", "vibration_level",
        "power_consumption", F.lit(True).alias("predicted_is_anomaly"), p.alias("anomaly_probability"),
        p.alias("anomaly_score"), severity_ladder(p).alias("anomaly_severity"),
        F.lit(S.METHODS["supervised"]).alias("detection_method"))


def evaluate_classifier(model: PipelineModel, view: DataFrame, as_of=None, days: int = 1) -> DataFrame:
    """J5. D9 and D10 over the last day's rows, and the mean log loss (null without rows)."""
    scored = predict(model, scan_range(classifier_inputs(view), f"{days} DAYS", as_of))
    rows = cut(scored.select(
        F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"),
        F.col("anomaly_probability").alias("score")))
    return evaluate(rows).withColumns({"model_name": F.lit("anomaly_classification"),
                                       "log_loss": rows.agg(log_loss("y_true", "score").alias("l")).scalar()})


def log_loss(label: str, probability: str) -> Column:
    """Mean of -ln of the probability given to what was the case; probabilities of 0 and 1 count as LEAST_LOSS from
    them."""
    p = F.greatest(F.lit(LEAST_LOSS), F.least(F.lit(1.0 - LEAST_LOSS), F.col(probability)))
    return F.avg(-F.ln(F.when(F.col(label) == 1, p).otherwise(1.0 - p)))


def feature_importance(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """J6. abs(coefficient) times the feature's deviation, ranked. One aggregate over the rows; the
    lines are as many as the features."""
    index, curve = model.stages[0], model.stages[-1]
    named = [f"device_type={v}" for v in index.labels] if hasattr(index, "labels") else []
    assembled = rows
    for stage in model.stages[:-1]:
        assembled = stage.transform(assembled)
    deviations = assembled.agg(Summarizer.std(F.col("features")).alias("d")).first()["d"].toArray()
    numeric = model.stages[-2].getInputCols()
    named = named if "_type" in numeric else []
    names = [*named, *[c for c in numeric if c != "_type"]]
    lines = sorted(((n, float(w), float(abs(w) * d)) for n, w, d in
                    zip(names, curve.coefficients.toArray(), deviations)), key=lambda x: -x[2])
    return rows.sparkSession.createDataFrame(
        [(place + 1, *line) for place, line in enumerate(lines)],
        "place int, feature string, coefficient double, importance double")


def global_explain(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """J6. The same by source column: the levels of a category count together."""
    return (feature_importance(model, rows)
            .groupBy(F.split("feature", "=")[0].alias("feature"))
            .agg(F.sum("importance").alias("attribution")).orderBy(F.desc("attribution"), "feature"))
