"""Reconstruction-error detectors (J11, J14).

J11 stands in for a neural autoencoder: rows are projected on the leading components and scored by what
the projection loses. The components are orthonormal, so the loss of a centred row is its squared
length less that of its projection, and no row is actually rebuilt. J14's models are in `sequences.py`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.functions.expressions import known, severity_ladder
from kelvibra.functions.quantiles import exact_quantiles
from kelvibra.models.sequences import fit_components, fit_network, fit_scale, with_lags
from kelvibra.operators.scans import moment_of, scan_range
from kelvibra.plans.lineage import cut, kept


def _square_sum(vector: str) -> Column:
    return F.aggregate(vector_to_array(vector), F.lit(0.0), lambda acc, x: acc + x * x)


def _loss(width: int) -> Column:
    return F.greatest(F.lit(0.0), _square_sum("_centred") - _square_sum("_parts")) / F.lit(float(width))


def fit_autoencoder(wide: DataFrame, cols: Sequence[str] = S.WIDE_FEATURES, k: int = 4) -> PipelineModel:
    """Standardize, then k components."""
    rows = wide.select(*[F.coalesce(known(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in cols])
    stages = [
        VectorAssembler(inputCols=list(cols), outputCol="_features"),
        StandardScaler(inputCol="_features", outputCol="_centred", withMean=True, withStd=True),
        PCA(inputCol="_centred", outputCol="_parts", k=k),
    ]
    with kept(rows) as rows:
        return Pipeline(stages=stages).fit(rows)


def reconstruction_error(model: PipelineModel, df: DataFrame) -> DataFrame:
    """mse: mean squared loss per feature."""
    cols = model.stages[0].getInputCols()
    rows = df.withColumns({c: F.coalesce(known(F.col(c).cast("double")), F.lit(0.0)) for c in cols})
    return model.transform(rows).withColumn("mse", _loss(len(cols))) \
        .drop("_features", "_centred", "_parts")


def autoencoder_anomalies(model: PipelineModel, wide: DataFrame, as_of=None, days: int = 1,
                          contamination: float = 0.02) -> DataFrame:
    """J11. Last day's rows with score min(1, 0.8 mse / q), q the (1 - contamination) quantile of mse,
    so that HIGH is the contamination share."""
    scored = reconstruction_error(model, scan_range(wide, f"{days} DAYS", as_of))
    limit = scored.agg(F.percentile_approx("mse", 1.0 - contamination, 10_000).alias("q")).scalar()
    score = F.least(F.lit(1.0), F.coalesce(
        F.try_divide(F.lit(S.SEVERITY_CUTS[0][1]) * F.col("mse"), limit), F.lit(0.0)))
    return scored.withColumn("anomaly_score", score).select(
        "device_id", "timestamp", "temperature", "humidity", "pressure", "vibration_level",
        "power_consumption", "anomaly_score", severity_ladder("anomaly_score").alias("anomaly_severity"),
        F.lit(S.METHODS["reconstruction"]).alias("detection_method"))


def sequence_anomalies(df: DataFrame, cols: Sequence[str] = ("temperature", "vibration"), n: int = 10,
                       pct: float = 0.95, k: int = 4, share: float = 0.8, model=None, kind: str = "components") -> DataFrame:
    """J14. sequence_error and sequence_anomaly of every row: 1 on the last row of a sequence whose error
    exceeds the batch's `pct` quantile, 0 elsewhere and on each device's first n - 1 rows. Without a
    given model the sequences of the first `share` of the readings in time train one: `components` or a `network`."""
    if model is None:
        scale, until = fit_scale(df, cols, share)
        lagged = with_lags(df, scale, n)
        train = lagged.filter(F.col("timestamp") <= moment_of(df, until, "timestamp"))
        model = fit_components(train, scale, n, k) if kind == "components" else fit_network(train, scale, n, k)
    else:
        lagged = with_lags(df, model.scale, model.n)
    scored = cut(model.score(lagged).select(*df.columns, "sequence_error"))
    limit = exact_quantiles(scored, "sequence_error", [pct])[0]
    flag = F.coalesce((F.col("sequence_error") > F.lit(limit)).cast("int"), F.lit(0))
    return scored.withColumn("sequence_anomaly", flag)
