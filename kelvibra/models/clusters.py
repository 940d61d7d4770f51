"""K-means over device profiles and over wide readings (J7, J8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known
from kelvibra.operators.detection import distance_anomalies
from kelvibra.operators.scans import scan_range
from kelvibra.operators.stats import distance_quantiles
from kelvibra.plans.lineage import kept

PROFILE = ("avg_temperature", "avg_vibration", "temp_variability", "vibration_variability",
           "reading_count")
WIDE = ("temperature", "humidity", "pressure", "vibration_level", "power_consumption", "heat_index",
        "hour_of_day", "device_type_encoded")


def _filled(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"_f_{c}": F.coalesce(known(F.col(c).cast("double")), F.lit(0.0)) for c in cols})


def fit_clusters(df: DataFrame, cols: Sequence[str], k: int = 5, seed: int = 42) -> PipelineModel:
    """Standardized columns, then k-means. Null and NaN count as 0."""
    stages = [
        VectorAssembler(inputCols=[f"_f_{c}" for c in cols], outputCol="_features"),
        StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True),
        KMeans(featuresCol="_scaled", predictionCol="cluster_id", k=k, seed=seed),
    ]
    with kept(_filled(df, cols).select(*[f"_f_{c}" for c in cols])) as rows:
        return Pipeline(stages=stages).fit(rows)


def _distance(centers) -> Column:
    """Euclidean distance to the row's own centre; the centres are k short literal arrays."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in center]) for center in centers])
    own = F.element_at(table, F.col("cluster_id") + 1)
    gaps = F.zip_with(vector_to_array("_scaled"), own, lambda x, c: (x - c) * (x - c))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g))


def assign_clusters(model: PipelineModel, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """cluster_id and distance_to_centroid."""
    placed = model.transform(_filled(df, cols))
    placed = placed.withColumn("distance_to_centroid", _distance(model.stages[-1].clusterCenters()))
    return placed.select(*df.columns, "cluster_id", "distance_to_centroid")


def device_clusters(profile: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """J7. Device profiles with their cluster."""
    return assign_clusters(fit_clusters(profile, PROFILE, k, seed), profile, PROFILE)


def kmeans_anomalies(model: PipelineModel, wide: DataFrame, as_of=None, days: int = 1,
                     cols: Sequence[str] = WIDE) -> DataFrame:
    """J8. Last day's rows farther from their centre than 95 percent of the rows."""
    placed = assign_clusters(model, scan_range(wide, f"{days} DAYS", as_of), cols)
    limits = distance_quantiles(placed, "distance_to_centroid")
    return distance_anomalies(placed, limits).select(
        "device_id", "timestamp", "temperature", "humidity", "pressure", "vibration_level",
        "power_consumption", "cluster_id", "distance_to_centroid", "anomaly_score",
        "anomaly_severity", "detection_method")
