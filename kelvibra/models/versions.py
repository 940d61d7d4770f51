"""Versions of a model, one of which is current.

Every version is written once below the model's folder. Which one is current is the newest entry of a log: entry n is a
folder of its own, and making it fails if it is there already, so that of two jobs that switch at once one is told so. A
reader sees an entry whole or not at all, as Spark's commit puts its file in place last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from kelvibra.models.registry import ModelRegistry
from kelvibra.operators.evaluation import best_model
from kelvibra.sources.tables import query_name, write_once


class ModelVersions:
    """The versions of one model under a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._held: dict[str, object] = {}

    def add(self, version: str, model) -> None:
        """Writes a version; one that is there already is an error. It does not become current."""
        if version in self.versions():
            raise ValueError(f"version {version!r} is there already")
        one = ModelRegistry()
        one.add("model", model)
        one.save(self.spark, f"{self.path}/versions/{version}")
        self.spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("append").json(f"{self.path}/named")

    def versions(self) -> list[str]:
        try:
            return sorted(r["version"] for r in self.spark.read.schema("version string").json(f"{self.path}/named").collect())
        except AnalysisException:
            return []

    def _log(self) -> tuple[int, str | None]:
        try:
            rows = self.spark.read.schema("entry long, version string").option("recursiveFileLookup", "true").json(f"{self.path}/current")
            found = rows.agg(F.max(F.struct("entry", "version")).alias("m")).first()["m"]
        except AnalysisException:
            found = None
        return (found["entry"], found["version"]) if found else (0, None)

    def current(self) -> str | None:
        return self._log()[1]

    def switch(self, version: str) -> None:
        """Makes a version current. An error if another job switches at the same time."""
        if version not in self.versions():
            raise ValueError(f"no version {version!r}")
        entry = self._log()[0] + 1
        line = self.spark.createDataFrame([(entry, version)], "entry long, version string").coalesce(1)
        line.write.mode("errorifexists").json(f"{self.path}/current/{entry:010d}")

    def switch_to_best(self, performance: DataFrame, name: str, metric: str = "f1_score", **range_) -> str | None:
        """F3 over the evaluations of this model's versions; the best becomes current if it is not. Returns it."""
        own = performance.filter((F.col("model_name") == name) & F.col("model_version").isin(self.versions()))
        best = best_model(own, metric, **range_).first()
        if best is None:
            return None
        if best["model_version"] != self.current():
            self.switch(best["model_version"])
        return best["model_version"]

    def load(self, version: str):
        if version not in self._held:
            self._held = {version: ModelRegistry.load(self.spark, f"{self.path}/versions/{version}").models["model"]}
        return self._held[version]


def score_with(model, rows: DataFrame) -> DataFrame:
    """A model's result on rows: `predict` of MLlib pipelines, `detect` of ours."""
    from kelvibra.models.regression import predict
    return predict(model, rows) if isinstance(model, PipelineModel) else model.detect(rows)


def score_live(rows: DataFrame, models: ModelVersions, table: str, checkpoint: str,
               prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows, **trigger) -> StreamingQuery:
    """Scores a stream with the version that is current when a batch starts, and stores it with the rows
    (`model_version`). A batch without a current version is an error, after which the query can be started again."""
    def work(batch: DataFrame, batch_id: int) -> None:
        version = models.current()
        if version is None:
            raise ValueError("no version is current")
        scored = score_with(models.load(version), prepare(batch)).withColumn("model_version", F.lit(version))
        write_once(scored, table, batch_id, query=query_name(batch.sparkSession, checkpoint))
    return (rows.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())
