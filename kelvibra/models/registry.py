"""A11. Models by name: keep, score, save, load. A model is an MLlib pipeline or one of our own with
`detect`, `save` and `load`."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from kelvibra.models.boundary import OneClassBoundary
from kelvibra.models.isolation import IsolationForest
from kelvibra.models.sequences import SequenceComponents, SequenceNetwork
from kelvibra.models.support import SupportVectors

KINDS = {kind.__name__: kind for kind in (IsolationForest, OneClassBoundary, SequenceComponents, SequenceNetwork,
                                        SupportVectors)}


class ModelRegistry:
    def __init__(self) -> None:
        self.models: dict[str, object] = {}

    def add(self, name: str, model) -> None:
        self.models[name] = model

    def predict(self, name: str, df: DataFrame) -> DataFrame:
        """Scores with a named model; an unknown name is an error."""
        if name not in self.models:
            raise ValueError(f"model {name!r} is not trained")
        model = self.models[name]
        return model.transform(df) if isinstance(model, PipelineModel) else model.detect(df)

    def save(self, spark: SparkSession, path: str) -> None:
        kinds = []
        for name, model in self.models.items():
            if isinstance(model, PipelineModel):
                model.write().overwrite().save(f"{path}/{name}")
            else:
                model.save(spark, f"{path}/{name}")
            kinds.append((name, type(model).__name__))
        spark.createDataFrame(kinds, "name string, kind string").coalesce(1) \
            .write.mode("overwrite").json(f"{path}/_models")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelRegistry:
        out = cls()
        for row in spark.read.schema("name string, kind string").json(f"{path}/_models").collect():
            place = f"{path}/{row['name']}"
            own = KINDS.get(row["kind"])
            out.add(row["name"], own.load(spark, place) if own else PipelineModel.load(place))
        return out
