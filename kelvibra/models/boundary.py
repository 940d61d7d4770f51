"""J13. One-class boundary with an RBF kernel.

The kernel is approximated by random cosine features (Rahimi and Recht 2007), on which the one-class
objective |w|^2 / 2 - rho + mean(max(0, rho - w.f)) / nu is linear. Each step is one pass: partitions send
one partial sum per feature, Spark adds them up, and the driver sees only the sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known
from kelvibra.functions.quantiles import exact_quantiles
from kelvibra.models.isolation import standard_scale
from kelvibra.plans.lineage import cut, spread

BINS = 1024


def _cosines(x: np.ndarray, seed: int, features: int) -> np.ndarray:
    """Random features for gamma = 1 / columns, the usual choice on standardized columns. Single
    precision: the approximation of the kernel is far coarser."""
    rng = np.random.default_rng(seed)
    width = x.shape[1]
    directions = rng.normal(0.0, np.sqrt(2.0 / width), (width, features)).astype(np.float32)
    shifts = rng.uniform(0, 2 * np.pi, features).astype(np.float32)
    waves = x.astype(np.float32) @ directions
    waves += shifts
    np.cos(waves, out=waves)
    waves *= np.float32(np.sqrt(2.0 / features))
    return waves


@dataclass
class OneClassBoundary:
    cols: list[str]
    centre: list[float]
    scale: list[float]
    features: int
    seed: int
    nu: float
    weights: list[float]
    offset: float = 0.0

    def _scaled(self):
        return [F.coalesce((known(F.col(c).cast("double")) - F.lit(m)) / F.lit(s), F.lit(0.0)).alias(f"x{i}")
                for i, (c, m, s) in enumerate(zip(self.cols, self.centre, self.scale))]

    def _settings(self) -> tuple[np.ndarray, float, int, int]:
        return np.array(self.weights, dtype=np.float32), self.offset, self.features, self.seed

    def _pass(self, inputs: DataFrame, everyone: bool = False) -> tuple[np.ndarray, float, float]:
        """One pass: the feature sum over rows inside the margin (or all), their number, and the nu
        quantile of w.f, read off a histogram over the range that w.f cannot leave."""
        w, rho, features, seed = self._settings()
        reach = np.sqrt(2.0) * np.linalg.norm(w) or 1.0
        slots = features + 1 + BINS

        def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(slots)
            for batch in batches:
                f = _cosines(batch.to_numpy(), seed, features)
                value = f @ w
                chosen = f if everyone else f[value < rho]
                total[:features] += chosen.sum(axis=0, dtype=float)
                total[features] += len(chosen)
                total[features + 1:] += np.histogram(value, BINS, (-reach, reach))[0]
            yield pd.DataFrame({"slot": np.arange(slots), "total": total})

        sums = (inputs.mapInPandas(partial, "slot int, total double").groupBy("slot")
                .agg(F.sum("total").alias("total")).orderBy("slot").collect())  # `slots` lines
        out = np.array([r["total"] for r in sums])
        counts = np.cumsum(out[features + 1:])
        edge = np.searchsorted(counts, self.nu * counts[-1])
        return out[:features], float(out[features]), reach * (2.0 * (edge + 1) / BINS - 1.0)

    def decide(self, df: DataFrame, name: str = "boundary_decision") -> DataFrame:
        w, rho, features, seed = self._settings()

        @F.pandas_udf("double")
        def decision(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy() for c in columns])
            return pd.Series((_cosines(x, seed, features) @ w).astype(float) - rho)

        return df.withColumn(name, decision(*self._scaled()))

    def detect(self, df: DataFrame) -> DataFrame:
        """Adds boundary_decision (negative outside) and boundary_anomaly."""
        return self.decide(df).withColumn("boundary_anomaly", (F.col("boundary_decision") < 0).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        line = [(self.cols, self.centre, self.scale, self.features, self.seed, self.nu,
                 self.weights, self.offset)]
        spark.createDataFrame(
            line, "cols array<string>, centre array<double>, scale array<double>, features int, seed int, "
                  "nu double, weights array<double>, offset double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> OneClassBoundary:
        r = spark.read.parquet(path).first()
        return cls(list(r["cols"]), list(r["centre"]), list(r["scale"]), r["features"], r["seed"],
                   r["nu"], list(r["weights"]), r["offset"])


def fit_one_class_boundary(df: DataFrame, cols: Sequence[str] = ("temperature", "vibration"),
                           nu: float = 0.05, seed: int = 42, features: int = 256,
                           steps: int = 10) -> OneClassBoundary:
    """A fixed number of passes; a missing value (null, NaN) counts as its column's mean. Starts from the mean feature vector; step t moves by 1 / (t + 1) towards
    the sum over rows inside the margin, whose edge follows the nu quantile; the final edge is the nu
    quantile of the final values."""
    cols = list(cols)
    rows, centre, scale = standard_scale(df, cols)
    if rows == 0:
        raise ValueError("no rows to fit on")
    model = OneClassBoundary(cols, centre, scale, features, seed, nu, [0.0] * features)
    inputs = cut(spread(df.select(*model._scaled()), rows))  # read once per step
    total, _, _ = model._pass(inputs, everyone=True)
    w = total / rows
    model.weights = w.tolist()
    _, _, model.offset = model._pass(inputs)
    for step in range(1, steps + 1):
        total, _, rho = model._pass(inputs)
        pace = 1.0 / (step + 1)
        w = (1.0 - pace) * w + pace * total / (nu * rows)
        model.weights, model.offset = w.tolist(), rho
    model.offset = 0.0
    values = cut(model.decide(spread(df.select(*cols), rows)).select("boundary_decision"))
    model.offset = exact_quantiles(values, "boundary_decision", [nu])[0]
    return model


def one_class_boundary(df: DataFrame, cols: Sequence[str] = ("temperature", "vibration"),
                       **options) -> DataFrame:
    """J13. Fits on df and flags its rows."""
    return fit_one_class_boundary(df, cols, **options).detect(df)
