"""J13 with support vectors: the one-class SVM with an RBF kernel, trained as a cascade.

Rows become weighted points first: equal rows are one point, and if there are more than `points` of them values are rounded
to a grid that is made coarser until there are not, so that what follows has a bound (its error is the grid's, which the
model keeps). The dual, the least a K a / 2 with 0 <= a_i <= w_i / (nu sum w) and sum a = 1, is then solved as a cascade: the
points of each partition are solved on their own, and only those with a > 0 go on to the final problem. Its solution is
held against all points in one pass; points that violate the optimality conditions join, and it is solved again from where
it was, until none does. At least a share nu of the weight always stays: these are the vectors that the model keeps.

The solver moves weight between the pair of points that violates most, which is exact up to `tolerance`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known
from kelvibra.models.isolation import standard_scale
from kelvibra.plans.lineage import cut

POINTS = 20_000
GROUP = 2_000  # points of a first problem
TOLERANCE = 1e-5
ROUNDS = 30
JOINING = 500  # violating points that join in a round


def kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.exp(-gamma * np.maximum(squares, 0.0))


def solve(x: np.ndarray, most: np.ndarray, gamma: float, start: np.ndarray | None = None,
          tolerance: float = TOLERANCE, steps: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """The weights a with sum 1, each between 0 and `most`, and K a. Columns of K are made when they are needed."""
    n = len(x)
    a = _filled(most) if start is None else start.copy()
    held = np.flatnonzero(a)
    slope = np.zeros(n)
    for at in range(0, len(held), 500):
        part = held[at:at + 500]
        slope += kernel(x, x[part], gamma) @ a[part]
    columns: dict[int, np.ndarray] = {}

    def column(i: int) -> np.ndarray:
        if i not in columns:
            if len(columns) * n > 20_000_000:  # numbers that are held
                columns.clear()
            columns[i] = kernel(x, x[i:i + 1], gamma)[:, 0]
        return columns[i]
    for _ in range(steps):
        up = int(np.where(a < most, slope, np.inf).argmin())  # gains by more weight
        down = int(np.where(a > 0, slope, -np.inf).argmax())  # gains by less
        if slope[down] - slope[up] <= tolerance:
            break
        ku, kd = column(up), column(down)
        move = min((slope[down] - slope[up]) / max(2.0 - 2.0 * ku[down], 1e-12), most[up] - a[up], a[down])
        a[up] += move
        a[down] = 0.0 if move == a[down] else a[down] - move
        if most[up] - a[up] < 1e-15:
            a[up] = most[up]
        slope += move * (ku - kd)
    return a, slope


def _filled(most: np.ndarray) -> np.ndarray:
    """Points at their most, one after another, until the weights sum to 1."""
    total = np.cumsum(most)
    return np.clip(1.0 - (total - most), 0.0, most)


@dataclass
class SupportVectors:
    """The vectors of a one-class SVM on standardized columns; a missing value counts as its column's mean."""
    cols: list[str]
    centre: list[float]
    scale: list[float]
    gamma: float
    nu: float
    vectors: list[list[float]]
    weights: list[float]
    offset: float
    grid: float = 0.0  # 0: rows as they are
    objective: float = 0.0
    rounds: int = field(default=0, compare=False)

    def scaled(self) -> list[Column]:
        return [F.coalesce((known(F.col(c).cast("double")) - F.lit(m)) / F.lit(s), F.lit(0.0)).alias(f"x{i}")
                for i, (c, m, s) in enumerate(zip(self.cols, self.centre, self.scale))]

    def decide(self, df: DataFrame, name: str = "boundary_decision") -> DataFrame:
        vectors, weights, gamma, offset = np.array(self.vectors), np.array(self.weights), self.gamma, self.offset

        @F.pandas_udf("double")
        def decision(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            out = [kernel(x[at:at + 1000], vectors, gamma) @ weights for at in range(0, len(x), 1000)]
            return pd.Series(np.concatenate(out) - offset if out else np.zeros(0))
        return df.withColumn(name, decision(*self.scaled()))

    def detect(self, df: DataFrame) -> DataFrame:
        """Adds boundary_decision (negative outside) and boundary_anomaly. Vectors lie on the boundary up to the solver's
        tolerance, so that only what is beyond that is flagged."""
        return self.decide(df).withColumn("boundary_anomaly", (F.col("boundary_decision") < -2 * TOLERANCE).cast("int"))

    def save(self, spark: SparkSession, path: str) -> None:
        line = [(self.cols, self.centre, self.scale, self.gamma, self.nu, self.vectors, self.weights, self.offset, self.grid, self.objective)]
        spark.createDataFrame(
            line, "cols array<string>, centre array<double>, scale array<double>, gamma double, nu double, vectors "
                  "array<array<double>>, weights array<double>, offset double, grid double, objective double") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SupportVectors:
        r = spark.read.parquet(path).first()
        return cls(list(r["cols"]), list(r["centre"]), list(r["scale"]), r["gamma"], r["nu"], [list(v) for v in r["vectors"]],
                   list(r["weights"]), r["offset"], r["grid"], r["objective"])


def weighted_points(inputs: DataFrame, points: int) -> tuple[DataFrame, int, float]:
    """Distinct rows with their number `w`, how many there are, and the grid they were rounded to."""
    names, grid = inputs.columns, 0.0
    while True:
        rows = inputs if not grid else inputs.select(*[(F.round(F.col(c) / grid) * grid).alias(c) for c in names])
        found = cut(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("w")))
        size = found.count()
        if size <= points:
            return found, size, grid
        grid = grid * 1.5 if grid else 1.0 / 512


def fit_support_vectors(df: DataFrame, cols: Sequence[str] = ("temperature", "vibration"), nu: float = 0.05,
                        points: int = POINTS, group: int = GROUP, tolerance: float = TOLERANCE) -> SupportVectors:
    """Gamma is 1 / columns, the usual choice on standardized columns."""
    cols = list(cols)
    rows, centre, scale = standard_scale(df, cols)
    if rows == 0:
        raise ValueError("no rows to fit on")
    gamma = 1.0 / len(cols)
    model = SupportVectors(cols, centre, scale, gamma, nu, [], [], 0.0)
    found, size, model.grid = weighted_points(df.select(*model.scaled()), points)
    names = [c for c in found.columns if c != "w"]
    groups = max(1, -(-size // group))
    dealt = found.withColumn("_g", F.pmod(F.xxhash64(*names), F.lit(groups)))  # by the row, not by its partition

    def first(part: pd.DataFrame) -> pd.DataFrame:
        x, w = part[names].to_numpy(float), part["w"].to_numpy(float)
        a, _ = solve(x, w / (nu * w.sum()), gamma, tolerance=tolerance)
        return part[a > 0][[*names, "w"]]
    kinds = ", ".join(f"{c} double" for c in names) + ", w long"
    active = dealt.groupBy("_g").applyInPandas(first, kinds).toPandas()  # at most `points` lines
    active = active.sort_values([*names]).reset_index(drop=True)
    start = None
    for model.rounds in range(1, ROUNDS + 1):
        x = active[names].to_numpy(float)
        most = active["w"].to_numpy(float) / (nu * rows)
        if most.sum() < 1.0:  # the vectors of the groups together always reach 1, up to rounding
            most = most / most.sum()
        a, slope = solve(x, most, gamma, start, tolerance)
        held = a > 0
        inside = held & (a < most)
        offset = float(slope[inside].mean()) if inside.any() else float((slope[held].max() + np.where(a < most, slope, np.inf).min()) / 2)
        model.vectors, model.weights, model.offset = x[held].tolist(), a[held].tolist(), offset
        model.objective = float(a @ slope / 2)
        violating = _violating(found, names, model, active, tolerance)
        if not len(violating):
            break
        active, start = pd.concat([active, violating], ignore_index=True), np.append(a, np.zeros(len(violating)))
    return model


def _violating(found: DataFrame, names: list[str], model: SupportVectors, active: pd.DataFrame, tolerance: float) -> pd.DataFrame:
    """Points without weight that lie outside the boundary: the JOINING farthest out that are not in the problem."""
    vectors, weights, gamma, offset = np.array(model.vectors), np.array(model.weights), model.gamma, model.offset

    def outside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[names].to_numpy(float)
            value = kernel(x, vectors, gamma) @ weights if len(x) else np.zeros(0)
            yield batch.assign(_v=value)[value < offset - tolerance]
    kinds = ", ".join(f"{c} double" for c in names) + ", w long, _v double"
    rows = found.mapInPandas(outside, kinds).orderBy("_v", *names).limit(JOINING + len(active)).toPandas()
    known_points = set(map(tuple, active[names].to_numpy(float).tolist()))
    new = [tuple(r) not in known_points for r in rows[names].to_numpy(float).tolist()]
    return rows[np.array(new, bool)].head(JOINING)[[*names, "w"]]


def support_vector_anomalies(df: DataFrame, cols: Sequence[str] = ("temperature", "vibration"), **options) -> DataFrame:
    """J13. Fits on df and flags its rows."""
    return fit_support_vectors(df, cols, **options).detect(df)
