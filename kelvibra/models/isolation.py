"""J12. Isolation forest after Liu, Ting and Zhou (2008).

Every tree is grown from a sample of fixed size, so growing is bounded whatever the table's size; the
node table has at most trees * 2 * sample lines and is broadcast for scoring, which is one pass.
Samples are chosen by hashes of the rows and do not depend on partitioning or on the table's size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known
from kelvibra.functions.quantiles import exact_quantiles
from kelvibra.plans.lineage import cut, spread

NODES = "tree int, node int, feature int, split double, child int, depth double"
HASH_SPACE = 1 << 62


def mean_path(size) -> np.ndarray:
    """Mean depth of an unsuccessful search among `size` keys."""
    size = np.asarray(size, dtype=float)
    many = np.maximum(size, 2.0)
    value = 2.0 * (np.log(many - 1.0) + np.euler_gamma) - 2.0 * (many - 1.0) / many
    return np.where(size > 2, value, np.where(size == 2, 1.0, 0.0))


def _grow(tree: int, x: np.ndarray, limit: int, seed: int) -> list[tuple]:
    """Random splits until rows are alone, equal, or `limit` deep. A row goes to node `child` up to the
    split value and to the next node above it; a leaf is its own child and has no value above it."""
    rng = np.random.default_rng([seed, tree])
    nodes: list = [None]
    todo = [(np.arange(len(x)), 0, 0)]
    while todo:
        rows, level, number = todo.pop()
        part = x[rows]
        spread_out = np.flatnonzero(part.max(axis=0) > part.min(axis=0))
        if level >= limit or len(spread_out) == 0:
            nodes[number] = (tree, number, 0, np.inf, number, level + float(mean_path(len(rows))))
            continue
        feature = int(rng.choice(spread_out))
        values = part[:, feature]
        split = float(rng.uniform(values.min(), values.max()))
        child = len(nodes)
        nodes[number] = (tree, number, feature, split, child, 0.0)
        nodes += [None, None]
        todo.append((rows[values > split], level + 1, child + 1))
        todo.append((rows[values <= split], level + 1, child))
    return nodes


@dataclass
class IsolationForest:
    cols: list[str]
    centre: list[float]
    scale: list[float]
    nodes: pd.DataFrame
    trees: int
    sample: int
    threshold: float | None = None

    def _scaled(self):
        return [F.coalesce((known(F.col(c).cast("double")) - F.lit(m)) / F.lit(s), F.lit(0.0))
                for c, m, s in zip(self.cols, self.centre, self.scale)]

    def score(self, df: DataFrame, name: str = "isolation_score") -> DataFrame:
        """Adds the score, 0 to 1; higher is more isolated."""
        width = int(self.nodes["node"].max()) + 1
        tables = {}
        for c in ("feature", "split", "child", "depth"):
            tables[c] = np.zeros((self.trees, width), dtype=float if c in ("split", "depth") else np.intp)
            tables[c][self.nodes["tree"], self.nodes["node"]] = self.nodes[c]
        shared = df.sparkSession.sparkContext.broadcast(tables)
        usual, steps = float(mean_path(self.sample)), math.ceil(math.log2(max(2, self.sample)))

        @F.pandas_udf("double")
        def isolation(*columns: pd.Series) -> pd.Series:
            t, rows = shared.value, len(columns[0])
            values = np.concatenate([c.to_numpy() for c in columns])
            every, depth = np.arange(rows), np.zeros(rows)
            for feature, split, child, ends in zip(t["feature"], t["split"], t["child"], t["depth"]):
                at = np.zeros(rows, dtype=np.intp)
                for _ in range(steps):
                    value = values.take(feature.take(at) * rows + every)
                    at = child.take(at) + (value > split.take(at))
                depth += ends.take(at)
            return pd.Series(np.exp2(-depth / len(t["depth"]) / usual))

        return df.withColumn(name, isolation(*self._scaled()))

    def detect(self, df: DataFrame) -> DataFrame:
        """Adds isolation_score, isolation_decision (negative for anomalies) and isolation_anomaly."""
        scored = self.score(df)
        return scored.withColumns({
            "isolation_decision": F.lit(self.threshold) - F.col("isolation_score"),
            "isolation_anomaly": (F.col("isolation_score") > F.lit(self.threshold)).cast("int")})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(self.cols, self.centre, self.scale, self.trees, self.sample, self.threshold)]
        spark.createDataFrame(
            head, "cols array<string>, centre array<double>, scale array<double>, trees int, sample int, "
                  "threshold double").coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        head = spark.read.parquet(f"{path}/head").first()
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()  # trees * 2 * sample lines at most
        return cls(list(head["cols"]), list(head["centre"]), list(head["scale"]), nodes,
                   head["trees"], head["sample"], head["threshold"])


def standard_scale(df: DataFrame, cols: Sequence[str]) -> tuple[int, list[float], list[float]]:
    """Rows, means and population deviations (1 for a constant column) from one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.array(*[F.coalesce(F.avg(known(c)), F.lit(0.0)) for c in cols]).alias("m"),
                 F.array(*[F.coalesce(F.stddev_pop(known(c)), F.lit(0.0)) for c in cols]).alias("s")).first()
    return row["n"], list(row["m"]), [s or 1.0 for s in row["s"]]


def fit_isolation_forest(df: DataFrame, cols: Sequence[str] = ("temperature", "vibration"),
                         key: str | Sequence[str] = "reading_id", trees: int = 100, sample: int = 256,
                         contamination: float = 0.05, seed: int = 42) -> IsolationForest:
    """Fits on standardized columns; a missing value (null, NaN) counts as the mean. Each tree is grown from
    the `sample` rows of least hash, which is taken of tree, key columns and values: rows alike in all of them
    are one draw. The threshold is the exact (1 - contamination) quantile of the fitted rows' scores, which
    are computed once and kept in a checkpoint."""
    cols, keys = list(cols), [key] if isinstance(key, str) else list(key)
    rows, centre, scale = standard_scale(df, cols)
    if rows == 0:
        raise ValueError("no rows to fit on")
    distinct = df.agg(F.approx_count_distinct(F.xxhash64(*keys, *cols))).first()[0]
    size = min(sample, distinct)
    forest = IsolationForest(cols, centre, scale, pd.DataFrame(), trees, size)
    values = [v.alias(f"x{i}") for i, v in enumerate(forest._scaled())]
    names = [f"x{i}" for i in range(len(cols))]

    # Hashes up to a bound are enough: four times the sample is expected below it, so that a tree finds
    # fewer rows than it needs only if the table has no more.
    bound = int(min(1.0, (4 * size + 100) / (0.8 * distinct)) * HASH_SPACE)
    ticket = F.pmod(F.xxhash64("tree", "k", F.lit(seed)), F.lit(HASH_SPACE))
    drawn = (df.select(F.xxhash64(*keys, *cols).alias("k"), *values)
             .withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
             .withColumn("ticket", ticket).filter(F.col("ticket") < F.lit(bound))
             .dropDuplicates(["tree", "ticket", "k"]))
    first = Window.partitionBy("tree").orderBy("ticket", "k")
    tasks = min(trees, df.sparkSession.sparkContext.defaultParallelism)  # few bytes, but work for all
    draws = (drawn.repartition(tasks, "tree")
             .withColumn("place", F.row_number().over(first)).filter(F.col("place") <= size))
    limit = math.ceil(math.log2(max(2, size)))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("place")
        lines = _grow(int(ordered["tree"].iloc[0]), ordered[names].to_numpy(), limit, seed)
        return pd.DataFrame(lines, columns=[c.split(" ")[0] for c in NODES.split(", ")])

    forest.nodes = draws.groupBy("tree").applyInPandas(grow, NODES).toPandas()
    scores = cut(forest.score(spread(df.select(*cols), rows)).select("isolation_score"))
    forest.threshold = exact_quantiles(scores, "isolation_score", [1.0 - contamination])[0]
    return forest


def isolation_forest(df: DataFrame, cols: Sequence[str] = ("temperature", "vibration"),
                     **options) -> DataFrame:
    """J12. Fits on df and flags its rows."""
    return fit_isolation_forest(df, cols, **options).detect(df)
