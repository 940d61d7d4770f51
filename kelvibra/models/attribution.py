"""J6. Shapley values of a model's features by sampled coalitions, in one pass over the rows.

A feature's value for a row is the mean change of the score when the feature takes the row's value instead of a background
row's, over orders in which features join. For every row, `orders` random orders are drawn from its own key, each with its
background row, and each order backwards as well. Along an order scores are taken after every feature, so that one order's
changes add up to the row's score less the background's, whatever is sampled. The pass is a map over partitions: nothing is
shuffled, and what it holds is a batch of rows times an order. The background is a bounded sample, the rows of least hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BACKGROUND = 100  # rows
BATCH = 2_000


def logistic_score(model: PipelineModel, cols: Sequence[str]) -> Callable[[np.ndarray], np.ndarray]:
    """The probability of a fitted logistic curve on numeric columns, as a function of arrays. The last stage's inputs
    have to be these columns."""
    curve = model.stages[-1]
    inputs = model.stages[-2].getInputCols()
    if list(inputs) != list(cols):
        raise ValueError(f"the model's inputs are {inputs}")
    weights, offset = curve.coefficients.toArray(), curve.intercept
    return lambda x: 1.0 / (1.0 + np.exp(-(x @ weights + offset)))


def background_of(rows: DataFrame, cols: Sequence[str], size: int = BACKGROUND) -> np.ndarray:
    """The rows of least hash, at most `size`."""
    found = rows.dropna(subset=list(cols)).select(*cols, F.xxhash64(*cols).alias("_h")).orderBy("_h", *cols).limit(size).collect()
    return np.array([[float(r[c]) for c in cols] for r in found]).reshape(-1, len(cols))


def coalitions(seeds: np.ndarray, features: int, orders: int, background: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row (by its seed) and each order: the order of features, and the number of a background row. Every second
    order is the one before it backwards, with the same background row."""
    out, places = np.empty((len(seeds), orders, features), np.int64), np.empty((len(seeds), orders), np.int64)
    for i, seed in enumerate(seeds):
        rng = np.random.default_rng(int(seed) & 0xFFFFFFFFFFFFFFFF)
        for j in range(0, orders, 2):
            out[i, j] = rng.permutation(features)
            places[i, j] = rng.integers(background)
            if j + 1 < orders:
                out[i, j + 1], places[i, j + 1] = out[i, j, ::-1], places[i, j]
    return out, places


def shapley(x: np.ndarray, score: Callable[[np.ndarray], np.ndarray], background: np.ndarray, order: np.ndarray,
            place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attributions of each row's features, and the mean score of the background rows drawn for it."""
    rows, orders, features = order.shape
    given, base = np.zeros((rows, features)), np.zeros(rows)
    at = np.arange(rows)
    for j in range(orders):
        now = background[place[:, j]].copy()
        before = score(now)
        base += before
        for step in range(features):
            joins = order[:, j, step]
            now[at, joins] = x[at, joins]
            after = score(now)
            given[at, joins] += after - before
            before = after
    return given / orders, base / orders


def attributions(rows: DataFrame, cols: Sequence[str], score: Callable[[np.ndarray], np.ndarray], background: np.ndarray,
                 key: str = "reading_id", orders: int = 32, seed: int = 42) -> DataFrame:
    """key, base, prediction and one column `<feature>_attribution` each: they add up to prediction less base. Rows that
    lack a feature are left out."""
    if not len(background):
        raise ValueError("no background rows")
    cols, names = list(cols), [f"{c}_attribution" for c in cols]
    whole = rows.dropna(subset=cols).select(key, F.xxhash64(F.lit(seed), key).alias("_seed"), *[F.col(c).cast("double").alias(c) for c in cols])
    kind = whole.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, base double, prediction double, " + ", ".join(f"{n} double" for n in names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                x = np.column_stack([part[c].to_numpy(zero_copy_only=False) for c in cols])
                order, place = coalitions(part["_seed"].to_numpy(), len(cols), orders, len(background))
                given, base = shapley(x, score, background, order, place)
                yield pa.RecordBatch.from_arrays([part[key], pa.array(base), pa.array(score(x)), *map(pa.array, given.T.copy())],
                                                 [key, "base", "prediction", *names])
    return whole.mapInArrow(work, schema)


def global_attribution(given: DataFrame, cols: Sequence[str]) -> DataFrame:
    """feature and attribution: the mean size of each feature's attributions, the greatest first."""
    means = given.agg(*[F.avg(F.abs(f"{c}_attribution")).alias(c) for c in cols])
    return means.unpivot([], list(cols), "feature", "attribution").orderBy(F.desc("attribution"), "feature")
