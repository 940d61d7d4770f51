"""Sequences of a device's last n readings: their moments, their components, and a network that rebuilds them (J14).

A sequence is never an array here: it is a row with lag columns `_l<a>_<i>` (the i-th value a rows before), which one
window gives. For the covariance of all sequences the products of lag columns are not needed either. With G(a, b) the sum
of x[t-a] x[t-b] over the last rows t of all full sequences, G(a+1, b+1) is G(a, b) less the products of each device's
last sequence and plus those of its first; so one pass adds up G(a, 0) and keeps two sequences per device.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.functions.expressions import known, safe_ratio
from kelvibra.plans.lineage import cut
from kelvibra.plans.slices import KEYS, MAX_ROWS, ORDER, windowed

VALUES = ("temperature", "vibration")


@dataclass
class Scale:
    """Least and greatest value of each column; the scaled value runs from 0 to 1, a missing one counts as the least."""
    cols: list[str]
    low: list[float]
    high: list[float]

    def columns(self) -> list[Column]:
        return [F.coalesce(safe_ratio(known(F.col(c).cast("double")) - F.lit(a), F.lit(b - a)), F.lit(0.0))
                for c, a, b in zip(self.cols, self.low, self.high)]

    @property
    def width(self) -> int:
        return len(self.cols)


def fit_scale(df: DataFrame, cols: Sequence[str] = VALUES, share: float = 1.0) -> tuple[Scale, object]:
    """The scale of all rows, and the time until which `share` of them were taken; one aggregate."""
    parts = [f(known(F.col(c).cast("double"))) for c in cols for f in (F.min, F.max)]
    found = df.agg(*[p.alias(f"_{i}") for i, p in enumerate(parts)],
                   F.percentile_approx("timestamp", share, 10_000).alias("_until")).first()
    ends = [0.0 if found[f"_{i}"] is None else found[f"_{i}"] for i in range(2 * len(cols))]
    return Scale(list(cols), ends[::2], ends[1::2]), found["_until"]


def lag_name(a: int, i: int) -> str:
    return f"_l{a}_{i}"


def with_lags(df: DataFrame, scale: Scale, n: int, keys: Sequence[str] = KEYS, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows with the lag columns of the scaled values and `is_full`, true where n readings end."""
    rows = df.withColumns({lag_name(0, i): c for i, c in enumerate(scale.columns())})

    def build(data: DataFrame, w) -> DataFrame:
        lags = {lag_name(a, i): F.lag(lag_name(0, i), a).over(w) for a in range(1, n) for i in range(scale.width)}
        return data.withColumns(lags | {"is_full": F.lag(F.lit(True), n - 1).over(w).isNotNull()})
    return windowed(rows, build, n - 1, keys=keys, max_rows=max_rows)


def in_order(n: int, width: int) -> list[str]:
    """The lag columns, the oldest reading first."""
    return [lag_name(a, i) for a in range(n - 1, -1, -1) for i in range(width)]


@dataclass
class Moments:
    """Of all full sequences, oldest reading first: number, sums, and sums of products."""
    count: int
    sums: np.ndarray
    products: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.sums / self.count

    @property
    def covariance(self) -> np.ndarray:
        return (self.products - np.outer(self.sums, self.mean)) / (self.count - 1)


def moments(lagged: DataFrame, n: int, width: int, keys: Sequence[str] = KEYS) -> Moments:
    """Moments of the full sequences of a table with lag columns, in one pass."""
    order = F.struct(*[c for c in ORDER if c in lagged.columns])
    ends = F.array(*in_order(n, width))
    sums = [F.sum(lag_name(0, i)) for i in range(width)]
    products = [F.sum(F.col(lag_name(a, i)) * F.col(lag_name(0, j))) for a in range(n) for i in range(width) for j in range(width)]
    devices = lagged.filter("is_full").groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("count"), F.array(*sums).alias("sums"), F.array(*products).alias("products"),
        F.min_by(ends, order).alias("first"), F.max_by(ends, order).alias("last"))
    size = n * width

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + width + n * width * width + 2 * size + 2 * size * size)
        for batch in batches:
            if not batch.num_rows:
                continue
            sums, products, first, last = (batch[c].flatten().to_numpy().reshape(batch.num_rows, -1)
                                           for c in ("sums", "products", "first", "last"))
            total += np.concatenate([[batch["count"].to_numpy().sum()], *[t.sum(axis=0) for t in (sums, products, first, last)],
                                     (first.T @ first).ravel(), (last.T @ last).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["slot", "total"])
    rows = devices.mapInArrow(added, "slot long, total double").groupBy("slot").agg(F.sum("total").alias("total")) \
        .orderBy("slot").collect()  # a fixed number of lines
    flat = np.array([r["total"] for r in rows])
    if not len(flat) or flat[0] == 0:
        return Moments(0, np.zeros(size), np.zeros((size, size)))
    cuts = np.cumsum([1, width, n * width * width, size, size, size * size])
    count, sums0, products0, first, last, firsts, lasts = np.split(flat, cuts)
    # by lag instead of by age
    turn = np.arange(size).reshape(n, width)[::-1].ravel()
    first, last = first[turn].reshape(n, width), last[turn].reshape(n, width)
    firsts, lasts = (m.reshape(size, size)[np.ix_(turn, turn)].reshape(n, width, n, width) for m in (firsts, lasts))
    sums_by_lag = np.zeros((n, width))
    sums_by_lag[0] = sums0
    for a in range(n - 1):
        sums_by_lag[a + 1] = sums_by_lag[a] - last[a] + first[a + 1]
    found = np.zeros((n, width, n, width))
    found[:, :, 0, :] = products0.reshape(n, width, width)
    found[0] = found[:, :, 0, :].transpose(2, 0, 1)
    for a in range(n - 1):
        for b in range(n - 1):
            found[a + 1, :, b + 1, :] = found[a, :, b, :] - lasts[a, :, b, :] + firsts[a + 1, :, b + 1, :]
    return Moments(int(count[0]), sums_by_lag.ravel()[turn], found.reshape(size, size)[np.ix_(turn, turn)])


def components(found: Moments, k: int) -> np.ndarray:
    """The k leading components, as rows; the greatest entry of each is positive."""
    _, vectors = np.linalg.eigh(found.covariance)
    leading = vectors[:, ::-1][:, :k].T
    return leading * np.sign(leading[np.arange(len(leading)), np.abs(leading).argmax(axis=1)])[:, None]


@dataclass
class SequenceComponents:
    """Rebuilds sequences from their leading components."""
    scale: Scale
    n: int
    mean: list[float]
    parts: list[list[float]]

    def error(self) -> Column:
        """Mean squared loss per value: the squared length of the centred row less that of its projection."""
        names = in_order(self.n, self.scale.width)
        centred = [F.col(c) - F.lit(float(m)) for c, m in zip(names, self.mean)]
        squares = reduce(add, (c * c for c in centred))
        for part in self.parts:
            along = reduce(add, (c * F.lit(float(w)) for c, w in zip(centred, part)))
            squares = squares - along * along
        return F.greatest(F.lit(0.0), squares) / F.lit(float(len(names)))

    def score(self, lagged: DataFrame) -> DataFrame:
        return lagged.withColumn("sequence_error", F.when(F.col("is_full"), self.error()))

    def detect(self, df: DataFrame) -> DataFrame:
        return self.score(with_lags(df, self.scale, self.n)).select(*df.columns, "sequence_error")

    def save(self, spark: SparkSession, path: str) -> None:
        line = [(self.scale.cols, self.scale.low, self.scale.high, self.n, self.mean, self.parts)]
        spark.createDataFrame(line, "cols array<string>, low array<double>, high array<double>, n int, mean array<double>, "
                                    "parts array<array<double>>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SequenceComponents:
        r = spark.read.parquet(path).first()
        return cls(Scale(list(r["cols"]), list(r["low"]), list(r["high"])), r["n"], list(r["mean"]), [list(p) for p in r["parts"]])


def fit_components(lagged: DataFrame, scale: Scale, n: int, k: int) -> SequenceComponents:
    found = moments(lagged, n, scale.width)
    if found.count < 2:
        return SequenceComponents(scale, n, [0.0] * (n * scale.width), [])
    return SequenceComponents(scale, n, found.mean.tolist(), components(found, k).tolist())


KERNEL = 3
CHANNELS = 8
HIDDEN = 32
CHUNK = 1 << 15  # sequences that are worked on at once


def shapes(n: int, width: int, k: int) -> dict[str, tuple[int, ...]]:
    size, steps = n * width, n - KERNEL + 1
    return {"conv": (KERNEL * width, CHANNELS), "conv_bias": (CHANNELS,), "straight": (size, k), "curved": (steps * CHANNELS, k),
            "code_bias": (k,), "hidden": (k, HIDDEN), "hidden_bias": (HIDDEN,), "back": (k, size), "bent": (HIDDEN, size),
            "bias": (size,)}


def unpacked(flat: np.ndarray, n: int, width: int, k: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(n, width, k).items():
        out[name] = flat[at:at + int(np.prod(shape))].reshape(shape)
        at += int(np.prod(shape))
    return out


def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def forward(x: np.ndarray, w: dict[str, np.ndarray], n: int, width: int) -> tuple[np.ndarray, ...]:
    """Centred sequences through the network: windows in time, a code of k numbers, and back, straight and bent."""
    rows = x.reshape(len(x), n, width)
    windows = np.stack([rows[:, i:i + KERNEL].reshape(len(x), -1) for i in range(n - KERNEL + 1)], axis=1)
    seen = np.tanh(windows @ w["conv"] + w["conv_bias"])
    code = x @ w["straight"] + seen.reshape(len(x), -1) @ w["curved"] + w["code_bias"]
    hidden = np.tanh(code @ w["hidden"] + w["hidden_bias"])
    return windows, seen, code, hidden, code @ w["back"] + hidden @ w["bent"] + w["bias"]


def gradient(x: np.ndarray, w: dict[str, np.ndarray], n: int, width: int) -> tuple[np.ndarray, float]:
    """Of the summed loss over the rows of x, by back-propagation, and that loss."""
    windows, seen, code, hidden, out = forward(x, w, n, width)
    size = n * width
    away = out - x
    d_out = 2.0 * away / size
    d_hidden = (d_out @ w["bent"].T) * (1.0 - hidden * hidden)
    d_code = d_out @ w["back"].T + d_hidden @ w["hidden"].T
    d_seen = (d_code @ w["curved"].T).reshape(seen.shape) * (1.0 - seen * seen)
    found = {"conv": np.tensordot(windows, d_seen, ([0, 1], [0, 1])), "conv_bias": d_seen.sum((0, 1)), "straight": x.T @ d_code,
             "curved": seen.reshape(len(x), -1).T @ d_code, "code_bias": d_code.sum(0), "hidden": code.T @ d_hidden,
             "hidden_bias": d_hidden.sum(0), "back": code.T @ d_out, "bent": hidden.T @ d_out, "bias": d_out.sum(0)}
    return packed(found), float((away * away).sum() / size)


@dataclass
class SequenceNetwork:
    """A convolution over time, a narrow code and a bent way back; starts as the components."""
    scale: Scale
    n: int
    k: int
    mean: list[float]
    weights: list[float]

    def score(self, lagged: DataFrame) -> DataFrame:
        n, width, k, mean = self.n, self.scale.width, self.k, np.array(self.mean)
        flat = np.array(self.weights)

        @F.pandas_udf("double")
        def error(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(float) for c in columns]) - mean
            return pd.Series(((forward(x, unpacked(flat, n, width, k), n, width)[-1] - x) ** 2).mean(axis=1))
        filled = [F.coalesce(F.col(c), F.lit(0.0)) for c in in_order(n, width)]
        return lagged.withColumn("_e", error(*filled)).withColumn("sequence_error", F.when(F.col("is_full"), F.col("_e"))).drop("_e")

    def detect(self, df: DataFrame) -> DataFrame:
        return self.score(with_lags(df, self.scale, self.n)).select(*df.columns, "sequence_error")

    def save(self, spark: SparkSession, path: str) -> None:
        line = [(self.scale.cols, self.scale.low, self.scale.high, self.n, self.k, self.mean, self.weights)]
        spark.createDataFrame(line, "cols array<string>, low array<double>, high array<double>, n int, k int, mean array<double>, "
                                    "weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SequenceNetwork:
        r = spark.read.parquet(path).first()
        return cls(Scale(list(r["cols"]), list(r["low"]), list(r["high"])), r["n"], r["k"], list(r["mean"]), list(r["weights"]))


def _start(found: Moments, n: int, width: int, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = components(found, k)
    k = len(parts)
    start = {name: np.zeros(shape) for name, shape in shapes(n, width, k).items()}
    start["conv"] = rng.normal(0, 1.0 / np.sqrt(KERNEL * width), start["conv"].shape)
    start["curved"] = rng.normal(0, 0.1 / np.sqrt(start["curved"].shape[0]), start["curved"].shape)
    start["hidden"] = rng.normal(0, 1.0 / np.sqrt(k), start["hidden"].shape) * 2.0
    start["straight"], start["back"] = parts.T, parts
    return packed(start)


def fit_network(lagged: DataFrame, scale: Scale, n: int, k: int = 2, passes: int = 60, rate: float = 0.01,
                seed: int = 42) -> SequenceNetwork:
    """Adam on the driver, one step a pass. Every partition adds up the gradient of its sequences, Spark the partitions',
    and only the sums, a fixed number of lines, reach the driver; the step of lowest loss is kept. Starts at the
    components, so that the loss is never above theirs. Without full sequences all weights are 0."""
    width = scale.width
    if n < KERNEL:
        raise ValueError(f"sequences need at least {KERNEL} rows")
    names = in_order(n, width)
    rows = cut(lagged.filter("is_full").select(*[F.col(c).cast("float") for c in names]))  # read once a pass
    found = moments(lagged, n, width)
    size = sum(int(np.prod(s)) for s in shapes(n, width, k).values())
    if found.count < 2:
        return SequenceNetwork(scale, n, k, [0.0] * (n * width), [0.0] * size)
    mean, weights = found.mean, _start(found, n, width, k, seed)
    best, least = weights, np.inf
    first, second = np.zeros(size), np.zeros(size)
    for step in range(1, passes + 2):
        total = _pass(rows, weights, mean, n, width, k)
        slope, loss = total[:size] / total[-1], total[-2] / total[-1]
        if loss < least:
            best, least = weights, loss
        if step > passes:
            break
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        pace = rate * 0.5 * (1.0 + np.cos(np.pi * (step - 1) / passes))
        weights = weights - pace * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return SequenceNetwork(scale, n, k, mean.tolist(), best.tolist())


def _pass(rows: DataFrame, weights: np.ndarray, mean: np.ndarray, n: int, width: int, k: int) -> np.ndarray:
    """The summed gradient, loss and number of the sequences."""
    size = len(weights) + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, w = np.zeros(size), unpacked(weights, n, width, k)
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) - mean
            for at in range(0, len(x), CHUNK):
                slope, loss = gradient(x[at:at + CHUNK], w, n, width)
                total[:-2] += slope
                total[-2] += loss
            total[-1] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], ["slot", "total"])
    lines = rows.mapInArrow(partial, "slot long, total double").groupBy("slot").agg(F.sum("total").alias("total")) \
        .orderBy("slot").collect()
    return np.array([r["total"] for r in lines])
