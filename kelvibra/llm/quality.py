"""A quality classifier: a convolutional network over the bytes of a text, in numpy.

Every byte becomes an embedding and one channel telling whether its word repeats the word before it. Learned
filters see chunks of 16 bytes, every chunk overlapping the next by half, from the first byte to the last;
each filter's strongest answer anywhere in the text is kept (max-pooling), and a hidden layer combines the
answers into one probability.

The network is fitted in one task on a sample of labelled rows whose size is bounded by parameters; it is
applied to whole texts. Defined results: a null or empty text is scored as one chunk of padding; null labels
are not learned from; a document labelled several times counts once per label; without labelled rows of both
classes every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvibra.llm import words as W

STRIDE, DEPTH, FILTERS, HIDDEN = 8, 8, 24, 12
PAD = 256
PER_CLASS = 2_000
SAMPLE_BYTES = 32 << 20
SEED = 7


class Network:
    """Weights by name. `shift` moves the answer from the sample's share of the classes to their true one."""

    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        normal = lambda scale, *shape: (r.standard_normal(shape) * scale).astype(np.float32)
        self.w = {
            "embed": normal(0.5, PAD + 1, DEPTH),
            "early": normal(0.1, STRIDE * DEPTH, FILTERS), "late": normal(0.1, STRIDE * DEPTH, FILTERS),
            "early_rep": normal(0.1, STRIDE, FILTERS), "late_rep": normal(0.1, STRIDE, FILTERS),
            "bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(0.3, FILTERS, HIDDEN), "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(0.3, HIDDEN), "out_bias": np.zeros(1, np.float32)}
        self.shift = 0.0
        self.fixed: float | None = None

    def answers(self, codes: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Each filter's answer to every chunk; chunk i joins strides i and i + 1."""
        x = self.w["embed"][codes].reshape(-1, STRIDE * DEPTH)
        r = repeats.reshape(-1, STRIDE)
        z = x[:-1] @ self.w["early"]
        z += x[1:] @ self.w["late"]
        if r.any():
            z += r[:-1] @ self.w["early_rep"] + r[1:] @ self.w["late_rep"]
        return z

    def combine(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        active = np.maximum(pooled + self.w["bias"], 0)
        hidden = np.tanh(active @ self.w["hidden"] + self.w["hidden_bias"])
        return active, hidden, hidden @ self.w["out"] + self.w["out_bias"][0]

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(pooled), self.fixed)
        logit = self.combine(pooled)[2].astype(np.float64) + self.shift
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def strides(block: W.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes and repeat flags laid out in strides, two at least for every row, and the strides at
    which rows are cut."""
    found = W.words(block)
    again = np.zeros(len(found.hashes), bool)
    again[1:] = found.hashes[1:] == found.hashes[:-1]
    again[found.bounds[:-1][found.bounds[:-1] < len(again)]] = False
    flags = np.zeros(len(block.data) + 1, np.int32)
    np.add.at(flags, found.starts[again], 1)
    np.add.at(flags, found.ends[again], -1)
    lengths = np.diff(block.bounds)
    counts = np.maximum(2, -(-lengths // STRIDE))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(len(block.data)) + np.repeat(cuts[:-1] * STRIDE - block.bounds[:-1], lengths)
    codes = np.full(cuts[-1] * STRIDE, PAD, np.int16)
    codes[at] = block.data
    repeats = np.zeros(cuts[-1] * STRIDE, np.float32)
    repeats[at] = np.cumsum(flags[:-1])
    return codes, repeats, cuts


def pooled(network: Network, block: W.Block) -> np.ndarray:
    """The strongest answer of each filter per row. A long text is worked through in pieces that share a
    stride, so that no chunk is missed."""
    codes, repeats, cuts = strides(block)
    step = W.BLOCK // STRIDE
    if block.rows == 1 and cuts[-1] > step:
        best = np.full((1, FILTERS), -np.inf, np.float32)
        for at in range(0, cuts[-1] - 1, step):
            part = slice(at * STRIDE, (at + step + 1) * STRIDE)
            best = np.maximum(best, network.answers(codes[part], repeats[part]).max(axis=0))
        return best
    z = np.concatenate([network.answers(codes, repeats), np.full((1, FILTERS), -np.inf, np.float32)])
    return np.maximum.reduceat(z, np.stack([cuts[:-1], cuts[1:] - 1], axis=1).ravel(), axis=0)[::2]


def _gradients(net: Network, block: W.Block, labels: np.ndarray) -> dict[str, np.ndarray]:
    codes, repeats, cuts = strides(block)
    z = net.answers(codes, repeats)
    top = np.stack([z[a:b - 1].argmax(axis=0) + a for a, b in zip(cuts[:-1], cuts[1:])])
    active, hidden, logit = net.combine(np.take_along_axis(z, top, axis=0))
    d = ((1 / (1 + np.exp(-logit)) - labels) / len(labels)).astype(np.float32)
    g = {"out": hidden.T @ d, "out_bias": d.sum(keepdims=True)}
    d_hidden = np.outer(d, net.w["out"]) * (1 - hidden ** 2)
    g |= {"hidden": active.T @ d_hidden, "hidden_bias": d_hidden.sum(axis=0)}
    d_active = (d_hidden @ net.w["hidden"].T) * (active > 0)
    g["bias"] = d_active.sum(axis=0)
    by_stride, flags = codes.reshape(-1, STRIDE), repeats.reshape(-1, STRIDE)
    g["embed"] = np.zeros_like(net.w["embed"])
    for side, shift in (("early", 0), ("late", 1)):
        own = by_stride[top + shift]  # row, filter, byte
        g[side] = np.einsum("rf,rfv->vf", d_active, net.w["embed"][own].reshape(*top.shape, -1))
        g[f"{side}_rep"] = np.einsum("rf,rfv->vf", d_active, flags[top + shift])
        back = net.w[side].T.reshape(1, FILTERS, STRIDE, DEPTH) * d_active[:, :, None, None]
        np.add.at(g["embed"], own.ravel(), back.reshape(-1, DEPTH))
    return g


def train(texts: list[bytes], labels: list[int], shares: tuple[int, int], epochs: int = 8, rows: int = 32,
          least_steps: int = 600, rate: float = 0.004, seed: int = SEED) -> Network:
    """Adam on the cross-entropy of shuffled batches, for `epochs` or at least `least_steps` batches; the same
    rows give the same network. `shares` counts all labelled rows of class 0 and 1."""
    net, y = Network(seed), np.asarray(labels, np.float32)
    ones = int(y.sum())
    if min(ones, len(y) - ones) == 0:
        net.fixed = shares[1] / sum(shares) if sum(shares) else 0.5
        return net
    r = np.random.default_rng(seed + 1)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    per_epoch = -(-len(y) // rows)
    epochs = max(epochs, -(-least_steps // per_epoch))
    step, steps = 0, epochs * per_epoch
    for _ in range(epochs):
        order = r.permutation(len(y))
        for at in range(0, len(order), rows):
            own = order[at:at + rows]
            parts = list(W.blocks(pa.array([texts[i] for i in own], pa.binary()), 1 << 40))
            g, step = _gradients(net, parts[0], y[own]), step + 1
            pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, v in g.items():
                first[k] += 0.1 * (v - first[k])
                second[k] += 0.001 * (v * v - second[k])
                net.w[k] -= pace * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    net.shift = float(np.log(shares[1] / shares[0]) - np.log(ones / (len(y) - ones)))
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, sample_bytes: int = SAMPLE_BYTES,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> bytes:
    """A network, pickled. Of each class the `per_class` labelled rows with the smallest hash of their id are
    the sample; only their texts are fetched, whole, to one task, which leaves out a text that would take the
    sample past `sample_bytes`."""
    spark = docs.sparkSession
    rows = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")) \
        .filter("_id IS NOT NULL AND _label IN (0, 1)")
    shares = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    ranked = rows.withColumn("_rank", F.xxhash64(F.col("_id").cast("string"), F.lit(SEED)))
    sample = [ranked.filter(F.col("_label") == c).orderBy("_rank", "_id").limit(per_class) for c in (0, 1)]
    few = spark.createDataFrame(sample[0].unionByName(sample[1]).collect(), ranked.schema)
    texts = (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
             .join(F.broadcast(few), "_id").select("_rank", "_label", "_text"))
    counts = (shares.get(0, 0), shares.get(1, 0))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, sample_texts, sample_labels = sample_bytes, [], []
        for batch in batches:
            for text, label in zip(batch["_text"].cast(pa.large_binary()).to_pylist(), batch["_label"].to_pylist()):
                if len(text) <= left:
                    left -= len(text)
                    sample_texts.append(text)
                    sample_labels.append(label)
        net = train(sample_texts, sample_labels, counts)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net.__dict__)], pa.binary())], ["network"])

    fitted = texts.repartition(1).sortWithinPartitions("_rank", "_label", "_text").mapInArrow(learn, "network binary")
    found = fitted.first()  # none if there is no labelled row
    return found["network"] if found else pickle.dumps(train([], [], counts).__dict__)


def load(saved: bytes) -> Network:
    net = Network()
    net.__dict__.update(pickle.loads(saved))
    return net


def score(saved: bytes, text: str = "text") -> F.Column:
    """The probability of label 1 as a column over whole texts; never null."""
    @F.arrow_udf("double")
    def apply(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = load(saved)
        for column in columns:
            out = [net.scores(pooled(net, b)) for b in W.blocks(column)]
            yield pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())
    return apply(F.col(text))
