"""Benchmark decontamination: which documents hold benchmark items.

Items and texts are multisets of five-word shingles (an item of fewer words is one shingle as long as it).
For every item a document is covered by windows of the item's size at every position; a window's SimHash is
looked up in an index of the items' fingerprints, and what lies within the radius is verified by the exact
weighted Jaccard similarity of the two multisets.

The index cuts 64 bits into eight blocks: fingerprints at most `radius` apart differ in at most radius / 8
bits of some block, and for every value of a block the items that near are listed, so none within the radius
is missed. At a similarity of 0.75 the distance exceeds 24 bits with a probability of 4e-6.

A window that shares no shingle with any item has similarity 0 and is not fingerprinted. Items are taken in
blocks of bounded size, each against all documents. Defined results: null and empty texts and items match
nothing; a text shorter than an item is one window; of a document's windows for an item the most similar,
first one is reported; equal items are reported each; repeated documents are reported each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvibra.llm import words as W
from kelvibra.llm.stores import stored

WIDTH = 5
RADIUS = 24
SIMILAR = 0.75
ITEM_BYTES = 4 << 20
BLOCKS = 8
STARTS = 1 << 16  # windows that are fingerprinted at once


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """64 signs per row as one number."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64)[:, 0]


def signs(values: np.ndarray) -> np.ndarray:
    """Every shingle's 64 votes, +1 or -1."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


class Index:
    """A block of items: fingerprints by block value, and shingles with their weights."""

    def __init__(self, ids: list[int], texts: list[str | bytes], radius: int = RADIUS, similar: float = SIMILAR):
        self.radius, self.similar = radius, similar
        self.ids, self.widths, self.sizes, self.weights, codes = [], [], [], [], []
        for block in W.blocks(pa.array(texts, pa.string())):
            found = W.words(block)
            for r in range(block.rows):
                own = found.hashes[found.bounds[r]:found.bounds[r + 1]]
                if len(own):
                    width = min(WIDTH, len(own))
                    values = W.shingles(own, np.array([0, len(own)]), width)[0]
                    self.ids.append(ids[block.first + r])
                    self.widths.append(width)
                    self.sizes.append(len(values))
                    self.weights.append(np.unique(values, return_counts=True))
                    codes.append(fingerprints(signs(values).sum(axis=0, keepdims=True))[0])
        self.codes = np.array(codes, np.uint64)
        self.sizes, self.widths = np.array(self.sizes, np.int64), np.array(self.widths, np.int64)
        near = np.array([[(a ^ b).bit_count() <= radius // BLOCKS for b in range(256)] for a in range(256)])
        parts = self.codes.view(np.uint8).reshape(-1, BLOCKS) if len(codes) else np.zeros((0, BLOCKS), np.uint8)
        self.tables = np.stack([near[:, parts[:, k]] for k in range(BLOCKS)])  # block, value, item
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in sorted(set(self.widths.tolist())):
            own = np.flatnonzero(self.widths == width)
            values = np.concatenate([self.weights[i][0] for i in own])
            items = np.concatenate([np.full(len(self.weights[i][0]), i) for i in own])
            order = np.argsort(values, kind="stable")
            first = np.zeros(1 << 20, bool)
            first[(values >> W.U64(44)).astype(np.int64)] = True
            self.known[width] = first, np.unique(values), values[order], items[order]

    def candidates(self, code: np.ndarray) -> np.ndarray:
        """Window by item: whether the fingerprints are within the radius, by the blocks and then exactly."""
        parts = code.view(np.uint8).reshape(-1, BLOCKS)
        met = np.zeros((len(code), len(self.codes)), bool)
        for k in range(BLOCKS):
            met |= self.tables[k][parts[:, k]]
        w, i = np.nonzero(met)
        met[w, i] = np.bitwise_count(code[w] ^ self.codes[i]) <= self.radius
        return met

    def similarity(self, window: np.ndarray, item: int) -> float:
        values, weights = self.weights[item]
        at = np.minimum(np.searchsorted(values, window), len(values) - 1)
        held = np.bincount(at[values[at] == window], minlength=len(values))
        common = int(np.minimum(held, weights).sum())
        return common / (len(window) + int(weights.sum()) - common)

    def _windows(self, values: np.ndarray, hits: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
        """Starts and fingerprints of the windows of `size` shingles that hold a hit, piece by piece."""
        last = len(values) - size
        edge = np.zeros(last + 2, np.int64)
        np.add.at(edge, np.maximum(hits - size + 1, 0), 1)
        np.add.at(edge, np.minimum(hits, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge[:-1]))
        at = 0
        while at < len(starts):
            end = int(np.searchsorted(starts, starts[at] + STARTS))
            own = starts[at:end] - starts[at]
            votes = signs(values[starts[at]:starts[end - 1] + size])
            sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(votes, axis=0, dtype=np.int32)])
            yield starts[at:end], fingerprints(sums[own + size] - sums[own])
            at = end

    def matches(self, block: W.Block) -> Iterator[tuple[int, int, float, int]]:
        """Row, item, similarity and first word of the best window of every row and item that match."""
        found = W.words(block)
        for width, (first, exact, values_of, items_of) in self.known.items():
            values, cuts = W.shingles(found.hashes, found.bounds, width)
            hits = np.flatnonzero(first[(values >> W.U64(44)).astype(np.int64)])
            hits = hits[exact[np.minimum(np.searchsorted(exact, values[hits]), len(exact) - 1)] == values[hits]]
            rows = np.searchsorted(cuts, hits, "right") - 1
            for row in np.unique(rows):
                own, at = values[cuts[row]:cuts[row + 1]], hits[rows == row] - cuts[row]
                shared = np.unique(own[at])
                lo, hi = np.searchsorted(values_of, shared), np.searchsorted(values_of, shared, "right")
                near = np.unique(np.concatenate([items_of[a:b] for a, b in zip(lo, hi)]))
                best: dict[int, tuple[float, int]] = {}
                for size in np.unique(self.sizes[near]):
                    span = min(int(size), len(own))
                    for starts, code in self._windows(own, at, span):
                        met = self.candidates(code)
                        met &= ((self.sizes == size) & (self.widths == width))[None, :]
                        for w, item in zip(*np.nonzero(met)):
                            s = self.similarity(own[starts[w]:starts[w] + span], int(item))
                            if s >= self.similar and s > best.get(int(item), (0.0, 0))[0]:
                                best[int(item)] = s, int(starts[w])
                for item, (s, start) in sorted(best.items()):
                    yield int(row), item, s, start


def indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", item_bytes: int = ITEM_BYTES,
            radius: int = RADIUS, similar: float = SIMILAR) -> Iterator[Index]:
    """The items in blocks of at most `item_bytes` of text, or of one item."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).orderBy("i", "t").toLocalIterator():
        length = len((row["t"] or "").encode())
        if ids and size + length > item_bytes:
            yield Index(ids, texts, radius, similar)
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(row["t"])
        size += length
    if ids:
        yield Index(ids, texts, radius, similar)


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options: object) -> DataFrame:
    """`id`, `item`, `similarity` and `first_word` (from 0) of every item that a document holds; integer ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    kind = "id long, item long, similarity double, first_word long"
    out = docs.sparkSession.createDataFrame([], kind)
    for index in indexes(items, **options):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found = [(batch["id"][b.first + row].as_py(), index.ids[item], s, start)
                         for b in W.blocks(batch["text"]) for row, item, s, start in index.matches(b)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[k] for f in found], t) for k, t in enumerate(
                        (pa.int64(), pa.int64(), pa.float64(), pa.int64()))], ["id", "item", "similarity", "first_word"])
        out = out.unionByName(rows.mapInArrow(match, kind))
    return out


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", **options: object) -> DataFrame:
    """The documents that hold no item, all columns as they were."""
    for number, index in enumerate(indexes(items, **options)):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = (stored(docs) if number else docs).filter(~_holds(shared)(F.col(text_col)))
    return docs


def _holds(shared: Broadcast):
    @F.arrow_udf("boolean")
    def holds(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            met = np.zeros(len(column), bool)
            for b in W.blocks(column):
                met[[b.first + row for row, *_ in shared.value.matches(b)]] = True
            yield pa.array(met)
    return holds
