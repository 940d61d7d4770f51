"""Near duplicates by SimHash fingerprints in a Gray-order hierarchical index.

A text's fingerprint has 64 bits, each the majority vote of the XXH64 values (seed 42) of all its four-word shingles.
Documents with equal fingerprints are one entry. Entries are linked if at most DISTANCE bits differ.

Two linked fingerprints agree on at least one of DISTANCE + 1 blocks of bits. So each is rotated to bring every block to
the front in turn, and the entries with the same block in front form a bucket. Within a bucket fingerprints are sorted by
Gray rank, so that neighbours differ in few bits; groups of FAN neighbours are nodes, groups of nodes are upper nodes. A
node is a masked pattern: the bits on which all its fingerprints agree. Two nodes whose patterns differ in more than
DISTANCE common bits are pruned with all below them. Patterns include those of the nodes above, so that differences
accumulate on the way down; each step only compares what is left. Two nodes whose fingerprints are all close enough, and
nodes that are connected already, are not opened either. The walk goes in portions of bounded size.

A bucket of more than `most` fingerprints is dealt over tasks by ranges of its Gray rank, and cut into chunks. Chunks are
joined within themselves first; then pairs of chunks, whose patterns are the index's top level, are compared unless
pruned or already of one component. A bucket gives at most one link for each member and each pair of chunks, so that a
group of copies of any size costs no list of its pairs.

Defined results: a text without words, or null, has the fingerprint zero and is linked like any other; a text of fewer
than four words has its whole sequence as its one shingle. Null ids have a component but are never its name, unless all
of its ids are null. Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvibra.llm import words as W
from kelvibra.llm.components import connected
from kelvibra.llm.stores import stored

WIDTH = 4
SEED = 42
DISTANCE = 4
BLOCKS = (13, 13, 13, 13, 12)
FAN = 8
MOST = 1 << 14
HELD = 1 << 17  # fingerprints of whole buckets that a task indexes at once
PAIRS = 1 << 14  # pairs of nodes that are opened at once
SEGMENT = 1 << 20  # bytes of a text that are cut into words at once

_WHITE = re.compile(rb"[\x20\x09-\x0D]")
U64 = np.uint64


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, segment after segment."""
    at = 0
    while at < len(text):
        end = at + SEGMENT
        cut = _WHITE.search(text, end) if end < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


def _votes(shingles: Iterator[bytes]) -> tuple[np.ndarray, int]:
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], U64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: bytes) -> int:
    """The majority of the bits of all shingles; 0 for a text without words."""
    ones, count, last = np.zeros(64, np.int64), 0, []
    for words in _word_lists(text):
        words = last + words
        if len(words) >= WIDTH:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            starts = [0, *ends]
            found, n = _votes(joined[a:b - 1] for a, b in zip(starts, ends[WIDTH - 1:]))
            ones, count = ones + found, count + n
        last = words[-(WIDTH - 1):]
    if not count and last:
        ones, count = _votes(iter([b" ".join(last)]))
    return int(np.packbits(ones * 2 > count, bitorder="little").view(U64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id` and `fp`, the fingerprint as a signed number."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch["text"]):
                raw, cuts = block.data.tobytes(), block.bounds.tolist()
                values = np.array([fingerprint(raw[a:b]) for a, b in zip(cuts, cuts[1:])], U64)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].slice(block.first, block.rows), pa.array(values.view(np.int64))], ["id", "fp"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(made, "id long, fp long")


def rank_of(values: np.ndarray) -> np.ndarray:
    """The place of a value in the order in which neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16, 32):
        values = values ^ (values >> U64(shift))
    return values


def value_of(ranks: np.ndarray) -> np.ndarray:
    return ranks ^ (ranks >> U64(1))


def rotated(values: np.ndarray, block: int) -> np.ndarray:
    """The values with a block of bits in front."""
    by = sum(BLOCKS[:block])
    return (values << U64(by)) | (values >> U64(64 - by)) if by else values


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint once for each block: the block, its value, and the Gray rank of the rotated whole, as a
    signed number in the same order."""
    for batch in batches:
        values = batch["fp"].to_numpy().view(U64)
        turned = [rotated(values, b) for b in range(len(BLOCKS))]
        front = [(t >> U64(64 - w)).astype(np.int32) for t, w in zip(turned, BLOCKS)]
        ranks = np.concatenate([rank_of(t) for t in turned]) ^ U64(1 << 63)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(BLOCKS), dtype=np.int32), len(values))),
             pa.array(np.concatenate(front)), pa.array(ranks.view(np.int64))], ["block", "front", "rank"])


class Index:
    """Fingerprints in the order of their buckets and Gray ranks, cut into trees at `starts`."""

    def __init__(self, values: np.ndarray, starts: np.ndarray, labels: np.ndarray | None = None):
        self.values = values
        self.labels = np.arange(len(values)) if labels is None else labels
        self._ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of the labels of each level's nodes
        counts = np.diff(np.append(starts, len(values)))
        first = np.arange(len(values))
        self.every, self.some = [values], [values]  # the bits that all or some of a node's fingerprints have
        self.first, self.child = [first], [first]
        while counts.max(initial=0) > 1:
            above = -(-counts // FAN)
            base = np.repeat(np.cumsum(counts) - counts, above)
            child = base + FAN * (np.arange(above.sum()) - np.repeat(np.cumsum(above) - above, above))
            self.every.append(np.bitwise_and.reduceat(self.every[-1], child))
            self.some.append(np.bitwise_or.reduceat(self.some[-1], child))
            self.first.append(self.first[-1][child])
            self.child.append(child)
            counts = above

    @property
    def roots(self) -> int:
        return len(self.first[-1])

    def members(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of the first and last fingerprint of some nodes."""
        ends = np.append(self.first[level], len(self.values))
        return ends[nodes], ends[nodes + 1] - 1

    def bounds(self, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and most bits in which fingerprints of two nodes can differ."""
        every, some = self.every[level], self.some[level]
        open_bits = (every[a] ^ some[a]) | (every[b] ^ some[b])
        least = np.bitwise_count((every[a] ^ every[b]) & ~open_bits).astype(np.int64)
        return least, least + np.bitwise_count(open_bits)

    def _settled(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether all fingerprints of both nodes are in one component."""
        if level not in self._ranges:
            first = self.first[level]
            self._ranges[level] = np.minimum.reduceat(self.labels, first), np.maximum.reduceat(self.labels, first)
        low, high = self._ranges[level]
        return (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])

    def _connect(self, a: np.ndarray, b: np.ndarray) -> None:
        """Gives the fingerprints at a and b the least label of both."""
        while True:
            x, y = self.labels[a], self.labels[b]
            apart = x != y
            if not apart.any():
                return
            to = np.arange(len(self.labels))
            np.minimum.at(to, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (to[to] != to).any():
                to = to[to]
            self.labels, self._ranges = to[self.labels], {}

    def _spans(self, first: np.ndarray, last: np.ndarray, other: np.ndarray) -> None:
        sizes = last - first + 1
        places = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        self._connect(places, np.repeat(other, sizes))

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Connects what is close within the trees of the roots a and b, taken in pairs."""
        stack = [(len(self.first) - 1, a, b)]
        while stack:
            level, a, b = stack.pop()
            most_pairs = PAIRS if level else PAIRS * FAN * FAN
            if len(a) > most_pairs:
                stack += [(level, a[at:at + most_pairs], b[at:at + most_pairs]) for at in range(0, len(a), most_pairs)]
                continue
            least, most = self.bounds(level, a, b)
            near = (least <= DISTANCE) & ~self._settled(level, a, b)
            close = near & (most <= DISTANCE)
            if close.any():
                first_a, last_a = self.members(level, a[close])
                first_b, last_b = self.members(level, b[close])
                self._spans(first_a, last_a, first_b)
                self._spans(first_b, last_b, first_a)
            if level == 0:
                continue
            a, b = a[near & ~close], b[near & ~close]
            ends = np.append(self.child[level], len(self.first[level - 1]))
            na, nb = ends[a + 1] - ends[a], ends[b + 1] - ends[b]
            sizes = na * nb
            row = np.repeat(np.arange(len(a)), sizes)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            x, y = ends[a[row]] + turn // nb[row], ends[b[row]] + turn % nb[row]
            once = (a[row] != b[row]) | (x <= y)
            if once.any():
                stack.append((level - 1, x[once], y[once]))


def _links(values: np.ndarray, labels: np.ndarray, before: np.ndarray | None = None) -> pa.RecordBatch:
    """A link for every fingerprint, or every label there was before, that has another label now."""
    moved = np.arange(len(labels)) if before is None else np.unique(before)
    moved = moved[labels[moved] != moved]
    return pa.RecordBatch.from_arrays([pa.array(values[moved].view(np.int64)), pa.array(values[labels[moved]].view(np.int64))],
                                      ["a", "b"])


def _unturned(ranks: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    turned = value_of(ranks.view(U64) ^ U64(1 << 63))
    by = np.cumsum((0, *BLOCKS))[blocks].astype(U64)
    return (turned >> by) | np.where(by > 0, turned << ((U64(64) - by) & U64(63)), U64(0))


def _sorted_runs(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.Table]:
    """Sorted rows in runs of about `held`, cut between buckets wherever a bucket is shorter than that."""
    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        while kept.num_rows > held:
            key = kept["block"].to_numpy().astype(np.int64) << 16 | kept["front"].to_numpy()
            at = int(np.searchsorted(key, key[held]))
            yield kept.slice(0, at or held)
            kept = kept.slice(at or held)
    if kept is not None and kept.num_rows:
        yield kept


def _joined(most: int):
    """Links within buckets of at most `most`, which are whole in their task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _sorted_runs(batches, max(HELD, most)):
            block, front = run["block"].to_numpy(), run["front"].to_numpy()
            key = block.astype(np.int64) << 16 | front
            starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            index = Index(_unturned(run["rank"].to_numpy(), block), starts)
            index.join(np.arange(index.roots), np.arange(index.roots))
            yield _links(index.values, index.labels)
    return work


def _chunked(most: int):
    """Chunks of hot buckets with their links, as rows: the links in two arrays, members in Gray order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _sorted_runs(batches, most):
            block, front, rank = (run[c].to_numpy() for c in ("block", "front", "rank"))
            key = block.astype(np.int64) << 16 | front
            for part in np.split(np.arange(len(key)), np.flatnonzero(key[1:] != key[:-1]) + 1):
                index = Index(_unturned(rank[part], block[part]), np.zeros(1, np.int64))
                index.join(np.zeros(1, np.int64), np.zeros(1, np.int64))
                found = _links(index.values, index.labels)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block[part[:1]]), pa.array(front[part[:1]]), pa.array(rank[part[:1]]),
                     pa.array(index.every[-1].view(np.int64)), pa.array(index.some[-1].view(np.int64)),
                     *[pa.array([v.tolist()], pa.list_(pa.int64()))
                       for v in (index.values.view(np.int64), found["a"].to_numpy(), found["b"].to_numpy())]],
                    ["block", "front", "start", "every", "some", "members", "a", "b"])
    return work


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two chunks of a bucket, whose members come with the components they have so far."""
    for batch in batches:
        for r in range(batch.num_rows):
            parts = [np.array(batch[c][r].as_py(), np.int64) for c in ("members1", "members2")]
            values = np.concatenate(parts).view(U64)
            names = np.concatenate([np.array(batch[c][r].as_py(), np.int64) for c in ("labels1", "labels2")])
            _, first, inverse = np.unique(names, return_index=True, return_inverse=True)
            before = first[inverse]
            index = Index(values, np.array([0, len(parts[0])]), before.copy())
            index.join(np.zeros(1, np.int64), np.ones(1, np.int64))
            yield _links(values, index.labels, before)


def _hot_links(keyed: DataFrame, hot: DataFrame, most: int) -> DataFrame:
    """Links within buckets of more than `most` fingerprints."""
    rows = keyed.join(hot, ["block", "front"], "left_semi").repartitionByRange("block", "front", "rank") \
        .sortWithinPartitions("block", "front", "rank")
    chunks = stored(rows.mapInArrow(_chunked(most), "block int, front int, start long, every long, some long, "
                                                    "members array<long>, a array<long>, b array<long>"))
    links = stored(chunks.select(F.explode(F.arrays_zip("a", "b")).alias("l")).select("l.a", "l.b").distinct())
    labels = connected(links)
    placed = chunks.select("block", "front", "start", F.posexplode("members").alias("at", "node")) \
        .join(labels, "node", "left").groupBy("block", "front", "start").agg(
            F.sort_array(F.collect_list(F.struct("at", F.coalesce("component", "node").alias("label")))).alias("_l"))
    placed = stored(placed.select("block", "front", "start", F.col("_l.label").alias("labels"))
                    .withColumn("lowest", F.array_min("labels")).withColumn("highest", F.array_max("labels"))
                    .join(chunks.select("block", "front", "start", "every", "some", "members"), ["block", "front", "start"]))
    heads = placed.select("block", "front", "start", "every", "some", "lowest", "highest")
    one, two = ([F.col(c).alias(f"{c}{i}") for c in ("start", "every", "some", "lowest", "highest")] for i in (1, 2))
    differ = F.expr(f"bit_count((every1 ^ every2) & ~(every1 ^ some1) & ~(every2 ^ some2)) <= {DISTANCE}")
    apart = F.expr("NOT (lowest1 = highest1 AND lowest2 = highest2 AND lowest1 = lowest2)")
    pairs = heads.select("block", "front", *one).join(heads.select("block", "front", *two), ["block", "front"]) \
        .filter((F.col("start1") < F.col("start2")) & differ & apart).select("block", "front", "start1", "start2")
    side = lambda i: placed.select("block", "front", F.col("start").alias(f"start{i}"),
                                   F.col("members").alias(f"members{i}"), F.col("labels").alias(f"labels{i}"))
    both = pairs.join(side(1), ["block", "front", "start1"]).join(side(2), ["block", "front", "start2"])
    return links.unionByName(both.mapInArrow(_across, "a long, b long"))


def links(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """Links `a`, `b` of distinct fingerprints `fp`, enough to connect all that differ in at most DISTANCE bits.
    Only members of one connected group are ever linked."""
    keyed = stored(distinct.select("fp").mapInArrow(_keyed, "block int, front int, rank long"))
    sizes = keyed.groupBy("block", "front").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    sizes = stored(sizes)
    cold = keyed.join(sizes.filter(F.col("size") <= most), ["block", "front"], "left_semi")
    found = cold.repartition("block", "front").sortWithinPartitions("block", "front", "rank")\
        .mapInArrow(_joined(most), "a long, b long")
    hot = sizes.filter(F.col("size") > most).select("block", "front")
    if hot.take(1):
        found = found.unionByName(_hot_links(keyed, hot, most))
    return stored(found.distinct())


def find_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """One row per document: `id`, `fp`, `fingerprint` (16 hexadecimal digits) and `component_id`, the smallest id
    reachable. Ids are integers."""
    rows = stored(fingerprints(docs, id_col, text_col))
    entries = stored(rows.groupBy("fp").agg(F.min("id").alias("least")))
    labels = connected(links(entries, most))
    named = entries.join(labels.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = named.join(names, "component").select("fp", "component_id")
    return rows.join(of, "fp").select("id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
