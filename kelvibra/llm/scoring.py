"""Language-model scoring from a log-frequency Bloom filter.

A count c is quantised to the level 1 + floor(log2 c), and an n-gram of level q is put into the filter q
times, once with each of the numbers 1 to q. Asked about an n-gram, the filter is probed with 1, 2, ... until
one is missing; the last found is its level, from which the expected count follows. A level is never too low,
and too high by one with the filter's error rate.

The model is a bigram model with Dirichlet smoothing towards add-one unigrams; every document ends with an end
token, which is also the context of its first word. All training documents are counted. The filter has eight to
sixteen bits for each of its entries (an n-gram with one number), however many there are, and is a table of segments,
built where the counts of a segment's n-grams meet. A filter of up to MAX_BITS is sent to the workers. A larger one
stays where it is: blocks of documents ask for each of their n-grams once, the questions meet the segments they are
about, and the levels go back to the blocks. Both ways give the same levels.

Beside it a base score is summed from exact counts: the most frequent tokens, at most HEAD, are sent to the
workers; the rest of a document's tokens meet their counts in a join, in which no token is frequent.

Words are told apart by 64-bit fingerprints. Defined results: a null text counts as empty and has the end
token only; without training documents every count is 0 and N is 0; rows that repeat are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelvibra.llm import words as W
from kelvibra.llm.stores import stored

END = W.mix(np.array([0x5EED], W.U64))[0]
MAX_BITS = 1 << 29
BITS_PER_ENTRY = 8
SEGMENT_BITS = 1 << 17
LOT = 64  # segments that a task holds at once
STRETCHES = 1 << 12  # of fingerprints, each of which is counted in one task
ASKED = 1 << 20  # tokens of a block of documents that asks
PIECE = 1 << 10  # questions in a row
HASHES = 3
HEAD = 500_000
PSEUDO = 100.0
FLUSH = 3_000_000
LEVELS = 64


def tokens(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of every row's words and its end token, and the cuts between rows."""
    found = W.words(block)
    cuts = found.bounds + np.arange(block.rows + 1)
    out = np.full(cuts[-1], END, W.U64)
    rows = np.repeat(np.arange(block.rows), np.diff(found.bounds))
    out[np.arange(len(found.hashes)) + rows] = found.hashes
    return out, cuts


def bigrams(found: np.ndarray) -> np.ndarray:
    """Fingerprints of each token with the one before it. An end token stands before every row's first."""
    before = np.empty_like(found)
    before[:1], before[1:] = END, found[:-1]
    return W.mix(before * W.U64(0xD6E8FEB86659FD93) + found)


def _counts(docs: DataFrame, grams, text: str) -> DataFrame:
    """`gram` and `n`, counted within a task as far as its memory goes."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n.astype(np.int64))], ["gram", "n"])
        for batch in batches:
            for block in W.blocks(batch["text"]):
                held.append(grams(tokens(block)[0]))
                size += len(held[-1])
                if size >= FLUSH:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()
    return docs.select(F.col(text).alias("text")).mapInArrow(count, "gram long, n long")


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)  # 1 + floor(log2 c)


def expected(levels: np.ndarray) -> np.ndarray:
    """The mean of the counts of a level, 0 for level 0."""
    return np.where(levels > 0, (2.0 ** (levels - 1) + 2.0 ** levels - 1) / 2, 0.0)


def _places(grams: np.ndarray, level: int, k: int) -> np.ndarray:
    return (W.mix(grams + W.U64((level * HASHES + k) * W.BASE % (1 << 64))) & W.U64(SEGMENT_BITS - 1)).astype(np.int64)


class Filter:
    """Segments of bits; an n-gram's first bits name the segment that holds all of its levels. `held` of them, which
    follow each other, can stand alone."""

    def __init__(self, segments: int, data: np.ndarray | None = None, held: int = 0):
        self.held = held or segments
        self.shift = 64 - (segments.bit_length() - 1)
        self.data = np.zeros(self.held * SEGMENT_BITS // 8, np.uint8) if data is None else data

    def segment(self, grams: np.ndarray) -> np.ndarray:
        return (grams >> W.U64(self.shift)).astype(np.int64) % self.held if self.shift < 64 else np.zeros(len(grams), np.int64)

    def put(self, segment: int, bits: bytes) -> None:
        """Adds a part of a segment."""
        size, at = SEGMENT_BITS // 8, segment % self.held
        self.data[at * size:(at + 1) * size] |= np.frombuffer(bits, np.uint8)

    def levels(self, grams: np.ndarray) -> np.ndarray:
        """Probes with 1, 2, ... those n-grams that were found so far."""
        out = np.zeros(len(grams), np.int64)
        left, base = np.arange(len(grams)), self.segment(grams) * SEGMENT_BITS
        for level in range(1, LEVELS + 1):
            for k in range(HASHES):
                at = base[left] + _places(grams[left], level, k)
                left = left[(self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            if not len(left):
                break
            out[left] = level
        return out


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[pa.Table]:
    """Small batches of numbers as tables of `rows` rows or a little more."""
    held, size = [], 0
    for batch in batches:
        held, size = [*held, batch], size + batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _whole(counts: DataFrame) -> DataFrame:
    """`gram` and `n`, which may come in parts, with each n-gram once and neighbours in the same files."""
    stretch = F.shiftrightunsigned("gram", 64 - (STRETCHES.bit_length() - 1))
    return stored(counts.withColumn("stretch", stretch).repartition("stretch")
                  .groupBy("stretch", "gram").agg(F.sum("n").alias("n")).drop("stretch"))


def needed(whole: DataFrame) -> int:
    """The number of segments, a power of two, for all entries of the counts."""
    entries = whole.agg(F.sum(F.length(F.bin("n")))).first()[0] or 0
    return 1 << (max(1, -(-entries * BITS_PER_ENTRY // SEGMENT_BITS)) - 1).bit_length()


def filter_table(whole: DataFrame, segments: int) -> DataFrame:
    """`segment` and `bits` of a filter of the counts; a segment may come in parts."""
    shift = 64 - (segments.bit_length() - 1)
    segment = F.shiftrightunsigned("gram", shift) if shift < 64 else F.lit(0).cast("long")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, int] = {}
        bits = np.zeros((0, SEGMENT_BITS // 8), np.uint8)
        for batch in _gathered(batches):
            names, at = np.unique(batch["segment"].to_numpy(), return_inverse=True)
            for name in names.tolist():
                held.setdefault(name, len(held))
            if len(held) > len(bits):
                bits = np.concatenate([bits, np.zeros((len(held) - len(bits), bits.shape[1]), np.uint8)])
            row = np.array([held[name] for name in names.tolist()], np.int64)[at]
            grams, top = batch["gram"].to_numpy().view(W.U64), levels_of(batch["n"].to_numpy())
            for level in range(1, int(top.max(initial=0)) + 1):
                put = top >= level
                for k in range(HASHES):
                    place = _places(grams[put], level, k)
                    np.bitwise_or.at(bits, (row[put], place >> 3), np.left_shift(1, place & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()),
                                          pa.array([b.tobytes() for b in bits], pa.binary())], ["segment", "bits"])
    return stored(whole.withColumn("segment", segment).mapInArrow(fill, "segment long, bits binary"))


def build_filter(counts: DataFrame, segments: int) -> Filter:
    """A filter of `gram` and `n`, which may come in parts, on the driver."""
    return _collected(filter_table(_whole(counts), segments), segments)


def _collected(table: DataFrame, segments: int) -> Filter:
    out = Filter(segments)
    for row in table.toLocalIterator():
        out.put(row["segment"], row["bits"])
    return out


@dataclass(frozen=True)
class Questions:
    """The n-grams of some documents, each once: `grams` has their distinct tokens `values` first and then their
    distinct bigrams. `place` and `pair` say which of either each token and its bigram is, `before` the token before."""
    values: np.ndarray
    place: np.ndarray
    before: np.ndarray
    pair: np.ndarray
    grams: np.ndarray

    def scores(self, levels: np.ndarray, total: int, pseudo: float, starts: np.ndarray) -> np.ndarray:
        """Each document's score from the levels of `grams`."""
        counts = expected(levels)
        single, pairs = counts[:len(self.values)], counts[len(self.values):]
        pair = np.minimum(pairs[self.pair], single[self.before])
        smooth = (single[self.place] + 1) / total
        return np.add.reduceat(np.log10((pair + pseudo * smooth) / (single[self.before] + pseudo)), starts)

    def lots(self, segments: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`grams` in the order in which they are asked, and the lot and start of each piece of that order."""
        lot = Filter(segments).segment(self.grams) // size
        order = np.argsort(lot, kind="stable")
        lot = lot[order]
        first = np.flatnonzero(np.concatenate([[True], lot[1:] != lot[:-1]]))
        sizes = np.diff(np.append(first, len(lot)))
        parts = -(-sizes // PIECE)
        part = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(first, parts) + part * PIECE
        return order, lot[starts], starts


def questions(values: np.ndarray, place: np.ndarray) -> Questions:
    """Of documents whose tokens are values[place]; `values` is sorted and has the end token."""
    before = np.empty_like(place)
    before[:1], before[1:] = np.searchsorted(values, END), place[:-1]
    codes, pair = np.unique(before * len(values) + place, return_inverse=True)
    pairs = W.mix(values[codes // len(values)] * W.U64(0xD6E8FEB86659FD93) + values[codes % len(values)])
    return Questions(values, place, before, pair, np.concatenate([values, pairs]))


def _lookup(asked: DataFrame, table: DataFrame, segments: int, size: int) -> DataFrame:
    """The levels, a byte each, for pieces of questions: `block`, `lot`, `start`, `data`. Where a lot's segments are
    held, its questions stream by."""
    bits = table.select(F.lit(-1).cast("long").alias("block"), F.floor(F.col("segment") / size).alias("lot"),
                        F.col("segment").alias("start"), F.col("bits").alias("data"))
    both = asked.select("block", "lot", "start", "data").unionByName(bits)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counted = -1, None
        for batch in batches:
            lots, blocks = batch["lot"].to_numpy(), batch["block"].to_numpy()
            cuts = [0, *(np.flatnonzero((lots[1:] != lots[:-1]) | ((blocks[1:] < 0) != (blocks[:-1] < 0))) + 1), len(lots)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if lots[a] != now:
                    now, counted = lots[a], Filter(segments, held=min(size, segments))
                data = batch["data"].slice(a, b - a).to_pylist()
                if blocks[a] < 0:
                    for segment, part in zip(batch["start"].slice(a, b - a).to_pylist(), data):
                        counted.put(segment, part)
                    continue
                found = counted.levels(np.frombuffer(b"".join(data), W.U64)).astype(np.uint8).tobytes()
                ends = np.cumsum([len(d) // 8 for d in data]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [batch["block"].slice(a, b - a), batch["start"].slice(a, b - a),
                     pa.array([found[x:y] for x, y in zip([0, *ends], ends)], pa.binary())], ["block", "start", "data"])
    return both.repartition("lot").sortWithinPartitions("lot", "block").mapInArrow(look, "block long, start long, data binary")


def score(docs: DataFrame, trained: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          max_bits: int = MAX_BITS, head: int = HEAD, pseudo: float = PSEUDO, lot: int = LOT) -> DataFrame:
    """Columns of `docs` but the text, and `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` from a
    model of the texts `trained`."""
    spark = docs.sparkSession
    vocabulary = stored(_counts(trained, lambda found: found, text_col).groupBy("gram").agg(F.sum("n").alias("n")))
    totals = vocabulary.agg(F.sum("n").alias("N"), F.count(F.lit(1)).alias("V"),
                            *[F.count_if(F.col("n") >= 1 << j).alias(f"c{j}") for j in range(LEVELS - 1)]).first()
    size, kinds = totals["N"] or 0, totals["V"]
    least = 1 << next((j for j in range(LEVELS - 1) if totals[f"c{j}"] <= head), LEVELS - 2)
    frequent = vocabulary.filter(F.col("n") >= least).toArrow()
    order = np.argsort(frequent["gram"].to_numpy().view(W.U64))
    known = frequent["gram"].to_numpy().view(W.U64)[order]
    logs = np.log10(frequent["n"].to_numpy()[order] + 1.0)
    both = _whole(_counts(trained, bigrams, text_col).unionByName(vocabulary))
    segments = needed(both)
    table = filter_table(both, segments)
    sent = segments * SEGMENT_BITS <= max_bits
    model = spark.sparkContext.broadcast((_collected(table, segments).data if sent else None, known, logs))
    total = size + kinds + 1

    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.monotonically_increasing_id().alias("_llm_key"), F.struct(*others).alias("_llm_own"),
                       F.col(text_col).alias("_llm_text"))

    own = rows.schema["_llm_own"].dataType.simpleString()
    names = ["_llm_key", "_llm_own", "_llm_n", "_llm_held", "_llm_logs", "_llm_rare"]
    kinds_of = f"_llm_key long, _llm_own {own}, _llm_n long, _llm_held long, _llm_logs double, _llm_rare array<long>"

    def base(part: pa.RecordBatch, found: np.ndarray, cuts: np.ndarray, values: np.ndarray, place: np.ndarray) -> list[pa.Array]:
        """The columns `names`: all but the score."""
        _, known, logs = model.value
        at = np.minimum(np.searchsorted(known, values), max(0, len(known) - 1))
        held = known[at] == values if len(known) else np.zeros(len(values), bool)
        own_logs = np.where(held, logs[at] if len(known) else 0.0, 0.0)
        rare = ~held[place]
        starts = cuts[:-1]
        missing = np.add.reduceat(rare.astype(np.int64), starts)
        return [part["_llm_key"], part["_llm_own"], pa.array(np.diff(cuts)), pa.array(np.diff(cuts) - missing),
                pa.array(np.add.reduceat(own_logs[place], starts)),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(missing)]), pa.int32()),
                                         pa.array(found[rare].view(np.int64)))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = Filter(segments, model.value[0])
        for batch in batches:
            for block in W.blocks(batch["_llm_text"]):
                found, cuts = tokens(block)
                values, place = np.unique(found, return_inverse=True)
                asks = questions(values, place)
                chances = asks.scores(counted.levels(asks.grams), total, pseudo, cuts[:-1])
                yield pa.RecordBatch.from_arrays([*base(batch.slice(block.first, block.rows), found, cuts, values, place),
                                                  pa.array(chances)], [*names, "_llm_score"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents (kind 2) with their tokens' places among their block's distinct ones (kind 1), and what the block
        asks (kind 3)."""
        task, blocks = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0

        def out(kind: int, data: list[bytes], lots=None, starts=None, columns=None) -> pa.RecordBatch:
            n = len(data)
            columns = columns or [pa.nulls(n, c.type) for c in plain]
            return pa.RecordBatch.from_arrays(
                [pa.array([task + blocks] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                 pa.array(np.zeros(n, np.int64) if lots is None else lots),
                 pa.array(np.zeros(n, np.int64) if starts is None else starts), pa.array(data, pa.binary()), *columns],
                ["block", "kind", "lot", "start", "data", *names])

        def flush() -> Iterator[pa.RecordBatch]:
            values, place = np.unique(np.concatenate([f for f, _, _ in held]), return_inverse=True)
            at = 0
            for found, cuts, columns in held:
                own = place[at:at + len(found)].astype(np.int32)
                at += len(found)
                yield out(2, [own[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], columns=columns)
            yield out(1, [values.tobytes()])
            asks = questions(values, place)
            order, lots, starts = asks.lots(segments, lot)
            grams = asks.grams[order].tobytes()
            ends = np.append(starts[1:], len(order))
            for a in range(0, len(starts), 1_000):
                yield out(3, [grams[8 * x:8 * y] for x, y in zip(starts[a:a + 1_000], ends[a:a + 1_000])],
                          lots[a:a + 1_000], starts[a:a + 1_000])
        for batch in batches:
            for block in W.blocks(batch["_llm_text"]):
                found, cuts = tokens(block)
                columns = base(batch.slice(block.first, block.rows), found, cuts, *np.unique(found, return_inverse=True))
                plain = columns
                held.append((found, cuts, columns))
                size += len(found)
                if size >= ASKED:
                    yield from flush()
                    held, size, blocks = [], 0, blocks + 1
        if held:
            yield from flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks, each in the order of kinds: the levels (kind 0), distinct tokens, documents."""
        now, levels, values, held = None, [], None, []

        def flush() -> Iterator[pa.RecordBatch]:
            docs = pa.Table.from_batches(held)
            data = docs["data"].to_pylist()
            place = np.frombuffer(b"".join(data), np.int32).astype(np.int64)
            starts = np.concatenate([[0], np.cumsum([len(d) // 4 for d in data])])[:-1]
            asks = questions(values, place)
            order = asks.lots(segments, lot)[0]
            found = np.zeros(len(order), np.int64)
            found[order] = np.frombuffer(b"".join(levels), np.uint8)
            docs = docs.select(names).append_column("_llm_score", pa.array(asks.scores(found, total, pseudo, starts)))
            yield from docs.to_batches()
        for batch in batches:
            kinds, blocks = batch["kind"].to_numpy(), batch["block"].to_numpy()
            cuts = [0, *(np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1), len(kinds)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if blocks[a] != now:
                    if held:
                        yield from flush()
                    now, levels, values, held = blocks[a], [], None, []
                part = batch.slice(a, b - a)
                if kinds[a] == 0:
                    levels.extend(part["data"].to_pylist())
                elif kinds[a] == 1:
                    values = np.frombuffer(part["data"][0].as_py(), W.U64)
                else:
                    held.append(part)
        if held:
            yield from flush()

    if sent:
        measured = rows.mapInArrow(measure, f"{kinds_of}, _llm_score double")
    else:
        asked = stored(rows.mapInArrow(ask, f"block long, kind int, lot long, start long, data binary, {kinds_of}"))
        found = _lookup(asked.filter("kind = 3"), table, segments, lot).withColumn("kind", F.lit(0))
        measured = (asked.filter("kind < 3").drop("lot").unionByName(found, allowMissingColumns=True)
                    .repartition("block").sortWithinPartitions("block", "kind", "start")
                    .mapInArrow(answer, f"{kinds_of}, _llm_score double"))
    measured = stored(measured)
    rare = measured.select("_llm_key", F.explode("_llm_rare").alias("gram")).groupBy("_llm_key", "gram") \
        .agg(F.count(F.lit(1)).alias("times"))
    extra = (rare.join(vocabulary.filter(F.col("n") < least), "gram").groupBy("_llm_key")
             .agg(F.sum("times").alias("_llm_more"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("_llm_add")))
    whole = measured.drop("_llm_rare").join(extra, "_llm_key", "left")
    exact = F.col("_llm_logs") + F.coalesce("_llm_add", F.lit(0.0)) - F.col("_llm_n") * float(np.log10(total))
    return whole.select("_llm_own.*", F.col("_llm_n").alias("n_tokens"),
                        (F.col("_llm_held") + F.coalesce("_llm_more", F.lit(0))).alias("n_known"),
                        F.lit(size).cast("long").alias("train_tokens"), exact.alias("base_score"),
                        F.col("_llm_score").alias("score"))
