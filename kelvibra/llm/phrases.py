"""Phrase collocations, counted on a prefix-free parse of the corpus.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and pieces into words. A text is parsed
into chunks: a new chunk starts where a hash of two neighbouring words says so, and every chunk goes on over the first
four words of the next, as far as their piece goes. So a chunk's extent depends on its content only, and equal passages
give equal chunks wherever they stand. The distinct chunks of a language with their frequencies are the dictionary, the
one table that is counted. A chunk owns the words up to the next chunk's first; a phrase is counted in the chunk that owns
its first word, once for each of the chunk's occurrences. With four words of overlap a phrase of five words lies whole in
that chunk, and no phrase is counted twice.

A phrase can be as frequent as `least` only if its words and the shorter phrases in it are. Words are counted first, then
hashes of the pairs of frequent words, then the frequent pairs and the longer phrases whose pairs are all frequent. What is
frequent goes to the workers as a Bloom filter of at most MAX_BITS bits. Two pairs with one hash, or a bit set by chance,
make a worker count a phrase that the last counts then drop: these are of strings, so that results do not depend on hashes
or on the filter's size.

Defined results: a null text has no words, a null language is `und`; a phrase's score is that of its lowest-scoring cut.
Texts that repeat count each time. No documents, or none with frequent phrases, give no rows. Scores are whole numbers in
decimal arithmetic, exact for counts below 10^15.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvibra.llm import words as W
from kelvibra.llm.stores import stored

LONGEST = 5
LEAST = 100
TOP = 2000
SHARE = 100  # percent: a candidate within a longer one this frequent is dropped
EVERY = 32  # words to a chunk, about
MAX_BITS = 1 << 28
BITS_PER_ENTRY = 16
PROBES = 4
SEGMENT = 1 << 15  # bits of one row of the filter
HELD_WORDS = 1 << 21  # of the dictionary, which a task counts at once
GATHERED = 1 << 16  # distinct chunks that a task holds before it passes them on
# floor(1000 a n / (l r)); `div` cuts the exact quotient off
SCORE = ("CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(15,0)) "
         "DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0)))")

PIECE_END, ROW_END, SPACE = 10, 11, 32


_POWERS = np.multiply.accumulate(np.full(1 << 12, W.BASE, W.U64))


def _table() -> bytes:
    table = bytearray(range(256))
    table[65:91] = table[97:123]
    for c in b".,;:!?\n\x0b\x0c\r":
        table[c] = PIECE_END
    table[9] = SPACE
    return bytes(table)


TABLE = _table()


def chunks(texts: list[bytes], every: int = EVERY) -> Iterator[tuple[int, int, bytes]]:
    """(text's index, words owned, the chunk with single spaces and a line end between pieces) for the chunks of some
    texts."""
    data = np.frombuffer(b"\x0b".join([t.translate(TABLE) for t in texts]) + b"\x0b", np.uint8)
    end = (data == PIECE_END) | (data == ROW_END)
    space = data == SPACE
    data = data[~(space & np.append((space | end)[1:], True))]  # the last space of a run stays, unless a piece ends there
    end = (data == PIECE_END) | (data == ROW_END)
    data = data[~((data == SPACE) & np.append(True, end[:-1]))]
    end = (data == PIECE_END) | (data == ROW_END)
    data = data[~((data == PIECE_END) & np.append(end[1:], True))]
    end = (data == PIECE_END) | (data == ROW_END)
    letter = ~end & (data != SPACE)
    starts = np.flatnonzero(letter & ~np.append(False, letter[:-1]))
    if not len(starts):
        return
    ends = np.flatnonzero(letter & ~np.append(letter[1:], False)) + 1
    codes = np.where(letter, W.numbers(31, 256)[data], W.U64(0))
    own = W.mix(np.add.reduceat(codes, starts))
    piece = np.cumsum(end)[starts]
    row = np.cumsum(data == ROW_END)[starts]
    before = np.append(own[:1], own[:-1])
    trigger = W.mix(before * W.U64(3) + own) % W.U64(every) == 0
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]) | trigger)
    following = np.append(first[1:], len(starts))
    last = np.minimum(following + (LONGEST - 1), np.searchsorted(piece, piece[following - 1], "right"))
    raw = data.tobytes()
    yield from zip(row[first].tolist(), (following - first).tolist(),
                   [raw[a:b] for a, b in zip(starts[first].tolist(), ends[last - 1].tolist())])


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", every: int = EVERY) -> DataFrame:
    """`lang`, `chunk`, `own` (words owned) and `freq`: the distinct chunks of each language. Chunks are counted
    within a task as far as its memory goes, and partly before the shuffle."""
    schema = "lang string, chunk binary, own int, freq long"

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            keys = list(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.binary()),
                 pa.array([k[1] for k in keys], pa.int32()), pa.array(list(held.values()), pa.int64())],
                ["lang", "chunk", "own", "freq"])
            held.clear()
            return out
        for batch in batches:
            langs = batch["lang"].to_pylist()
            for block in W.blocks(batch["text"]):
                raw, cuts = block.data.tobytes(), block.bounds.tolist()
                texts = [raw[a:b] for a, b in zip(cuts, cuts[1:])]
                held.update([(langs[block.first + r], own, c) for r, own, c in chunks(texts, every)])
                if len(held) >= GATHERED:
                    yield passed_on()
        if held:
            yield passed_on()
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(parsed, schema).groupBy("lang", "chunk", "own").agg(F.sum("freq").alias("freq"))


def _hashes(column: pa.Array) -> np.ndarray:
    """64-bit hashes of byte strings. Only the filter relies on them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    starts = offsets[:-1] - (offsets[0] if len(column) else 0)
    sizes = np.diff(offsets)
    places = np.arange(len(data)) - np.repeat(starts, sizes)
    sums = np.zeros(len(column), W.U64)
    filled = sizes > 0
    if filled.any():
        sums[filled] = np.add.reduceat(W.numbers(33, 256)[data] * _POWERS[places % len(_POWERS)], starts[filled])
    return W.mix(sums + sizes.astype(W.U64))


def word_hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    return pair_hashes(_hashes(langs), _hashes(words))


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return W.mix(first * W.U64(W.BASE) + second)


def _places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    """The bits of a filter of `size` bits that stand for each hash."""
    a, b = hashes & W.U64(0xFFFFFFFF), (hashes >> W.U64(32)) | W.U64(1)
    return [((a + W.U64(i) * b) & W.U64(size - 1)).astype(np.int64) for i in range(PROBES)]


class Frequent:
    """A Bloom filter over (language, word) or (language, pair); what was put in is always found."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def found(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in _places(hashes, len(self.bits) * 8):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def frequent_filter(counted: DataFrame) -> Frequent:
    """The filter of a table's words (lang, phrase) or of its hashes (gram). Its bits are put together where they meet;
    the driver gets at most MAX_BITS of them."""
    entries = counted.count()
    size = SEGMENT
    while size < min(MAX_BITS, BITS_PER_ENTRY * entries):
        size *= 2
    hashed = "gram" in counted.columns

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch["gram"].to_numpy().view(W.U64) if hashed else word_hashes(batch["lang"], batch["phrase"])
            at = np.concatenate(_places(hashes, size))
            yield pa.RecordBatch.from_arrays([pa.array((at // SEGMENT).astype(np.int32)), pa.array(at % SEGMENT)], ["segment", "bit"])
    rows = counted.select(*(["gram"] if hashed else ["lang", "phrase"])).mapInArrow(places, "segment int, bit long") \
        .groupBy("segment").agg(F.bitmap_construct_agg("bit").alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for r in rows.toArrow().to_pylist():
        at = r["segment"] * (SEGMENT // 8)
        bits[at:at + SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
    return Frequent(bits)


class _Chunks:
    """Some rows of the dictionary as one run of words."""

    def __init__(self, table: pa.Table):
        split = pc.split_pattern(pc.replace_substring(table["chunk"].combine_chunks(), b"\n", b" \n "), b" ")
        sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        langs = table["lang"].combine_chunks().dictionary_encode()
        row = np.repeat(np.arange(len(sizes)), sizes)
        codes = coded.indices.to_numpy()
        word = codes != pc.index(coded.dictionary, pa.scalar(b"\n", coded.dictionary.type)).as_py()
        piece = (np.cumsum(~word) + row)[word]
        row, codes = row[word], codes[word]
        at = np.arange(len(row))
        self.left = np.searchsorted(piece, piece, "right") - at  # words from here to the piece's end
        self.owned = at - np.searchsorted(row, row) < table["own"].to_numpy()[row]
        self.freq = table["freq"].to_numpy()[row].astype(np.float64)
        lang = langs.indices.to_numpy().astype(np.int64)[row]
        ids, keys = pd.factorize(lang * len(coded.dictionary) + codes)
        self.ids = ids.astype(np.int64)  # of (language, word)
        self.of_lang, of_word = np.divmod(keys, len(coded.dictionary))
        self.langs, self.words = langs.dictionary, coded.dictionary.take(pa.array(of_word))

    def hashes(self) -> np.ndarray:
        """Of each (language, word)."""
        return pair_hashes(_hashes(self.langs)[self.of_lang], _hashes(self.words))

    def joined(self, at: np.ndarray, ids: np.ndarray, j: int) -> tuple[np.ndarray, int]:
        """Ids of the phrases made longer by their j-th next word, and how many there are."""
        found, distinct = pd.factorize(ids * len(self.words) + self.ids[at + j])
        return found.astype(np.int64), len(distinct)

    def hashed(self, at: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        """Distinct hashes of what starts at some places, and how often they occur."""
        ids, distinct = pd.factorize(hashes)
        n = np.bincount(ids, self.freq[at], len(distinct)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(distinct, W.U64).view(np.int64)), pa.array(n)], ["gram", "a"])

    def rows(self, at: np.ndarray, ids: np.ndarray, distinct: int, size: int) -> pa.RecordBatch:
        """Distinct phrases of `size` words that start at some places, and how often they occur. Sums are of whole
        numbers below 2^53."""
        n = np.bincount(ids, self.freq[at], distinct).astype(np.int64)
        places = np.zeros(distinct, np.int64)
        places[ids] = at
        words = [self.words.take(pa.array(self.ids[places + j])) for j in range(size)]
        phrase = pc.binary_join_element_wise(*words, b" ") if size > 1 else words[0]
        langs = self.langs.take(pa.array(self.of_lang[self.ids[places]]))
        return pa.RecordBatch.from_arrays([langs, phrase, pa.array(np.full(distinct, size, np.int32)), pa.array(n)],
                                          ["lang", "phrase", "size", "a"])


def _words(run: _Chunks) -> Iterator[pa.RecordBatch]:
    at = np.flatnonzero(run.owned)
    yield run.rows(at, run.ids[at], len(run.words), 1)


def _pairs(words: Frequent) -> Callable[[_Chunks], Iterator[pa.RecordBatch]]:
    def count(run: _Chunks) -> Iterator[pa.RecordBatch]:
        hashes = run.hashes()
        known = words.found(hashes)[run.ids]
        at = np.flatnonzero(run.owned & (run.left >= 2) & known & np.append(known[1:], False))
        yield run.hashed(at, pair_hashes(hashes[run.ids[at]], hashes[run.ids[at + 1]]))
    return count


def _phrases(words: Frequent, pairs: Frequent) -> Callable[[_Chunks], Iterator[pa.RecordBatch]]:
    def count(run: _Chunks) -> Iterator[pa.RecordBatch]:
        hashes = run.hashes()
        known = words.found(hashes)[run.ids]
        at = np.flatnonzero((run.left >= 2) & known & np.append(known[1:], False))
        at = at[pairs.found(pair_hashes(hashes[run.ids[at]], hashes[run.ids[at + 1]]))]
        chain = np.zeros(len(run.ids) + LONGEST, bool)  # a frequent pair starts here
        chain[at] = True
        at = at[run.owned[at]]
        ids = run.ids[at]
        for size in range(2, LONGEST + 1):
            on = chain[at + size - 2] & (run.left[at] >= size)
            at, ids = at[on], ids[on]
            ids, distinct = run.joined(at, ids, size - 1)
            yield run.rows(at, ids, distinct, size)
    return count


def _runs(work: Callable[[_Chunks], Iterator[pa.RecordBatch]]):
    """Work on the dictionary in runs that a task can hold."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, GATHERED):
                part = batch.slice(at, GATHERED)
                held, size = [*held, part], size + part["chunk"].nbytes // 6
                if size >= HELD_WORDS:
                    yield from work(_Chunks(pa.Table.from_batches(held)))
                    held, size = [], 0
        if held:
            run = pa.Table.from_batches(held)
            if run.num_rows:
                yield from work(_Chunks(run))
    return counted


def phrase_counts(chunked: DataFrame, least: int = LEAST) -> DataFrame:
    """`lang`, `phrase`, `size`, `a` of all phrases of one to five words that occur at least `least` times, of a stored
    dictionary."""
    def counted(work: Callable[[_Chunks], Iterator[pa.RecordBatch]], columns: str, keys: list[str]) -> DataFrame:
        return stored(chunked.mapInArrow(_runs(work), f"{columns}, a long").groupBy(*keys).agg(F.sum("a").alias("a"))
                      .filter(F.col("a") >= least))
    named = "lang string, phrase binary, size int", ["lang", "phrase", "size"]
    singles = counted(_words, *named)
    words = frequent_filter(singles)
    pairs = frequent_filter(counted(_pairs(words), "gram long", ["gram"]))
    return singles.unionByName(counted(_phrases(words, pairs), *named))


def _inner(least: int, most: F.Column) -> F.Column:
    """The phrases of `least` to `most` words that lie in `phrase`, as an array."""
    words = F.split(F.col("phrase").cast("string"), " ")
    sizes = F.sequence(F.lit(least), most)
    return F.flatten(F.transform(sizes, lambda n: F.transform(
        F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP,
                 share: int = SHARE, every: int = EVERY) -> DataFrame:
    """Each language's `top` phrases: lang, rank, phrase, a, l, r, n, score."""
    chunked = stored(dictionary(docs, text, lang, every))
    totals = chunked.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))
    counts = phrase_counts(chunked, least).withColumn("phrase", F.col("phrase").cast("string"))
    candidates = counts.filter("size > 1")
    words = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")) \
        .select("*", F.array_join(F.slice(words, 1, F.col("k")), " ").alias("left"),
                F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    part = lambda c, n: counts.select("lang", F.col("phrase").alias(c), F.col("a").alias(n))
    scored = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(totals, "lang")
    best = scored.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "size").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("_b")).select("lang", "phrase", "size", "_b.*")
    within = candidates.filter("size > 2").select(
        "lang", F.explode(F.array_distinct(_inner(2, F.col("size") - 1))).alias("phrase"), F.col("a").alias("longer")) \
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(within, ["lang", "phrase"], "left") \
        .filter(F.coalesce(F.col("longer") * 100 < F.col("a") * share, F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
