"""Near-duplicate detection by b-bit MinHash.

A document is the set of its distinct five-word shingles. 160 minima per document make 40 band keys of four
minima each; documents with a band key in common are candidates. Of 1,024 minima of every candidate the low
two bits are kept and packed into 256 bytes. The share of equal low bits, counted with exclusive or and bit
counts and corrected for chance (one in four), estimates the similarity of a pair; what may reach the
threshold is confirmed on the full sets. At a similarity of 0.75 all bands miss a pair with a probability of
3e-7, and so does the estimate, which is given five standard deviations of slack.

Documents with the same sequence of words are one class. Within a band's bucket classes are not paired with
each other. In the first round they meet the class of their bucket that shares most bands with others; after
that, up to 512 pivots from outside that class's component, and only if of another component: classes that
are connected already need no pair. Within the join a pair is kept only if its signatures are alike and no
earlier band has it. A class that has been a pivot leaves the bucket, a bucket within one component is
settled. So a group of near copies costs about one pair per member and band, and no link is lost.

Defined results: a document without words, or null, has no shingles and is linked with nothing; a null id
comes after all others; `stays` is true for exactly one row per component, the first by id, file and row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvibra.llm import words as W
from kelvibra.llm.components import connected
from kelvibra.llm.stores import FILE, ROW, broadcast_rows, located, stored

WIDTH = 5
BAND_ROWS, BANDS = 4, 40
MINIMA, BITS = 1024, 2  # of a signature
LONGS = MINIMA // 64
PERCENT = 75
PIVOTS = 1024
LOCATED_ROWS = 200_000


def minima(values: np.ndarray, count: int, seed: int) -> np.ndarray:
    """The least value of a set of fingerprints under each of `count` hash functions."""
    seeds = (W.numbers(seed, count) >> W.U64(32)).astype(np.uint32)[:, None]
    factors = (W.numbers(seed + 1, count) >> W.U64(32)).astype(np.uint32)[:, None] | np.uint32(1)
    h = (values >> W.U64(32)).astype(np.uint32)
    best = np.full(count, 0xFFFFFFFF, np.uint32)
    step = 1 + (1 << 18) // count
    for at in range(0, len(h), step):
        np.minimum(best, ((h[None, at:at + step] ^ seeds) * factors).min(axis=1), out=best)
    return best


def band_keys(values: np.ndarray) -> np.ndarray:
    least = minima(values, BANDS * BAND_ROWS, 10).astype(W.U64).reshape(BANDS, BAND_ROWS)
    rows = least * (W.numbers(5, BAND_ROWS) | W.U64(1))
    return W.mix(rows.sum(axis=1, dtype=W.U64) + W.numbers(6, BANDS)).view(np.int64)


def packed(values: np.ndarray) -> np.ndarray:
    """The low bits of the mixed minima, one bit plane after another."""
    low = W.mix(minima(values, MINIMA, 20).astype(W.U64)).astype(np.uint8)
    planes = (low[None, :] >> np.arange(BITS, dtype=np.uint8)[:, None]) & 1
    return np.packbits(planes, axis=1, bitorder="little").reshape(-1).view(np.int64)


def estimate(a: str, b: str) -> F.Column:
    """Similarity by two packed signatures, corrected for low bits that agree by chance."""
    differ = " + ".join("bit_count(" + " | ".join(f"({a}[{p * LONGS + k}] ^ {b}[{p * LONGS + k}])" for p in range(BITS))
                        + ")" for k in range(LONGS))
    chance = 2.0 ** -BITS
    return ((1 - F.expr(differ) / float(MINIMA)) - chance) / (1 - chance)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    cuts = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                    pa.array(np.concatenate([np.zeros(0, np.int64), *rows]).view(np.int64)))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch["text"]):
            found = W.words(block)
            values, cuts = W.shingles(found.hashes, found.bounds, WIDTH)
            keys, sizes, bands = [], [], []
            for r in range(block.rows):
                own = np.unique(values[cuts[r]:cuts[r + 1]])
                sizes.append(len(own))
                sequence = found.hashes[found.bounds[r]:found.bounds[r + 1]]
                keys.append(hashlib.blake2b(sequence.tobytes(), digest_size=16).digest() if len(own) else None)
                bands.append(band_keys(own) if len(own) else np.zeros(0, np.int64))
            part = batch.slice(block.first, block.rows)
            yield pa.RecordBatch.from_arrays(
                [part["id"], part["file"], part["row"], pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 _lists(bands)], ["id", "file", "row", "key", "n", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in W.blocks(batch["text"]):
            found = W.words(block)
            values, cuts = W.shingles(found.hashes, found.bounds, WIDTH)
            sets = [np.unique(values[cuts[r]:cuts[r + 1]]) for r in range(block.rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.slice(block.first, block.rows)["node"], pa.array([len(s) for s in sets], pa.int64()), _lists(sets),
                 _lists([packed(s) for s in sets])], ["node", "n", "members", "low"])


def _marked(rows: DataFrame, number: int, pivots: int) -> DataFrame:
    """The rows of buckets that hold more than one component. `pivot` marks up to `pivots` of a bucket's classes outside
    the component of its best connected class. Two components cannot be linked but through such a class."""
    bucket = Window.partitionBy("bucket")
    live = rows.withColumns({"_l": F.min("component").over(bucket), "_h": F.max("component").over(bucket),
                             "_main": F.max_by("component", F.struct("degree", "node")).over(bucket)}).filter("_l <> _h")
    outside = F.col("component") != F.col("_main")
    place = F.row_number().over(bucket.orderBy(~outside, F.xxhash64("node", F.lit(number)), "node"))
    return live.withColumn("pivot", outside & (place <= pivots)).drop("_l", "_h", "_main")


def _stars(rows: DataFrame) -> DataFrame:
    """The rows with `best`, the best connected class of their bucket."""
    return rows.withColumn("best", F.max(F.struct("degree", "node")).over(Window.partitionBy("bucket"))["node"])


def merges(rows: DataFrame, docs: DataFrame, percent: int = PERCENT, pivots: int = PIVOTS) -> list[DataFrame]:
    """The components of similar classes, round by round: `node`, `component`, where the nodes of a round are the components
    of the one before, or classes that it left alone. Every link behind them is confirmed. `rows` has the classes: `node`,
    `bands`, and `file` and `row` of one document; `docs` the texts."""
    t = percent / 100
    equal = t + (1 - t) * 2.0 ** -BITS
    lowest = t - 5 * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - 2.0 ** -BITS)
    buckets = rows.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = buckets.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).filter("size > 1")
    members = stored(shared.select("bucket", "band", "node", F.sum("size").over(Window.partitionBy("node")).alias("degree")))
    classes = stored(rows.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "file", "row", F.transform("bands", lambda b: F.shiftright(b, 32).cast("int")).alias("lanes")))
    places = broadcast_rows(classes.select("file", "row", "node"), LOCATED_ROWS)
    sets = stored(docs.join(places, ["file", "row"]).select("node", "text")
                  .mapInArrow(_sets, "node long, n long, members array<long>, low array<long>"))

    def own(c: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in columns])

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.join(own("a", "members"), "a").join(own("b", "members"), "b")
        common = F.size(F.array_intersect("members_a", "members_b"))
        return both.filter(common * 100 >= (F.size("members_a") + F.size("members_b") - common) * percent)

    def alike(n: str, m: str, low: str, other: str) -> F.Column:
        return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (estimate(low, other) >= lowest)

    met = _stars(members).filter("node <> best").select(
        F.least("node", "best").alias("a"), F.greatest("node", "best").alias("b")).distinct()
    met = met.join(own("a", "n", "low"), "a").join(own("b", "n", "low"), "b").filter(alike("n_a", "n_b", "low_a", "low_b"))
    found, joined, number = stored(confirmed(met.select("a", "b")).select("a", "b")), [], 1
    rows = _stars(members.withColumn("component", F.col("node"))).filter("node <> best").drop("best")
    while True:
        if found.take(1):
            joined.append(connected(found))
            rows = rows.join(joined[-1].select(F.col("node").alias("component"), F.col("component").alias("_to")),
                             "component", "left").withColumn("component", F.coalesce("_to", "component")).drop("_to")
        rows = _marked(rows, number, pivots)
        if number == 1:  # from here on pairs are told apart within the join
            rows = rows.join(sets.select("node", "n", "low"), "node").join(classes.select("node", "lanes"), "node")
        rows = stored(rows)
        if not rows.take(1):
            return joined
        heads = rows.filter("pivot").select(*[F.col(c).alias(f"p_{c}") for c in ("bucket", "node", "component", "n", "low", "lanes")])
        once = ~F.col("pivot") | (F.col("node") < F.col("p_node"))  # two pivots meet twice
        first = F.array_position(F.zip_with("lanes", "p_lanes", lambda x, y: x == y), True) == F.col("band") + 1
        met = rows.join(heads, (F.col("bucket") == F.col("p_bucket")) & (F.col("component") != F.col("p_component")) & once
                        & alike("n", "p_n", "low", "p_low") & first)
        ends = F.struct("node", "component"), F.struct(F.col("p_node").alias("node"), F.col("p_component").alias("component"))
        met = met.select(F.least(*ends).alias("l"), F.greatest(*ends).alias("h")).select(
            F.col("l.node").alias("a"), F.col("h.node").alias("b"), F.col("l.component").alias("ca"), F.col("h.component").alias("cb"))
        found = stored(confirmed(met).select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
        rows, number = rows.filter("NOT pivot").drop("pivot"), number + 1


def find_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
              pivots: int = PIVOTS) -> DataFrame:
    """One row per document: `id`, `n_shingles`, `component_id`, `stays`, and its locator. Ids are integers."""
    texts = located(docs.select(id_col, text_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(FILE).alias("file"), F.col(ROW).alias("row"),
        F.col(text_col).alias("text"))
    rows = stored(texts.mapInArrow(_signed, "id long, file string, row long, key binary, n long, "
                                            "bands array<long>"))
    place = F.struct(F.col("id").isNull().alias("absent"), "id", "file", "row")
    classes = (rows.filter("n > 0").groupBy("key").agg(F.min(place).alias("first"), F.first("bands").alias("bands"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = stored(classes)
    heads = classes.select("key", "first", F.col("node").alias("component"))
    for joined in merges(classes.select("node", "bands", "first.file", "first.row"), texts.select("file", "row", "text"), percent, pivots):
        heads = heads.join(joined.select(F.col("node").alias("component"), F.col("component").alias("_to")), "component", "left") \
            .withColumn("component", F.coalesce("_to", "component")).drop("_to")
    leads = heads.groupBy("component").agg(F.min("first").alias("lead"))
    leads = heads.join(leads, "component").select("key", "lead")
    own = F.struct(F.col("id").isNull().alias("absent"), "id", "file", "row")
    out = rows.select("id", "file", "row", "key", "n").join(leads, "key", "left") \
        .withColumn("lead", F.coalesce("lead", own))
    stays = (F.col("file") == F.col("lead.file")) & (F.col("row") == F.col("lead.row"))
    return out.select("id", F.col("n").alias("n_shingles"), F.col("lead.id").alias("component_id"),
                      stays.alias("stays"), F.col("file").alias(FILE), F.col("row").alias(ROW))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, all columns as they were."""
    source = located(docs)
    dropped = find_near(source.drop(FILE, ROW), id_col, text_col).filter("NOT stays").select(FILE, ROW)
    dropped = broadcast_rows(stored(dropped), LOCATED_ROWS)
    return source.join(dropped, [FILE, ROW], "left_anti").select(*docs.columns)
