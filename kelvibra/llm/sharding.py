"""Sharding by proportional stratified interleaving.

Within each source rows are shuffled by a seeded hash and ranked; a row's fractional rank is its rank over the
size of its source. Sorted by fractional rank the sources are interleaved in proportion everywhere, so equal
cuts of the sorted rows give shards that all have the mixture of the whole.

No source meets in one task: ranks are counted within buckets of a source's hashes, and within buckets of
fractional ranks, both of which are even by construction; the sizes of the buckets before give the offsets.

Defined results: a null source is a source of its own; null ids and texts count as empty, a null text having
no bytes; rows alike in id, size and checksum are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kelvibra.llm.stores import stored

SEED = 20
BUCKET_ROWS = 50_000


def _rank(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """`_rank` from 1 within the keys but the last, a bucket, which ascends with the order."""
    *outer, bucket = keys
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*outer).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.join(starts, keys).withColumn("_rank", F.col("_start") + within).drop("_start")


def interleave(docs: DataFrame, shards: int = 8, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """`id`, `size` (bytes plus 1), `text_crc32`, `shard` and `slot` of every document. Shards' row counts are
    at most one apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    number = F.col(id_col)
    rows = docs.select(
        number.alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.concat(F.when(F.col(source_col).isNull(), "n").otherwise("s"),
                 F.coalesce(F.col(source_col).cast("string"), F.lit(""))).alias("_source"))
    rows = stored(rows.withColumn("_hash", F.xxhash64(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")),
                                                      "size", "text_crc32")))
    counts = rows.groupBy("_source").agg(F.count(F.lit(1)).alias("_of"))
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    part = F.shiftrightunsigned("_hash", 33) / F.lit(float(1 << 31))
    first = (F.col("_hash").bitwiseXOR(F.lit(-1 << 63))).alias("_order")  # unsigned order, as the buckets have
    ordered = rows.select("*", first, F.floor(part * buckets).alias("_bucket"))
    ranked = _rank(ordered, ["_source", "_bucket"], ["_order", "id", "size", "text_crc32"])
    share = (F.col("_rank") - 0.5) / F.col("_of")
    placed = stored(ranked.join(counts, "_source").withColumn("_share", share)
                    .withColumn("_slice", F.least(F.floor(F.col("_share") * buckets), F.lit(buckets - 1)))
                    .select("id", "size", "text_crc32", "_source", "_order", "_share", "_slice"))
    cut = _rank(placed, ["_slice"], ["_share", "_source", "_order", "id", "size", "text_crc32"])
    at = cut.withColumn("_at", F.col("_rank") - 1).withColumn(
        "shard", F.expr(f"cast(_at * {shards} div {max(total, 1)} as int)"))
    slot = F.col("_at") - F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return at.select("id", "size", "text_crc32", "shard", slot.cast("long").alias("slot"))
