"""Exact deduplication as a stateful stream.

Texts count as equal if they are after runs of white space have become one space. A first job writes each
row's digest and locator (file and place in it); a stream groups them by digest. Its state is keyed by
digest, is held on disk by RocksDB, never expires, and keeps the smallest id, that row's locator and a count,
so that later files of a growing table meet all earlier ones. Where a digest was hit more than once, the full
bytes are compared: the row that the locator names is the content the others have to equal, and a text that
only shares the digest becomes a group of its own.

Defined results: a null text counts as empty, a null id comes after all others, and of rows with the same id
the one first in (file, place) stays. An empty table gives an empty result.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.llm.stores import FILE, ROW, broadcast_rows, located, shared_folder, stored

GROUPS = "key binary, first struct<absent: boolean, id: long, file: string, row: long>, n long"
KEY_BYTES = 32
BROADCAST_ROWS = 1_000_000
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every partition reserves megabytes
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
}


def normalised(text: F.Column) -> F.Column:
    """Every run of white space as one space; a single space is one already."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ingest(spark: SparkSession, rows: str, state: str, groups: str) -> None:
    """Streams the digest rows in folder `rows` that the state in folder `state` has not seen through the
    state; each batch's changed groups replace what a failed run of the same batch wrote in `groups`."""
    schema = spark.read.parquet(rows).schema
    first = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "file", "row"))
    changed = (spark.readStream.schema(schema).parquet(rows)
               .groupBy("key").agg(first.alias("first"), F.count(F.lit(1)).alias("n")))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{groups}/batch={number}")
    with settings(spark, STATE):
        query = (changed.writeStream.outputMode("update").option("checkpointLocation", state)
                 .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()


def latest(spark: SparkSession, groups: str) -> DataFrame:
    """Every group as its last change left it; counts only grow."""
    written = spark.read.schema(GROUPS).option("basePath", groups).parquet(groups)
    return written.groupBy("key").agg(F.max(F.struct("n", "first")).alias("_g")).select("key", "_g.first", "_g.n")


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                key_bytes: int = KEY_BYTES) -> DataFrame:
    """One row per document: `id`, `keep_id`, `group_size`, `kept`, `text_sha256`, and its locator. The ids
    are integers. `key_bytes` is how much of the digest keys the state."""
    spark = docs.sparkSession
    source = located(docs.select(id_col, text_col))
    texts = source.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("text"),
                          F.col(FILE).alias("file"), F.col(ROW).alias("row"))
    sha = F.unhex(F.sha2("text", 256))
    folder = shared_folder(spark)
    texts.select("id", "file", "row", sha.alias("sha")).withColumn("key", F.substring("sha", 1, key_bytes)) \
        .write.parquet(f"{folder}/rows")
    spark.createDataFrame([], GROUPS).write.parquet(f"{folder}/groups/batch=-1")  # if there are no rows
    ingest(spark, f"{folder}/rows", f"{folder}/state", f"{folder}/groups")
    rows = spark.read.parquet(f"{folder}/rows")
    groups = stored(latest(spark, f"{folder}/groups"))
    found = rows.join(groups, "key", "left").select("id", "file", "row", "sha", "first", "n")

    hits = broadcast_rows(groups.filter("n > 1").select("key", "first"), BROADCAST_ROWS)
    copies = (texts.withColumn("key", F.substring(F.unhex(F.sha2("text", 256)), 1, key_bytes)).join(hits, "key"))
    own = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "file", "row"))
    held = F.max((F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row")))
    contents = copies.groupBy("key", "text").agg(own.alias("own"), F.count(F.lit(1)).alias("size"), held.alias("held"))
    others = stored(contents.filter("NOT held").drop("held"))
    if others.take(1):  # digests that different texts share: those texts are grouped by their bytes
        strayed = stored(copies.join(others, ["key", "text"]).select("file", "row", "own", "size"))
        taken = others.groupBy("key").agg(F.sum("size").alias("taken"))
        found = (rows.join(groups, "key", "left").join(taken, "key", "left")
                 .withColumn("n", F.col("n") - F.coalesce("taken", F.lit(0)))
                 .join(strayed, ["file", "row"], "left")
                 .select("id", "file", "row", "sha", F.coalesce("own", "first").alias("first"),
                         F.coalesce("size", "n").alias("n")))
    kept = (F.col("file") == F.col("first.file")) & (F.col("row") == F.col("first.row"))
    return found.select("id", F.col("first.id").alias("keep_id"), F.col("n").alias("group_size"),
                        kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
                        F.col("file").alias(FILE), F.col("row").alias(ROW))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without copies, all columns as they were."""
    source = located(docs)
    dropped = find_copies(source.drop(FILE, ROW), id_col, text_col).filter("NOT kept").select(FILE, ROW)
    dropped = broadcast_rows(stored(dropped), BROADCAST_ROWS)
    return source.join(dropped, [FILE, ROW], "left_anti").select(*docs.columns)
