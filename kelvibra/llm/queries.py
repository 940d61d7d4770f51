"""The registered queries of the text operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from kelvibra.llm import (decontamination, exact, gray, language, licenses, minhash, phrases, pieces, quality, scoring,
                          sharding, turns, urls)
from kelvibra.llm import settings as S
from kelvibra.llm.stores import read_table as table
from kelvibra.llm.stores import remainder, stored


def op1(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    network = quality.fit(docs, labels.filter(remainder("doc_id", 3) != 1))
    scored = docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"),
                         quality.score(network, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "text")
    return scoring.score(docs, docs.filter("NOT held_out"))


def op4(spark: SparkSession, sf: str) -> DataFrame:
    return exact.find_copies(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op5(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.find_near(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op6(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.interleave(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", pieces.digests(S.PIECE_MODEL).alias("_d")) \
        .select("doc_id", "_d.*")


def op8(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(table(spark, sf, "documents"), S.LICENSES).select(
        F.col("id").alias("doc_id"), "license", "containment")


def op9(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    hosts = stored(pages.select(urls.host(F.col("url")).alias("key")).distinct())
    names = F.regexp_extract("key", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    listed = hosts.filter(names.isin(*S.LISTED_DOMAINS))
    return urls.judge(pages, S.URL_RULES, listed).withColumnRenamed("id", "page_id")


def op10(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    profiles = language.learn(docs.filter(remainder("doc_id", 4) != 2))
    return docs.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"),
                       language.predict(profiles).alias("_p")).select("doc_id", "held_out", "_p.*")


def op11(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


def op12(spark: SparkSession, sf: str) -> DataFrame:
    return gray.find_near(table(spark, sf, "documents")).select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op13(spark: SparkSession, sf: str) -> DataFrame:
    return turns.repair(turns.damaged(table(spark, sf, "conversations"))).withColumnRenamed("conv", "conv_id")


def build() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_network": op1,
        "op2_simhash_windows": op2,
        "op3_bloom_lm": op3,
        "op4_exact_stream": op4,
        "op5_bbit_minhash": op5,
        "op6_interleaved_shards": op6,
        "op7_sentencepiece_spans": op7,
        "op8_license_bands": op8,
        "op9_url_cascade": op9,
        "op10_rank_order_profiles": op10,
        "op11_prefix_free_phrases": op11,
        "op12_gray_index": op12,
        "op13_turn_alignment": op13,
        "pipeline": corpus_pipeline.run,
    }
