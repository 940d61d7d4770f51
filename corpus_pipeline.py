"""The corpus pipeline: quality classifier, exact and near dedup, benchmark decontamination, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.llm import decontamination, exact, minhash, pieces, quality
from kelvibra.llm import settings as S
from kelvibra.llm.stores import read_table, remainder, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled documents of this input, does not reject."""
    labels = read_table(spark, sf_dir, "labels").filter(remainder("doc_id", 3) != 1)
    return docs.filter(quality.score(quality.fit(docs, labels), "text") >= 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return minhash.deduplicated(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its ids and the source bytes its pieces cover, digested. The workers, which serve the
    other stages too, forget words after each task."""
    return docs.select("doc_id", pieces.digests(S.PIECE_MODEL, keep=False).alias("_d")).select("doc_id", "_d.*")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("sentencepiece", encode),
]

# models decide in it, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each but the last is written before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
