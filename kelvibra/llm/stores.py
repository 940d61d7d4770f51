"""Tables that an operator writes between its jobs, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra.llm.settings import BATCH_ROWS


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path below spark.checkpoint.dir. Where that is unset, a local session takes a
    temporary folder; a cluster must name one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith(("local[", "local")) or context.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(named)
    return f"{context.getCheckpointDir()}/{uuid.uuid4().hex}"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the input. Rows of texts are large, so that batches for Python workers are kept small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once as Parquet and read back: no lineage is left, columns can be pruned, and
    lost executors take nothing with them."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remainder(column: str, divisor: int) -> F.Column:
    """crc32 of a column's text modulo a divisor; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


FILE, ROW = "_llm_file", "_llm_row"


def located(docs: DataFrame) -> DataFrame:
    """The rows with the file and the place in it that each comes from. Rows that are no plain file scan are
    written to the shared folder first."""
    place = (F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return stored(docs).select("*", *place)


def broadcast_rows(df: DataFrame, rows: int) -> DataFrame:
    """Marks a table of fixed-width rows for broadcast if it has at most `rows` of them; a longer one is left
    to Spark's joins."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
