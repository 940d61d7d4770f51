"""Cutting lineage: intermediate results that several jobs read are written once to shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

TASKS, TASK_ROWS = 8, 4_000_000


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the folder named by spark.checkpoint.dir. The blocks do not depend on
    executors, and later jobs read the written rows instead of computing them again. Where no folder
    is named, a local session uses a temporary one; a cluster must name one."""
    _folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """A new folder's path below the checkpoint folder, which all executors share."""
    return f"{_folder(spark)}/{uuid.uuid4().hex}"


def _folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keeps rows that the several passes of a fit read, for as long as the fit runs. Lost blocks are
    computed again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def spread(df: DataFrame, rows: int) -> DataFrame:
    """The rows in even partitions of at most TASK_ROWS, and at least TASKS of them: a table often sits in few
    files, which would keep few cores busy with Python work."""
    return df.repartition(max(TASKS, -(-rows // TASK_ROWS)))
