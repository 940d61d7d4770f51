"""Tables, views and exports."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelvibra import settings as S
from kelvibra.sources.summaries import append_summaries

CLUSTERING = ("device_id", "device_type")
ROWS_PER_FILE = 5_000_000


def partition_and_cluster(df: DataFrame, path: str, mode: str = "append",
                          cluster_by=CLUSTERING, rows_per_file: int = ROWS_PER_FILE) -> None:
    """A4. One folder per day; within it files follow device and type, so that row-group statistics can
    skip. Rows are spread by ranges of day, device, type and time, not by day: neither a large day nor
    a busy device ends up in one task."""
    order = ["event_date", *[c for c in cluster_by if c in df.columns], "timestamp"]
    (df.withColumn("event_date", F.to_date("timestamp"))
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode(mode).option("maxRecordsPerFile", rows_per_file)
     .partitionBy("event_date").parquet(path))


def append_readings(readings: DataFrame, path: str, summaries: str | None = None) -> None:
    """A3. Appends stored readings (B9's columns); the table is created on the first call. With a path for summaries
    the batch's days are summarized there."""
    missing = set(S.READING_COLUMNS) - set(readings.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    partition_and_cluster(readings.select(*S.READING_COLUMNS), path)
    if summaries is not None:
        append_summaries(readings, summaries)


def conform(df: DataFrame) -> DataFrame:
    """Any reading layout as the superset table: absent columns are null, order and types are fixed."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in S.SENSOR_DATA])


def query_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream's checkpoint keeps over restarts; another checkpoint has another one."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def write_once(df: DataFrame, path: str, batch_id: int, clustered: bool = False,
               fmt: str = "parquet", query: str = "") -> None:
    """Writes a stream's batch under its query and number. A repeated batch replaces its own folder, so a
    replay leaves one copy; batches of other queries, which count from 0 as well, stay."""
    place = f"{path}/batch_id={query}-{batch_id}" if query else f"{path}/batch_id={batch_id}"
    if clustered:
        partition_and_cluster(df, place, mode="overwrite")
    else:
        df.write.mode("overwrite").format(fmt).save(place)


def materialize(df: DataFrame, table: str) -> DataFrame:
    """A7. Creates or replaces a table from a query and returns the table."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """A8. Creates or replaces a view; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_metrics(metrics: DataFrame, path: str, model_version: str = "1",
                   evaluated_at: Column | None = None, training_rows: int | None = None,
                   evaluation_rows: int | None = None) -> None:
    """A9. Appends D9's lines (one per model_name), stamped with version, time and sizes."""
    stamped = metrics.withColumns({
        "model_version": F.lit(model_version),
        "evaluation_timestamp": F.current_timestamp() if evaluated_at is None else evaluated_at,
        "training_data_size": F.lit(training_rows).cast("bigint"),
        "evaluation_data_size": F.lit(evaluation_rows).cast("bigint")})
    columns = [F.col(f.name).cast(f.dataType) if f.name in stamped.columns
               else F.lit(None).cast(f.dataType).alias(f.name) for f in S.MODEL_PERFORMANCE]
    stamped.select(*columns).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.MODEL_PERFORMANCE).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """A10. CSV with a header, one file per partition."""
    df.write.mode("overwrite").option("header", True).csv(path)
