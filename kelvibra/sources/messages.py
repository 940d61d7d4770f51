"""Messages in, alerts out: files of JSON lines, or a Kafka topic where the connector is installed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def message_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                   **options: str) -> DataFrame:
    """A1. Unbounded messages as one column `raw`. Flow control is the source's: maxFilesPerTrigger for
    files, maxOffsetsPerTrigger for Kafka; progress is kept in the query's checkpoint."""
    reader = spark.readStream.format(fmt).options(**options)
    messages = reader.load(path) if path else reader.load()
    return messages.select(F.col("value").cast("string").alias("raw"))


def message_batch(spark: SparkSession, path: str, fmt: str = "text", **options: str) -> DataFrame:
    """A2. The same, bounded."""
    return spark.read.format(fmt).options(**options).load(path).select(
        F.col("value").cast("string").alias("raw"))


def alert_values(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON, one column `value`."""
    return alerts.select(F.to_json(F.struct("*")).alias("value"))


def publish_alerts(alerts: DataFrame, path: str | None = None, fmt: str = "text", mode: str = "append",
                   checkpoint: str | None = None, **options: str):
    """A6. Alerts as JSON strings to files or a topic. A stream needs a checkpoint; its started query
    is returned."""
    values = alert_values(alerts)
    if values.isStreaming:
        writer = values.writeStream.format(fmt).options(**options) \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return writer.start(path) if path else writer.start()
    writer = values.write.format(fmt).mode(mode).options(**options)
    return writer.save(path) if path else writer.save()
