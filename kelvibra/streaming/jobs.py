"""Streaming jobs. Each batch is written under its query and number, so a replayed batch replaces itself."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kelvibra.operators.parsing import (parse_messages, parse_wide_messages, quarantine,
                                        validate_required)
from kelvibra.operators.rules import apply_rules, format_alert, format_reading, rule_score
from kelvibra.sources.messages import alert_values
from kelvibra.sources.tables import query_name, write_once
from kelvibra.streaming.redelivery import Redelivery, deliver


def _start(stream: DataFrame, work, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _start_delivered(stream: DataFrame, work, checkpoint: str, trigger: dict) -> StreamingQuery:
    """A query with redelivery goes on until it is stopped: its timers need batches without data, of which a query of
    what is available now would never see the last."""
    if "availableNow" in trigger or "once" in trigger:
        raise ValueError("redelivery needs a query that goes on, such as processingTime='10 seconds'")
    return _start(stream, work, checkpoint, trigger or {"processingTime": "10 seconds"})


def run_detection(messages: DataFrame, table: str, alerts: str, rejects: str, checkpoint: str,
                  redelivery: Redelivery | None = None, **trigger) -> StreamingQuery:
    """S1. Parse, rules, then readings, alerts and rejects from one parse of each batch. With `redelivery` (S4) copies
    are dropped, failing messages come again, and dead letters and late messages are rejects with that as their reason."""
    def work(batch: DataFrame, batch_id: int) -> None:
        query = query_name(batch.sparkSession, checkpoint)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        parsed = parse_messages(delivered(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ruled = apply_rules(validate_required(parsed))
            write_once(format_reading(ruled), table, batch_id, clustered=True, query=query)
            write_once(alert_values(format_alert(ruled)), alerts, batch_id, fmt="text", query=query)
            write_once(quarantine(parsed).unionByName(undelivered(batch)), rejects, batch_id, query=query)
        finally:
            parsed.unpersist()
            batch.unpersist()
    if redelivery is None:
        return _start(messages, work, checkpoint, trigger)
    return _start_delivered(deliver(messages, redelivery), work, checkpoint, trigger)


def delivered(batch: DataFrame) -> DataFrame:
    """The messages to work on: all, or those that redelivery gave out as delivered."""
    return batch.filter("outcome = 'delivered'").select("raw") if "outcome" in batch.columns else batch


def undelivered(batch: DataFrame) -> DataFrame:
    """The others, as rejects."""
    if "outcome" not in batch.columns:
        return batch.select("raw", F.lit("").alias("reject_reason")).limit(0)
    return batch.filter("outcome <> 'delivered'").select("raw", F.col("outcome").alias("reject_reason"))


def streaming_row_sink(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """A14. Appends a stream's rows to a table, once per batch."""
    def work(batch: DataFrame, batch_id: int) -> None:
        write_once(batch, path, batch_id, query=query_name(batch.sparkSession, checkpoint))
    return _start(rows, work, checkpoint, trigger)


def consume_and_score(messages: DataFrame, table: str, checkpoint: str, redelivery: Redelivery | None = None,
                      **trigger) -> StreamingQuery:
    """S2. Wide messages, rule score, table. Unreadable messages are kept with their reason and no
    score. With `redelivery` (S4) copies are dropped and failing messages come again; dead letters and late messages are
    kept as unreadable ones are."""
    if redelivery is None:
        return streaming_row_sink(_wide_scores(messages), table, checkpoint, **trigger)

    def work(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = _wide_scores(delivered(batch)).unionByName(undelivered(batch), allowMissingColumns=True)
            write_once(rows, table, batch_id, query=query_name(batch.sparkSession, checkpoint))
        finally:
            batch.unpersist()
    return _start_delivered(deliver(messages, redelivery), work, checkpoint, trigger)


def _wide_scores(messages: DataFrame) -> DataFrame:
    scored = rule_score(parse_wide_messages(messages)).withColumn("processed_at", F.current_timestamp())
    usable = F.col("reject_reason").isNull()
    return scored.withColumns({c: F.when(usable, F.col(c)) for c in ("anomaly_score", "rule_based_anomaly")})


def anomaly_subscription(rows: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """A13. Flagged rows only."""
    return rows.filter(F.coalesce(F.col(flag), F.lit(False)))


def alert_lines(rows: DataFrame) -> DataFrame:
    """S5. One warning line per flagged row: device, score, time."""
    score = F.coalesce(F.col("anomaly_score"), F.lit(0.0))
    return anomaly_subscription(rows).select(
        F.lit("WARNING").alias("level"), "device_id", score.alias("anomaly_score"), "timestamp",
        F.concat(F.lit("Anomaly detected: Device "), "device_id", F.lit(", Score: "),
                 score.cast("string"), F.lit(", Time: "), F.col("timestamp").cast("string")).alias("line"))


def alert_handler(rows: DataFrame, log_table: str, checkpoint: str, **trigger) -> StreamingQuery:
    """S5. Writes the warning lines to a log table."""
    return streaming_row_sink(alert_lines(rows), log_table, checkpoint, **trigger)


def replay_safe_ingest(records: DataFrame, delay: str = "10 minutes", salts: int = 1) -> DataFrame:
    """S4. Drops redelivered records (same device and instant) that arrive within `delay` of the first.
    State is dropped as the watermark passes, so it does not grow with the stream. With salts > 1 the
    copies of one record are first reduced in that many groups, so that a record repeated very often
    does not go to one task whole."""
    key = ["device_id", "timestamp"]
    marked = records.withWatermark("timestamp", delay)
    if salts > 1:
        marked = (marked.withColumn("_salt", F.floor(F.rand(7) * salts))
                  .dropDuplicatesWithinWatermark([*key, "_salt"]).drop("_salt"))
    return marked.dropDuplicatesWithinWatermark(key)
