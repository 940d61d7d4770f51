"""Messages to records: parse, validate, set aside what cannot be used."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvibra.settings import MESSAGE_SCHEMA, REQUIRED_FIELDS, WIDE_MESSAGE_SCHEMA

_BAD = "_bad"


def _read_json(raw: DataFrame, schema: str) -> DataFrame:
    """raw and the schema's fields. As a generator the parser runs once per message: a filter on its
    result is not pushed below it, which would parse again."""
    message = F.from_json("raw", f"{schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD})
    return raw.select("raw", F.inline_outer(F.array(message)))


def _reject_reason(message: DataFrame, required: dict[str, Column], instant: Column,
                   lenient: bool = False) -> Column:
    """First reason not to use a message, or null. A wrong type damages one field; broken JSON all. A lenient
    reader rejects a wrong type only if it cost a required value."""
    fields = [c for c in message.columns if c not in ("raw", _BAD)]
    nothing = F.coalesce(*[F.col(c).cast("string") for c in fields]).isNull()
    blank = F.coalesce(F.trim("raw"), F.lit("")) == ""
    damaged = F.col(_BAD).isNotNull()
    reason = F.when(blank | (damaged & nothing), F.lit("malformed_json"))
    lost = reduce(lambda a, b: a | b, [v.isNull() for v in required.values()]) if lenient else F.lit(True)
    reason = reason.when(damaged & lost, F.lit("bad_type"))
    for name, value in required.items():
        reason = reason.when(value.isNull(), F.lit(f"missing_{name}"))
    return reason.when(instant.isNull(), F.lit("bad_timestamp"))


def parse_messages(raw: DataFrame) -> DataFrame:
    """B1. One row per message (column `raw`): the flattened record and `reject_reason`, null when the
    message can be used. Text timestamps become instants; the text is kept for alert ids."""
    message = _read_json(raw, MESSAGE_SCHEMA)
    instant = F.col("timestamp").try_cast("timestamp")
    fields = {
        "device_id": F.col("device_id"),
        "timestamp": F.col("timestamp"),
        "temperature": F.col("sensor_data.temperature"),
        "vibration": F.col("sensor_data.vibration"),
    }
    reason = _reject_reason(message, {name: fields[name] for name in REQUIRED_FIELDS}, instant, lenient=True)
    return message.select(
        "raw",
        "device_id",
        instant.alias("timestamp"),
        F.col("timestamp").alias("timestamp_text"),
        "location",
        "device_type",
        fields["temperature"].alias("temperature"),
        fields["vibration"].alias("vibration"),
        F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"),
        reason.alias("reject_reason"),
    )


def parse_wide_messages(raw: DataFrame) -> DataFrame:
    """Flat messages of the rule consumer. Only unreadable ones are rejected: missing readings have
    defaults in the rule score."""
    message = _read_json(raw, WIDE_MESSAGE_SCHEMA)
    instant = F.col("timestamp").try_cast("timestamp")
    reason = _reject_reason(message, {c: F.col(c) for c in ("device_id", "timestamp")}, instant)
    values = {"timestamp": instant, "is_anomaly": F.coalesce("is_anomaly", F.lit(False))}
    kept = [values.get(c, F.col(c)).alias(c) for c in message.columns if c != _BAD]
    return message.select(*kept, reason.alias("reject_reason"))


def validate_required(parsed: DataFrame) -> DataFrame:
    """B2. Usable records only."""
    return parsed.filter(F.col("reject_reason").isNull()).drop("raw", "reject_reason")


def quarantine(parsed: DataFrame) -> DataFrame:
    """A12. The others, with the reason."""
    return parsed.filter(F.col("reject_reason").isNotNull()).select("raw", "reject_reason")
