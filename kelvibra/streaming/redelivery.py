"""S4. Delivery with attempts: a message that cannot be handled comes again later, and after some attempts goes to the
dead letters.

Messages are dealt by a hash of their id, so that a busy device is spread and the copies of a message still meet. State is
kept per message, on disk by RocksDB: what was delivered is remembered for a while, so that a redelivered copy is dropped;
what failed waits with its payload and number of attempts for its timer, 10 seconds after the first failure, then twice as
long each time up to 600. A message older than the stream's watermark is not handled; it is given out as late, not lost.

Every message leaves exactly once as `delivered`, `dead_letter` or `late`. Attempts are made while rows or timers are worked
on; if a task is repeated, so are its attempts, but state and output change once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

OUTPUT = "id string, raw string, attempt int, outcome string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
AT_ONCE = 1_000  # waiting messages that are held in memory at once


def readable(raw: pd.Series) -> pd.Series:
    """Whether a message is a JSON object."""
    def one(text: str | None) -> bool:
        try:
            return isinstance(json.loads(text or ""), dict)
        except ValueError:
            return False
    return raw.map(one).astype(bool)


@dataclass(frozen=True)
class Redelivery:
    """How often and when a message is tried (seconds), how long it is remembered, how late it may come, and into how
    many groups messages are dealt. `handle` takes messages and says which it could deal with; an error of its own fails
    all that it was given."""
    handle: Callable[[pd.Series], pd.Series] = readable
    attempts: int = 5
    shortest: float = 10.0
    longest: float = 600.0
    remembered: float = 86_400.0
    delay: str = "10 minutes"
    groups: int = 64

    def wait(self, attempt: int) -> int:
        """Milliseconds after a failed attempt."""
        return int(1000 * min(self.longest, self.shortest * 2 ** (attempt - 1)))

    def handled(self, raw: list[str]) -> list[bool]:
        try:
            return [bool(x) for x in self.handle(pd.Series(raw, dtype=object))]
        except Exception:  # noqa: BLE001  # whatever it is, the messages come again
            return [False] * len(raw)


class _Deliveries(StatefulProcessor):
    def __init__(self, rules: Redelivery):
        self.rules = rules

    def init(self, handle) -> None:
        self.handle = handle
        self.done = handle.getMapState("done", "id string", "attempt int", int(1000 * self.rules.remembered))
        self.waiting = handle.getMapState("waiting", "id string", "attempt int, due bigint, raw string")

    def _tried(self, rows: list[tuple[str, str, int]], now: int) -> pd.DataFrame:
        """(id, raw, attempt) once more; what fails waits, or is given up."""
        out = []
        for (key, raw, attempt), ok in zip(rows, self.rules.handled([r[1] for r in rows])):
            if ok or attempt >= self.rules.attempts:
                out.append((key, raw, attempt, "delivered" if ok else "dead_letter"))
                self.done.updateValue((key,), (attempt,))
                if attempt > 1:
                    self.waiting.removeKey((key,))
            else:
                due = now + self.rules.wait(attempt)
                self.waiting.updateValue((key,), (attempt, due, raw))
                self.handle.registerTimer(due)
        return _frame(out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now, watermark = timerValues.getCurrentProcessingTimeInMs(), timerValues.getCurrentWatermarkInMs()
        for batch in rows:
            new, late = [], []
            for name, raw, at in batch[["id", "raw", "at"]].drop_duplicates("id").itertuples(index=False):
                if self.done.containsKey((name,)) or self.waiting.containsKey((name,)):
                    continue
                if not pd.isna(at) and at < watermark:
                    late.append((name, raw, 0, "late"))
                    self.done.updateValue((name,), (0,))
                else:
                    new.append((name, raw, 1))
            if late:
                yield _frame(late)
            if new:
                yield self._tried(new, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = max(timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs())
        due = [k[0] for k, v in self.waiting.iterator() if v[1] <= expiredTimerInfo.getExpiryTimeInMs()]
        for at in range(0, len(due), AT_ONCE):
            held = [(k, *self.waiting.getValue((k,))) for k in due[at:at + AT_ONCE]]
            yield self._tried([(k, raw, attempt + 1) for k, attempt, _, raw in held], now)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["id", "raw", "attempt", "outcome"]).astype({"attempt": "int32"})


def keep_state_on_disk(spark: SparkSession) -> None:
    """Named state needs RocksDB; a session that already names a provider of its own keeps it."""
    if "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def deliver(messages: DataFrame, rules: Redelivery = Redelivery(), id_col: str | None = None) -> DataFrame:
    """S4. A stream of messages (`raw`) as id, raw, attempt and outcome. Without an id column, equal messages are copies
    of one. The event time is the message's `timestamp`; a message without one is never late. A null message counts as an
    empty one."""
    keep_state_on_disk(messages.sparkSession)
    raw = F.coalesce("raw", F.lit(""))
    name = F.sha2(raw, 256) if id_col is None else F.coalesce(F.col(id_col).cast("string"), F.sha2(raw, 256))
    at = F.get_json_object("raw", "$.timestamp").try_cast("timestamp")
    rows = messages.select(name.alias("id"), raw.alias("raw"), at.alias("event_time")).withWatermark("event_time", rules.delay)
    dealt = rows.select("id", "raw", "event_time", F.expr("unix_millis(event_time)").cast("double").alias("at"),
                        F.pmod(F.xxhash64("id"), F.lit(rules.groups)).alias("group"))
    return dealt.groupBy("group").transformWithStateInPandas(_Deliveries(rules), OUTPUT, "Append", "ProcessingTime")
