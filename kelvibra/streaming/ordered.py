"""S6 in event order. The training view's features on readings that arrive in any order.

Devices are dealt into GROUPS groups by a hash. A group's readings wait on disk (RocksDB), in buckets of `width` seconds, until
the watermark has passed their bucket; then the bucket is read, sorted by device and time, and given out in pieces of CHUNK
rows, each scored with the nine readings of its device before it. So there is one timer and one value per group and bucket,
however many devices there are. What a task holds at once is one bucket of one group, the last nine readings of the group's
devices and, of readings that come in, HELD rows, however much has come in at once or is waiting. Readings that come
after the watermark has passed them are left out; the query's progress counts them (numRowsDroppedByWatermark), and S4's
`deliver` gives them out as late. Readings of one instant are in order of their values. The state is not that of versions with
one key a device: their checkpoints cannot be gone on with.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from kelvibra.streaming.features import KEPT, OUTPUT, scored
from kelvibra.streaming.redelivery import keep_state_on_disk

CHUNK = 10_000
GROUPS = 128
HELD = 500_000
VALUES = ("temperature", "vibration")
ROW = np.dtype([("device", "<i8"), ("at", "<i8"), ("temperature", "<f8"), ("vibration", "<f8")])  # device: its place among the group's
NEVER = np.iinfo(np.int64).min  # the instant of a reading without one, which comes before all others


class _InOrder(StatefulProcessor):
    def __init__(self, width: int, chunk: int, held: int = HELD):
        self.width, self.chunk, self.held = width, chunk, held  # milliseconds, rows, rows

    def init(self, handle) -> None:
        self.handle = handle
        self.known = handle.getValueState("known", "devices string, kept binary")
        self.buckets = handle.getMapState("buckets", "bucket bigint", "rows binary")

    def _group(self) -> tuple[list[str | None], np.ndarray]:
        """The devices seen so far, and the last readings of each."""
        devices, kept = self.known.get() if self.known.exists() else ("[]", b"")
        return json.loads(devices), np.frombuffer(bytes(kept), ROW)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        devices, kept = self._group()
        places, size, waiting = {d: i for i, d in enumerate(devices)}, len(devices), []
        for batch in rows:
            # without a column of devices, the key is the device
            codes, found = pd.factorize(batch["device_id"] if "device_id" in batch else pd.Series([key[0]] * len(batch), dtype=object),
                                        use_na_sentinel=False)
            own = [places.setdefault(None if pd.isna(d) else d, len(places)) for d in found]
            packed = np.zeros(len(batch), ROW)
            packed["device"] = np.array(own, np.int64)[codes]
            packed["at"] = batch["at"].to_numpy()
            for c in VALUES:
                packed[c] = batch[c].to_numpy(dtype=float)
            waiting.append(packed)
            if sum(map(len, waiting)) >= self.held:
                self._wait(waiting)
                waiting = []
        self._wait(waiting)
        if len(places) > size:
            self.known.update((json.dumps(list(places)), kept.tobytes()))
        yield from ()

    def _wait(self, parts: list[np.ndarray]) -> None:
        """Puts readings to those that wait in their buckets."""
        rows = np.concatenate([np.zeros(0, ROW), *parts])
        buckets = rows["at"] // (self.width * 1000)
        order = np.argsort(buckets, kind="stable")
        found, starts = np.unique(buckets[order], return_index=True)
        for bucket, own in zip(found.tolist(), np.split(order, starts[1:])):
            known = self.buckets.containsKey((bucket,))
            before = self.buckets.getValue((bucket,))[0] if known else b""
            self.buckets.updateValue((bucket,), (bytes(before) + rows[own].tobytes(),))
            if not known:
                self.handle.registerTimer((bucket + 1) * self.width)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        bucket = expiredTimerInfo.getExpiryTimeInMs() // self.width - 1
        if not self.buckets.containsKey((bucket,)):
            return
        devices, kept = self._group()
        new = np.frombuffer(bytes(self.buckets.getValue((bucket,))[0]), ROW)
        new = new[np.lexsort([new[c] for c in reversed(ROW.names)])]
        active = np.isin(kept["device"], new["device"])
        rows = np.concatenate([kept[active], new])
        order = np.argsort(rows["device"], kind="stable")  # a device's kept readings, then its new ones
        rows, starts = rows[order], np.flatnonzero(np.diff(rows["device"][order], prepend=-1))
        sizes = np.diff(np.append(starts, len(rows)))
        place = np.arange(len(rows)) - np.repeat(starts, sizes)  # among the readings of its device
        names, ends = np.array(devices, dtype=object), np.flatnonzero(order >= active.sum())
        for at in range(0, len(ends), self.chunk):
            own = ends[at:at + self.chunk]
            part = rows[own]
            back = np.arange(-KEPT, 1)
            there = place[own][:, None] + back >= 0
            lines = np.where(there, own[:, None] + back, 0)
            frame = pd.DataFrame({"device_id": names[part["device"]], "timestamp": pd.to_datetime(part["at"], unit="us"),
                                  **{c: part[c] for c in VALUES}})
            yield scored(frame, {c: np.where(there, rows[c][lines], np.nan) for c in VALUES})
        last = rows[np.repeat(sizes, sizes) - place <= KEPT]
        self.known.update((json.dumps(devices), np.concatenate([kept[~active], last]).tobytes()))
        self.buckets.removeKey((bucket,))

    def close(self) -> None:
        pass


def ordered_features(stream: DataFrame, delay: str = "10 minutes", width: int = 60, chunk: int = CHUNK,
                     groups: int = GROUPS) -> DataFrame:
    """device_id, timestamp, temperature and vibration in; these and the six features out, once the watermark, which is
    `delay` behind the newest reading, has passed the reading's bucket of `width` seconds. `groups` stays as it is over the
    restarts of a query."""
    keep_state_on_disk(stream.sparkSession)
    rows = stream.select("device_id", "timestamp", *VALUES).withWatermark("timestamp", delay)
    dealt = rows.select(F.pmod(F.xxhash64("device_id"), F.lit(groups)).alias("group"), "device_id", "timestamp",
                        F.coalesce(F.unix_micros("timestamp"), F.lit(NEVER)).alias("at"), *VALUES)
    return dealt.groupBy("group").transformWithStateInPandas(_InOrder(width * 1000, chunk), OUTPUT, "Append", "EventTime")
