"""S6. The training view's features on live readings.

Row frames do not run on streams, so the last nine readings of a device are kept as state. A device's
new readings come to one task, as their order matters; how many come at once is bounded by the source's
flow control. A reading older than the last one seen is scored against the kept readings but not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = (
    "device_id string, timestamp timestamp, temperature double, vibration double, temp_change double, "
    "vibration_change double, temp_avg_5min double, vibration_avg_5min double, "
    "temp_stddev_10min double, vibration_stddev_10min double"
)
STATE = "newest timestamp, temperature array<double>, vibration array<double>"
KEPT = 9


def _deviation(rows: np.ndarray) -> np.ndarray:
    known = np.isfinite(rows)
    n = known.sum(axis=1)
    filled = np.where(known, rows, 0.0)
    mean = filled.sum(axis=1) / np.maximum(n, 1)
    squares = np.where(known, (rows - mean[:, None]) ** 2, 0.0).sum(axis=1)
    return np.where(n > 1, np.sqrt(squares / np.maximum(n - 1, 1)), np.nan)


def _mean(rows: np.ndarray) -> np.ndarray:
    known = np.isfinite(rows)
    n = known.sum(axis=1)
    return np.where(n > 0, np.where(known, rows, 0.0).sum(axis=1) / np.maximum(n, 1), np.nan)


def _frames(kept: list[float], new: np.ndarray, in_order: bool) -> np.ndarray:
    """Ten readings ending at each new one; NaN before a device's first."""
    lead = np.full(KEPT, np.nan)
    if kept:
        lead[-len(kept):] = kept
    if in_order:
        return np.lib.stride_tricks.sliding_window_view(np.concatenate([lead, new]), KEPT + 1)
    return np.column_stack([np.tile(lead, (len(new), 1)), new])


def score_frames(rows: pd.DataFrame, kept: dict[str, list[float]], in_order: bool) -> pd.DataFrame:
    return scored(rows, {c: _frames(kept[c], rows[c].to_numpy(dtype=float), in_order) for c in ("temperature", "vibration")})


def scored(rows: pd.DataFrame, frames_of: dict[str, np.ndarray]) -> pd.DataFrame:
    """Readings with the features of their frames: a line of KEPT + 1 values each, NaN before a device's first."""
    out = rows[["device_id", "timestamp", "temperature", "vibration"]].copy()
    for short, name in (("temp", "temperature"), ("vibration", "vibration")):
        frames = frames_of[name]
        out[f"{short}_change"] = frames[:, -1] - frames[:, -2]
        out[f"{short}_avg_5min"] = _mean(frames[:, -5:])
        out[f"{short}_stddev_10min"] = _deviation(frames)
    return out[[c.strip().split(" ")[0] for c in OUTPUT.split(",")]]


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    newest, kept = None, {"temperature": [], "vibration": []}
    if state.exists:
        newest, kept["temperature"], kept["vibration"] = state.get
        kept = {c: list(v) for c, v in kept.items()}
    rows = pd.concat([b for b in batches if len(b)]).sort_values("timestamp", kind="stable")
    if newest is not None:
        late = rows["timestamp"] <= pd.Timestamp(newest)
        if late.any():
            yield score_frames(rows[late], kept, in_order=False)
        rows = rows[~late]
    if len(rows):
        yield score_frames(rows, kept, in_order=True)
        for c in kept:
            kept[c] = [float(x) for x in (kept[c] + rows[c].tolist())[-KEPT:]]
        state.update((rows["timestamp"].iloc[-1].to_pydatetime(), kept["temperature"], kept["vibration"]))


def stream_features(stream: DataFrame) -> DataFrame:
    """device_id, timestamp, temperature and vibration in; these and the six features out."""
    narrow = stream.select("device_id", "timestamp", "temperature", "vibration")
    return narrow.groupBy("device_id").applyInPandasWithState(
        _update, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)
