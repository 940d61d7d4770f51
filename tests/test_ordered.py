"""Features in event order against the view over the whole table."""

import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kelvibra import fixtures
from kelvibra.operators import features as W
from kelvibra.streaming import ordered
from kelvibra.streaming.jobs import streaming_row_sink
from tests.helpers import same_rows

FEATURES = ["device_id", "timestamp", "temperature", "vibration", "temp_change", "vibration_change",
            "temp_avg_5min", "vibration_avg_5min", "temp_stddev_10min", "vibration_stddev_10min"]


@pytest.fixture(autouse=True)
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shuffled_arrival_equals_the_view(spark, sf, tmp_path):
    rows = fixtures.readings(spark, sf).filter("device_id < 'sensor_0006'").select(
        "device_id", F.col("timestamp").cast("timestamp").alias("timestamp"), "temperature", "vibration")
    path = str(tmp_path / "in")
    for part in range(3):  # every file holds readings of all times
        rows.filter(F.pmod(F.xxhash64("device_id", "timestamp"), F.lit(3)) == part).orderBy(F.rand(1)).coalesce(1) \
            .write.mode("append").parquet(path)
        time.sleep(0.05)
    end = rows.agg(F.max("timestamp")).first()[0] + dt.timedelta(days=90)
    spark.createDataFrame([("end", end, 1.0, 1.0)], rows.schema).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "1").parquet(path)
    table = str(tmp_path / "out")
    query = streaming_row_sink(ordered.ordered_features(stream, "60 days", width=86_400, chunk=3), table, str(tmp_path / "state"))
    query.awaitTermination(150)
    assert not query.isActive and query.exception() is None
    found = spark.read.parquet(table).drop("batch_id")
    found = found.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, kind in found.dtypes if kind == "double"})
    want = W.training_view(rows.withColumnRenamed("vibration", "vibration_level").withColumns(
        {"device_type": F.lit("x"), "is_anomaly": F.lit(False)}), days=60)
    same_rows(found.select(*FEATURES), want.select(*FEATURES), digits=6)


class Memory:
    """State in a dictionary, which counts what is read at once."""

    def __init__(self):
        self.maps, self.timers, self.largest, self.value = {}, set(), 0, None

    def getValueState(self, *_):
        return self

    def getMapState(self, *_):
        return self

    def registerTimer(self, at):
        self.timers.add(at)

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def containsKey(self, key):
        return key in self.maps

    def getValue(self, key):
        self.largest = max(self.largest, len(self.maps[key][0]) // ordered.ROW.itemsize)
        return self.maps[key]

    def updateValue(self, key, value):
        self.maps[key] = value

    def removeKey(self, key):
        del self.maps[key]


class Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def test_a_backlog_is_held_by_the_bucket():
    """Fifty thousand readings of one device, shuffled: no more than a bucket is read, no more than a chunk given out."""
    rng = np.random.default_rng(1)
    size = 50_000
    rows = pd.DataFrame({"at": rng.permutation(size) * 1_000_000, "temperature": rng.normal(size=size), "vibration": rng.normal(size=size)})
    memory, work = Memory(), ordered._InOrder(60_000, 25)
    work.init(memory)
    assert list(work.handleInputRows(("d",), iter([rows[:30_000], rows[30_000:]]), None)) == []
    out = [f for at in sorted(memory.timers) for f in work.handleExpiredTimer(("d",), None, Expired(at))]
    assert memory.largest <= 60 and max(map(len, out)) <= 25 and not memory.maps
    found = pd.concat(out)
    plain = rows.sort_values("at")
    np.testing.assert_allclose(found["temp_avg_5min"], plain["temperature"].rolling(5, min_periods=1).mean(), atol=1e-9)
    np.testing.assert_allclose(found["vibration_stddev_10min"], plain["vibration"].rolling(10, min_periods=1).std(), atol=1e-9)
    np.testing.assert_allclose(found["temp_change"], plain["temperature"].diff(), atol=1e-12)


def test_devices_of_a_group_share_their_timers():
    """Three hundred devices over four buckets: a timer and a value per bucket, not per device, and the same features as one
    device at a time. A reading without an instant comes first."""
    rng = np.random.default_rng(2)
    size, names = 6_000, [f"d{i}" for i in range(299)] + [None]
    rows = pd.DataFrame({"device_id": [names[i] for i in rng.integers(0, 300, size)], "at": rng.permutation(size) * 40_000,
                         "temperature": rng.normal(size=size), "vibration": rng.normal(size=size)})
    rows.loc[rng.integers(0, size, 500), "vibration"] = np.nan
    rows.loc[17, "at"] = ordered.NEVER
    memory, work = Memory(), ordered._InOrder(60_000, 1_000, held=900)
    work.init(memory)
    assert list(work.handleInputRows((3,), iter([rows[i:i + 500] for i in range(0, size, 500)]), None)) == []
    assert len(memory.timers) == len(memory.maps) == 5
    out = [f for at in sorted(memory.timers) for f in work.handleExpiredTimer((3,), None, Expired(at))]
    assert len(out) == 9 and max(map(len, out)) <= 1_000 and not memory.maps
    found = pd.concat(out).fillna({"device_id": "none"}).reset_index(drop=True)
    assert len(found) == size and found["timestamp"].isna().sum() == 1
    for device, own in rows.sort_values("at").fillna({"device_id": "none"}).groupby("device_id"):
        got = found[found["device_id"] == device]
        np.testing.assert_array_equal(got["temperature"], own["temperature"])
        np.testing.assert_allclose(got["temp_change"], own["temperature"].diff(), atol=1e-12)
        np.testing.assert_allclose(got["vibration_avg_5min"], own["vibration"].rolling(5, min_periods=1).mean(), atol=1e-9)
        np.testing.assert_allclose(got["temp_stddev_10min"], own["temperature"].rolling(10, min_periods=1).std(), atol=1e-9)
