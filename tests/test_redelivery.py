"""Redelivered, late and failing messages."""

import json
import os
import time

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kelvibra.sources.messages import message_stream
from kelvibra.streaming import jobs
from kelvibra.streaming.redelivery import Redelivery, deliver, readable


def message(device, minute, temperature=20.0, day=1):
    return json.dumps({"device_id": device, "timestamp": f"2024-01-{day:02d}T{minute // 60:02d}:{minute % 60:02d}:00",
                       "device_type": "hvac_monitor", "sensor_data": {"temperature": temperature, "vibration": 1.0}})


def until(condition, seconds=90):
    end = time.time() + seconds
    while not condition():
        assert time.time() < end, "nothing came in time"
        time.sleep(0.3)


@pytest.fixture()
def inbox(spark, tmp_path):
    path = str(tmp_path / "in")

    def add(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path, add


@pytest.fixture(autouse=True)
def one_partition(spark):
    """Each partition of state starts a worker in each batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_back_off():
    rules = Redelivery()
    assert [rules.wait(a) for a in range(1, 9)] == [10_000, 20_000, 40_000, 80_000, 160_000, 320_000, 600_000, 600_000]
    assert readable(pd.Series(['{"a": 1}', "[1]", "{", "", None])).tolist() == [True, False, False, False, False]

    def broken(_):
        raise RuntimeError
    assert Redelivery(broken).handled(["a", "b"]) == [False, False]


def test_copies_failures_and_late_messages(spark, tmp_path, inbox):
    path, add = inbox
    open_now = str(tmp_path / "open")

    def handle(raw):
        return raw.map(lambda text: "poison" not in text and ("flaky" not in text or os.path.exists(open_now)))
    rules = Redelivery(handle, attempts=3, shortest=3.0, longest=4.0, delay="10 minutes", groups=3)
    good, flaky, poison = message("good", 0), message("flaky", 1), message("poison", 2)
    add(good, good, flaky, poison)
    given = deliver(message_stream(spark, "text", path), rules)
    query = given.writeStream.format("memory").queryName("deliveries").option("checkpointLocation", str(tmp_path / "state")) \
        .trigger(processingTime="200 milliseconds").start()
    found = lambda: {(json.loads(r["raw"])["device_id"], r["attempt"], r["outcome"])
                     for r in spark.table("deliveries").collect()}
    try:
        until(lambda: ("good", 1, "delivered") in found())
        add(good, message("newer", 300))  # a copy in a later batch; the watermark goes on to 04:50
        until(lambda: ("newer", 1, "delivered") in found())
        open(open_now, "w").close()
        until(lambda: any(d == "flaky" for d, *_ in found()) and any(d == "poison" for d, *_ in found()))
        add(good, flaky, poison, message("behind", 5), message("also newer", 301))
        until(lambda: ("also newer", 1, "delivered") in found() and any(d == "behind" for d, *_ in found()))
    finally:
        query.stop()
    rows = spark.table("deliveries").collect()
    assert len(rows) == len(found()) == 6  # each once
    assert {("good", 1, "delivered"), ("newer", 1, "delivered"), ("also newer", 1, "delivered"), ("poison", 3, "dead_letter"),
            ("behind", 0, "late")} < found()
    assert next(r for r in rows if "flaky" in r["raw"])["outcome"] == "delivered"
    assert next(r for r in rows if "flaky" in r["raw"])["attempt"] in (2, 3)


def rows_of(spark, path):
    try:
        return spark.read.parquet(path).collect()
    except AnalysisException:  # nothing is written yet
        return []


FAST = {"processingTime": "200 milliseconds"}


def test_detection_with_redelivery_goes_on_after_a_restart(spark, tmp_path, inbox):
    path, add = inbox
    rules = Redelivery(attempts=1, groups=2)
    table, alerts, rejects, state = (str(tmp_path / n) for n in ("t", "a", "r", "s"))
    hot = message("hot", 0, 50.0)
    add(hot)
    with pytest.raises(ValueError, match="goes on"):
        jobs.run_detection(message_stream(spark, "text", path), table, alerts, rejects, state,
                           redelivery=rules, availableNow=True)

    def run(last):
        query = jobs.run_detection(message_stream(spark, "text", path), table, alerts, rejects, state, redelivery=rules, **FAST)
        try:
            until(lambda: any(r["device_id"] == last for r in rows_of(spark, table)))
        finally:
            query.stop()
        assert query.exception() is None
    add(hot, hot, message("fine", 1), "{broken", "{broken")
    run("fine")
    add(hot, message("fine", 1), "{broken", message("new", 2))  # all but one come again
    run("new")
    assert sorted(r["device_id"] for r in rows_of(spark, table)) == ["fine", "hot", "new"]
    assert spark.read.text(alerts).count() == 1
    assert [(r["raw"], r["reject_reason"]) for r in rows_of(spark, rejects)] == [("{broken", "dead_letter")]


def test_scoring_with_redelivery(spark, tmp_path, inbox):
    path, add = inbox
    add(message("a", 0), message("a", 0), "{broken", message("b", 1))
    table = str(tmp_path / "t")
    query = jobs.consume_and_score(message_stream(spark, "text", path), table, str(tmp_path / "s"),
                                   redelivery=Redelivery(attempts=1, groups=2), **FAST)
    try:
        until(lambda: len(rows_of(spark, table)) >= 3)
    finally:
        query.stop()
    rows = spark.read.parquet(table)
    assert rows.count() == 3 and rows.filter("reject_reason = 'dead_letter' and anomaly_score is null").count() == 1
    assert rows.filter(F.col("reject_reason").isNull() & F.col("anomaly_score").isNotNull()).count() == 2
