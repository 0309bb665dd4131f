"""A stalled pipeline is told from a quiet log, in batch and live."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from settle.operators import alarms
from settle.plans import tables
from settle.schema import ALARMS, HEALTH
from settle.streaming import watch

DAY = date(2024, 1, 1)
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
BASE = int(START.timestamp()) * 1_000_000
HEALTH_ROW = "window_end timestamp, max_observed_time timestamp, events bigint, emitted_at timestamp"


def health(spark, *ends):
    rows = [(START + timedelta(seconds=e), START, 1, START + timedelta(seconds=e + 8)) for e in ends]
    return spark.createDataFrame(rows, HEALTH_ROW)


@pytest.mark.parametrize(
    ("closed", "heard", "status"),
    [(600, 650, "ok"), (561, 100, "ok"), (560, 650, "ok"), (559, 650, "stalled"), (None, 650, "stalled"),
     (559, 580, "stalled"), (559, 579, "quiet"), (None, None, "quiet"), (100, None, "quiet")],
)
def test_status(spark, closed, heard, status):
    row = spark.createDataFrame([(700, closed, heard)], "now long, closed long, heard long")
    us = [F.col(c) * 1_000_000 for c in ("now", "closed", "heard")]
    assert row.select(alarms.status_of(*us)).first()[0] == status


def test_history_by_its_definition(spark):
    heard = [5, 61, 130, 200, 270, 700, 761]
    ends = [60, 120, 180, 660]
    arrivals = spark.createDataFrame([(BASE + s * 1_000_000,) for s in heard], "arrival_us long")
    found = alarms.alarm_history(arrivals, health(spark, *ends)).orderBy("now_us").collect()
    assert [(r.now_us - BASE) // 60_000_000 for r in found] == list(range(1, 14))
    for r in found:
        now = (r.now_us - BASE) / 1e6
        last = max((s for s in heard if s < now), default=None)
        end = max((e for e in ends if e + 8 < now), default=None)
        fresh = end is not None and now - end <= alarms.FRESH_S
        quiet = last is None or now - last > alarms.QUIET_S
        assert r.status == ("ok" if fresh else "quiet" if quiet else "stalled"), now
    assert {r.status for r in found} == {"ok", "quiet", "stalled"}
    assert alarms.alarm_history(arrivals.limit(0), health(spark)).count() == 0


def test_the_live_alarm_speaks_while_nothing_arrives(spark, tmp_path):
    """Batches of ticks and messages at given seconds; health rows are written in between."""
    root = str(tmp_path)
    message, tick = (bytearray(b"{}"), 0, 1), (None, None, None)
    script = [
        (10, [tick, message], None, "stalled"),  # nothing has closed yet, but messages come
        (70, [message], [60], "ok"),
        (130, [tick], [120], "ok"),
        (261, [tick], None, "quiet"),  # the last message is 191 s old
        (300, [message, tick], None, "stalled"),  # they come again, and nothing closes
        (330, [message], [300], "ok"),
    ]
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "alarms")
    try:
        write = watch.publish_alarms(root, clock=lambda n: START.timestamp() + script[n][0])
        for number, (_, rows, closed, _) in enumerate(script):
            if closed:
                tables.write_batch(health(spark, *closed), HEALTH, root, "fast", number)
            for _ in range(2):  # a repeated batch says nothing twice
                write(spark.createDataFrame(rows, "value binary, partition int, offset long"), number)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    found = tables.read_table(spark, root, ALARMS, DAY, until=DAY, as_of=DAY).orderBy("checked_at").collect()
    seconds = [(r.checked_at.replace(tzinfo=timezone.utc) - START).total_seconds() for r in found]
    assert list(zip(seconds, (r.status for r in found), strict=True)) == [
        (10, "stalled"), (70, "ok"), (261, "quiet"), (300, "stalled"), (330, "ok")
    ]


def test_ticks_make_batches_of_a_silent_log(spark, log_folder, tmp_path):
    from settle.sources.log import file_log

    running = watch.start_alarms(
        file_log(spark, log_folder.path), f"{tmp_path}/tables", f"{tmp_path}/checkpoints",
        trigger={"processingTime": "200 milliseconds"},
    )
    try:
        for _ in range(300):
            if running.lastProgress and running.lastProgress["batchId"] >= 1:
                break
            running.awaitTermination(0.2)
        assert running.exception() is None
        assert running.lastProgress["batchId"] >= 1
    finally:
        running.stop()
    today = tables.today()
    rows = tables.read_table(spark, f"{tmp_path}/tables", ALARMS, today - timedelta(days=1)).collect()
    assert [r.status for r in rows] == ["quiet"]


def test_history_over_days_of_silence(spark):
    day = 86_400 * 1_000_000
    arrived = spark.createDataFrame([(BASE + 1,), (BASE + 3 * day,)], "arrival_us bigint")
    published = spark.createDataFrame(
        [(BASE + 60 * 1_000_000, BASE + 66 * 1_000_000)], "end_us bigint, at_us bigint"
    ).select(
        F.timestamp_micros("end_us").alias("window_end"), F.timestamp_micros("at_us").alias("emitted_at")
    )
    history = alarms.alarm_history(arrived, published)
    assert "SinglePartition" not in history._jdf.queryExecution().executedPlan().toString()
    rows = history.orderBy("now_us").collect()
    assert [r.now_us for r in rows] == list(range(BASE + 60 * 1_000_000, BASE + 3 * day + 61 * 1_000_000, 60 * 1_000_000))
    assert [r.closed_us for r in rows] == [None] + [BASE + 60 * 1_000_000] * 4320
    assert [r.heard_us for r in rows] == [BASE + 1] * 4320 + [BASE + 3 * day]
    assert [r.status for r in rows[:5]] == ["stalled", "ok", "ok", "quiet", "quiet"]
    assert rows[-1].status == "stalled"
