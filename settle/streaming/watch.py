"""The alarm as a query: it runs on a clock of its own, so that it speaks while nothing arrives.

A message of nothing comes each second, so there is a batch whether the log delivers or not. Each batch notes
when the log was last heard, looks up the newest closed window in the stored health table, and writes a row if
the status is another one than before. What it has to remember is carried by the commit record of the batch.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from settle.operators.alarms import status_of
from settle.plans.commits import CommitLog
from settle.plans.tables import read_table, write_batch
from settle.schema import ALARMS, HEALTH, MICROS
from settle.streaming.partitions import with_ticks
from settle.streaming.queries import FAST_TRIGGER, _start, run_id


def publish_alarms(tables: str, clock: Callable[[int], float] = lambda _: time.time(), **limits) -> Callable:
    """Batch writer; rows of a batch without a value are ticks. ``clock`` gives the time in seconds."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_id(batch)
        log = CommitLog(spark, tables)
        if log.holds(run, batch_id):
            return
        log.begin(run)
        carried = log.read(run)
        now_us = int(clock(batch_id) * MICROS)
        heard_us = carried.get("heard_us")
        if not batch.filter(F.col("value").isNotNull()).isEmpty():
            heard_us = now_us
        today = datetime.fromtimestamp(now_us / MICROS, timezone.utc).date()
        health = read_table(spark, tables, HEALTH, today - timedelta(days=1), until=today, as_of=today)
        newest = health.agg(F.max(F.unix_micros("window_end")).alias("closed_us"))
        known = newest.select(
            F.timestamp_micros(F.lit(now_us)).alias("checked_at"),
            status_of(
                F.lit(now_us), F.col("closed_us"), F.lit(heard_us).cast("long"), **limits
            ).alias("status"),
            F.timestamp_micros("closed_us").alias("last_window_end"),
            F.timestamp_micros(F.lit(heard_us).cast("long")).alias("last_heard"),
        )
        row = known.first()
        if row.status != carried.get("status"):
            write_batch(spark.createDataFrame([row], ALARMS.table_schema), ALARMS, tables, run, batch_id)
        log.commit(run, batch_id, {"heard_us": heard_us, "status": row.status})

    return write


def start_alarms(
    log: DataFrame, tables: str, checkpoints: str, trigger: dict | None = None, **limits
) -> StreamingQuery:
    """Write a row into the alarms table whenever the state of the pipeline changes."""
    writer = with_ticks(log).writeStream.outputMode("append").foreachBatch(
        publish_alarms(tables, **limits)
    )
    return _start(writer, "alarms", checkpoints, trigger or {"processingTime": FAST_TRIGGER})
