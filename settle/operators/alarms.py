"""Is silence a fault? A quiet log told from a pipeline that has stalled.

Windows that nothing fell into leave no row, so the newest closed window grows old in both cases. What tells
them apart is whether messages still arrive: if they do and no window closes, something is stuck; if none do,
there is nothing to close.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settle.schema import FAST_DELAY_S, MICROS, WINDOW_S

OK, QUIET, STALLED = "ok", "quiet", "stalled"
#: Age of the newest closed window that is still in order: it is as long open as it is wide, waits for the
#: patience, and may take two batches to be written.
FRESH_S = 2 * WINDOW_S + FAST_DELAY_S + 15
#: Time without any message after which a log is quiet.
QUIET_S = 120
#: Spans that are put in order in one group; a day of minutes.
BLOCK_SPANS = 1440


def status_of(
    now_us: Column, closed_us: Column, heard_us: Column, fresh_s: float = FRESH_S, quiet_s: float = QUIET_S
) -> Column:
    """From the end of the newest closed window and the arrival of the newest message, NULL if none yet."""
    fresh = F.coalesce(now_us - closed_us <= F.lit(int(fresh_s * MICROS)), F.lit(False))
    silent = F.coalesce(now_us - heard_us > F.lit(int(quiet_s * MICROS)), F.lit(True))
    return F.when(fresh, OK).when(silent, QUIET).otherwise(STALLED)


def alarm_history(
    arrivals: DataFrame, health: DataFrame, every_s: int = WINDOW_S, **limits: float
) -> DataFrame:
    """What the alarm would have said at each of a row of instants, from stored tables.

    ``arrivals`` has ``arrival_us`` of messages, ``health`` the liveness rows. Both are reduced to a line
    for each span between two instants before they are put in order, so what is sorted grows with the time
    covered and not with the log. An instant sees what was there when its span began.
    """
    width = every_s * MICROS

    def line(rows: DataFrame, at: Column, known: Column, name: str) -> DataFrame:
        span = F.call_function("div", at, F.lit(width)).alias("span")
        return rows.groupBy(span).agg(F.max(known).alias(name))

    heard = line(arrivals, F.col("arrival_us"), F.col("arrival_us"), "heard_us")
    closed = line(health, F.unix_micros("emitted_at"), F.unix_micros("window_end"), "closed_us")
    stored = heard.join(closed, "span", "full").withColumn("span", F.col("span") + 1)
    covered = stored.agg(F.min("span").alias("first"), F.max("span").alias("last")).first()
    first, last = (0, -1) if covered.first is None else covered
    spans = arrivals.sparkSession.range(first, last + 1).withColumnRenamed("id", "span")
    lines = spans.join(stored, "span", "left").withColumn(
        "block", F.call_function("div", F.col("span"), F.lit(BLOCK_SPANS))
    )
    # what was known before a block comes from the maxima of the blocks before it, a line a block
    later = F.sequence(F.col("block") + 1, F.lit(last // BLOCK_SPANS).cast("long"))
    reached = lines.filter(F.col("block") < last // BLOCK_SPANS).groupBy("block").agg(
        F.max("heard_us").alias("heard"), F.max("closed_us").alias("closed")
    )
    reached = reached.select(F.explode(later).alias("block"), "heard", "closed").groupBy("block").agg(
        F.max("heard").alias("heard"), F.max("closed").alias("closed")
    )
    lines = lines.join(reached, "block", "left")
    within = Window.partitionBy("block").orderBy("span")
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now_us = F.col("span") * width
    heard_us = F.greatest(F.max("heard_us").over(so_far), "heard")
    closed_us = F.greatest(F.max("closed_us").over(so_far), "closed")
    known = lines.select(now_us.alias("now_us"), heard_us.alias("heard_us"), closed_us.alias("closed_us"))
    status = status_of(F.col("now_us"), F.col("closed_us"), F.col("heard_us"), **limits)
    return known.select("now_us", "closed_us", "heard_us", status.alias("status"))
