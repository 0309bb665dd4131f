"""Publication replay: what each patience level would have published, from the stored log.

A live stream's lateness depends on micro-batch boundaries; the log order does not. With D the
delay and W the window width, a row of partition p at offset o is too late for its window exactly
if an earlier row of p had already carried the watermark past the window's end:

    late(p, o, window)  <=>  some o' < o in p has  observed(o') - D >= window_end
                        <=>  o > closing(p, window), the first offset in p that reaches that far

So no row has to be sorted. ``closing`` comes from a map-side aggregate with a few rows per
partition and minute; the log is then scanned once more and each row compared with its closing
offset, for every delay at the same time. A window is closed once every partition's watermark has
passed its end. The watermark is per partition because interleaving across partitions is not
stored, which makes the number of late rows an upper bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settle.functions.clocks import minute_index
from settle.operators.joins import BROADCAST_ROWS, attach
from settle.operators.windows import MEASURES, per_author, per_minute
from settle.schema import FAST_DELAY_S, MICROS, SETTLED_DELAY_S, WINDOW_S
from settle.session import ensure_checkpoint_dir

DELAYS = (FAST_DELAY_S, SETTLED_DELAY_S)
WINDOW_US = WINDOW_S * MICROS


def _reach(delay_s: float) -> Column:
    """Number of the last window the row's own watermark has passed the end of."""
    return minute_index(F.col("observed_us") - F.lit(int(delay_s * MICROS)))


def summarise(log: DataFrame, delays: Sequence[float]) -> DataFrame:
    """Earliest offset and latest event time per partition, minute and reach of the watermark."""
    reaches = [_reach(delay).alias(f"reach_{i}") for i, delay in enumerate(delays)]
    return log.groupBy(
        "kafka_partition", minute_index(F.col("observed_us")).alias("minute"), *reaches
    ).agg(F.min("kafka_offset").alias("first_offset"), F.max("observed_us").alias("latest_us"))


def closings(summary: DataFrame, n_delays: int) -> DataFrame:
    """First offset that closes each window, per partition and delay (NULL while open).

    ``ends`` numbers a window by its end. Every window that has rows gets a line, so the lookup
    is an equality; the running minimum goes from the newest window to the oldest because a row
    that closes a window closes all earlier ones too.
    """
    nothing = F.lit(None).cast("bigint")

    def line(ends: Column, offsets: list[Column]) -> Column:
        named = [offset.alias(f"closing_{i}") for i, offset in enumerate(offsets)]
        return F.struct(ends.alias("ends"), *named)

    lines = [line(F.col("minute") + 1, [nothing] * n_delays)]
    for i in range(n_delays):
        reached = [F.col("first_offset") if j == i else nothing for j in range(n_delays)]
        lines.append(line(F.col(f"reach_{i}"), reached))
    newest_first = (
        Window.partitionBy("kafka_partition")
        .orderBy(F.desc("ends"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    names = [f"closing_{i}" for i in range(n_delays)]
    return (
        summary.select("kafka_partition", F.inline(F.array(*lines)))
        .groupBy("kafka_partition", "ends")
        .agg(*[F.min(name).alias(name) for name in names])
        .select(
            "kafka_partition",
            "ends",
            *[F.min(name).over(newest_first).alias(name) for name in names],
        )
    )


def replay(
    enriched: DataFrame,
    delays: Sequence[float] = DELAYS,
    broadcast_rows: int = BROADCAST_ROWS,
    retried: bool = False,
) -> DataFrame:
    """Per minute and delay ``i``: the measures over admitted creates, ``late_i``, ``closed_i``.

    Reads the log twice and shuffles it once, already collapsed per minute and author. The summary
    is written to the checkpoint folder, so that its size is known before anything is broadcast.

    ``retried`` says that a log position may be stored more than once, as a table has it after retried
    writes. The summary's minima and maxima do not notice; the creates, reduced to the columns that
    are counted, are shuffled once more to collapse their copies.
    """
    spark = enriched.sparkSession
    ensure_checkpoint_dir(spark)
    log = enriched.withColumn("observed_us", F.unix_micros("observed_time"))
    summary = summarise(log, delays).checkpoint()
    horizon_us, lines = bounds_of(summary)
    parts = author_lines(log, summary, lines, delays, broadcast_rows, retried)
    return totals_of(parts, horizon_us, delays)


def bounds_of(summary: DataFrame) -> tuple[int, int]:
    """The latest time that every partition has reached, and the number of lines."""
    found = (
        summary.groupBy("kafka_partition")
        .agg(F.max("latest_us").alias("latest_us"), F.count("*").alias("lines"))
        .agg(F.min("latest_us").alias("horizon_us"), F.sum("lines").alias("lines"))
        .first()
    )
    return found["horizon_us"] or 0, found["lines"] or 0


def author_lines(
    log: DataFrame,
    summary: DataFrame,
    lines: int,
    delays: Sequence[float],
    broadcast_rows: int = BROADCAST_ROWS,
    retried: bool = False,
) -> DataFrame:
    """What each author did in each minute (``ends``), admitted and late, for each delay ``i``.

    ``log`` has ``observed_us``. Lines of different parts of a log add up.
    """
    rows = log.filter(F.col("operation") == "create").select(
        "kafka_partition",
        "kafka_offset",
        "did",
        "is_reply",
        "clock_suspect",
        "lag_ms",
        (minute_index(F.col("observed_us")) + 1).alias("ends"),
    )
    if retried:
        rows = rows.distinct()  # a position determines its row
    timed = attach(
        rows,
        closings(summary, len(delays)),
        ["kafka_partition", "ends"],
        # every summary line adds at most one window line and one per delay
        summary_rows=lines * (1 + len(delays)),
        spread_by=["did", "kafka_offset"],
        broadcast_rows=broadcast_rows,
    )
    partials = []
    for i in range(len(delays)):
        closing = F.col(f"closing_{i}")
        admitted = closing.isNull() | (F.col("kafka_offset") <= closing)
        partials += [*per_author(admitted, f"_{i}"), F.count_if(~admitted).alias(f"n_late_{i}")]
    return timed.groupBy("ends", "did").agg(*partials)


def totals_of(parts: DataFrame, horizon_us: int, delays: Sequence[float]) -> DataFrame:
    """The replay's rows from the lines of authors, one for each author and minute."""
    totals = []
    for i in range(len(delays)):
        totals += [*per_minute(f"_{i}"), F.sum(f"n_late_{i}").alias(f"late_{i}")]
    minutes = parts.groupBy("ends").agg(*totals)
    closed = [
        (F.col("ends") * WINDOW_US <= F.lit(horizon_us - int(delay * MICROS))).alias(f"closed_{i}")
        for i, delay in enumerate(delays)
    ]
    return minutes.select(
        F.timestamp_micros((F.col("ends") - 1) * WINDOW_US).alias("window_start"),
        F.timestamp_micros(F.col("ends") * WINDOW_US).alias("window_end"),
        *[c for c in minutes.columns if c != "ends"],
        *closed,
    )


def _published(i: int) -> Column:
    return F.col(f"closed_{i}") & (F.col(f"events_{i}") > 0)


def published(replayed: DataFrame, i: int, delays: Sequence[float] = DELAYS) -> DataFrame:
    """The counts rows delay ``i`` would have published."""
    return replayed.filter(_published(i)).select(
        "window_start",
        "window_end",
        *[F.col(f"{name}_{i}").alias(name) for name in MEASURES],
        F.lit(delays[i]).cast("int").alias("watermark_delay_s"),
    )


def late_rows(replayed: DataFrame, delays: Sequence[float] = DELAYS) -> DataFrame:
    """How many creates each delay drops as too late, per minute."""
    return replayed.select(
        "window_start",
        *[F.col(f"late_{i}").alias(f"late_{delay}s") for i, delay in enumerate(delays)],
    )


def replay_revisions(replayed: DataFrame) -> DataFrame:
    """The revision report of a replay: both delays sit on one row, so there is nothing to join."""
    settled = F.when(_published(1), F.col("events_1"))
    delta = settled - F.col("events_0")
    return replayed.filter(_published(0)).select(
        "window_start",
        "window_end",
        F.col("events_0").alias("published"),
        settled.alias("settled"),
        delta.alias("delta"),
        F.try_divide(delta, F.col("events_0")).alias("pct_revision"),
        F.col("avg_lag_ms_0").alias("avg_lag_ms"),
        F.col("suspect_clocks_0").alias("suspect_clocks"),
        F.col("future_dated_0").alias("future_dated"),
        settled.isNull().alias("unsettled"),
    )
