"""A replay that is kept: extended by what is new in the log, without reading the old part again.

Two tables hold all a replay has to know of the log so far. ``summary`` has a few lines per partition and
minute: the first offset that carried the watermark so far, and the latest time. ``authors`` has a line per
minute and author: what was admitted and what was late, for each delay. A new part of the log has higher
offsets in every partition than the old one, so it cannot change what the old rows met: a window that was
closed before one of them is still closed by the same offset, and one that was open is closed by an offset
after all of them. So the new rows are judged by the lines of both parts, and their lines are added.

Parts may be cut anywhere, a different offset for each partition. A part is written under its number and
counts with its commit record, so a repeated part is not added twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.operators.replay import DELAYS, author_lines, bounds_of, summarise, totals_of
from settle.plans.commits import CommitLog

RUN = "replay"
SUMMARY, AUTHORS = "replay_summary", "replay_authors"


def _parts(root: str, table: str, upto: int) -> list[str]:
    return [f"{root}/{table}/part={number}" for number in range(upto + 1)]


def extend(
    enriched: DataFrame, root: str, number: int, delays: Sequence[float] = DELAYS, retried: bool = False
) -> None:
    """Add part ``number`` of the log, which follows the parts before it in every partition."""
    spark, log = enriched.sparkSession, CommitLog(enriched.sparkSession, root)
    newest = log.newest(RUN)
    if newest is None:
        log.begin(RUN)
        newest = -1
    if newest >= number:
        return
    if newest != number - 1:
        raise ValueError(f"part {number} cannot follow part {newest}")
    timed = enriched.withColumn("observed_us", F.unix_micros("observed_time"))
    path = f"{root}/{SUMMARY}/part={number}"
    summarise(timed, delays).write.mode("overwrite").parquet(path)
    summary = spark.read.parquet(*_parts(root, SUMMARY, number))
    _, lines = bounds_of(summary)
    parts = author_lines(timed, summary, lines, delays, retried=retried)
    parts.write.mode("overwrite").parquet(f"{root}/{AUTHORS}/part={number}")
    log.commit(RUN, number, {"delays": list(delays)})


def replayed(spark: SparkSession, root: str) -> DataFrame:
    """The replay of all parts, as ``operators.replay.replay`` has it of the whole log."""
    log = CommitLog(spark, root)
    newest = log.newest(RUN)
    if newest is None or newest < 0:
        raise ValueError(f"nothing has been replayed into {root}")
    delays = log.read(RUN)["delays"]
    horizon_us, _ = bounds_of(spark.read.parquet(*_parts(root, SUMMARY, newest)))
    stored = spark.read.parquet(*_parts(root, AUTHORS, newest))
    names = [name for name in stored.columns if name not in ("ends", "did")]
    added = stored.groupBy("ends", "did").agg(*(F.sum(name).alias(name) for name in names))
    return totals_of(added, horizon_us, delays)
