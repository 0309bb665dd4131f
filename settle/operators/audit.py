"""Where each ingest session resumed, and what it missed, from a log of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.schema import MAX_REPLAY_S, MICROS, REPLAY_OVERLAP_S, UPSTREAM_RETENTION_S

OVERLAP_US = REPLAY_OVERLAP_S * MICROS
MAX_REPLAY_US = MAX_REPLAY_S * MICROS
# A request this far behind its first event fell out of what upstream still holds.
UNRECOVERABLE_US = UPSTREAM_RETENTION_S * MICROS * 9 // 10


def resume_plan(sessions: DataFrame) -> DataFrame:
    """Add ``resume_us`` (NULL: start live) and ``decision`` to ``session_id, cursor_us, now_us``.

    A recent position is resumed a little early, because duplicates can be removed later and gaps
    cannot. One past the replay cap is abandoned; exactly at the cap, or ahead of now, it is kept.
    """
    usable = F.col("cursor_us") > 0
    recent = F.col("now_us") - F.col("cursor_us") <= MAX_REPLAY_US
    decision = (
        F.when(usable & recent, "resume").when(usable, "cursor too old").otherwise("no cursor")
    )
    return sessions.withColumn("decision", decision).withColumn(
        "resume_us",
        F.when(F.col("decision") == "resume", F.col("cursor_us") - OVERLAP_US),
    )


def gap_report(planned: DataFrame) -> DataFrame:
    """Add ``gap_us`` and ``severity``: how far past the request the first event was.

    A position that upstream no longer holds shows only in this distance: no error comes with it.
    Distances within two replay overlaps are everyday jitter and count as none.
    """
    gap = F.col("first_seen_us") - F.col("resume_us")
    gap_us = F.when(gap >= 2 * OVERLAP_US, gap).otherwise(F.lit(0).cast("bigint"))
    severity = F.when(F.col("gap_us") > UNRECOVERABLE_US, "unrecoverable").when(
        F.col("gap_us") > 0, "warning"
    )
    return planned.withColumn("gap_us", gap_us).withColumn("severity", severity)


def first_seen(frames: DataFrame, sessions: DataFrame) -> DataFrame:
    """Join each session to its first frame's ``time_us``; NULL if that frame was not usable.

    ``frames`` carries ``session_id, arrival_order, status, time_us``.
    """
    first = frames.groupBy("session_id").agg(
        F.min_by(F.when(F.col("status") == "usable", F.col("time_us")), "arrival_order").alias(
            "first_seen_us"
        )
    )
    return sessions.join(first, "session_id", "left")
