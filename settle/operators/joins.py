"""Joining rows to a small summary: broadcast behind a size check, salted shuffle beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About 40 bytes a row for the summaries joined here, so some 10 MB on the wire at most.
BROADCAST_ROWS = 200_000
SALTS = 32


def attach(
    rows: DataFrame,
    summary: DataFrame,
    on: list[str],
    summary_rows: int,
    spread_by: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join ``rows`` to ``summary`` (unique on ``on``), whose row count the caller counted.

    Within the bound the summary is broadcast and ``rows`` never move. Beyond it both sides are
    shuffled, with every summary row copied to ``SALTS`` slots, so that one hot key (a minute or
    a partition holding a third of all rows) is spread over that many tasks.
    """
    if summary_rows <= broadcast_rows:
        return rows.join(F.broadcast(summary), on, "left")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*spread_by), F.lit(SALTS)).cast("int"))
    copies = summary.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), [*on, "salt"], "left").drop("salt")
