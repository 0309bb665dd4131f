"""Collapsing the copies that at-least-once delivery makes certain.

Both are top-1 row numbers, which Spark reduces inside each input partition before the shuffle
(``WindowGroupLimit``), so a group holding a large share of the rows reaches one task as at most
one row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settle.operators.enrich import creates

POST_KEY = ["uri", "operation", "rev"]


def first_writes(raw: DataFrame) -> DataFrame:
    """One row per (uri, operation, rev): the first written. ``rev`` tells updates from retries."""
    order = Window.partitionBy(*POST_KEY).orderBy("kafka_offset", "kafka_partition")
    return (
        raw.withColumn("row_num", F.row_number().over(order))
        .filter(F.col("row_num") == 1)
        .drop("row_num")
    )


def latest_window_rows(counts: DataFrame) -> DataFrame:
    """One row per window: the last emitted; of two emitted together the more complete one."""
    order = Window.partitionBy("window_start").orderBy(F.desc("emitted_at"), F.desc("events"))
    return (
        counts.withColumn("row_num", F.row_number().over(order))
        .filter(F.col("row_num") == 1)
        .drop("row_num")
    )


def one_per_position(raw: DataFrame) -> DataFrame:
    """Stored rows with write retries removed: one row per log position."""
    return raw.dropDuplicates(["kafka_partition", "kafka_offset"])


def dedup_stream(enriched: DataFrame) -> DataFrame:
    """Live approximation of ``first_writes``: drops copies arriving within the watermark."""
    return enriched.dropDuplicatesWithinWatermark(POST_KEY)


def duplicate_inflation(enriched: DataFrame) -> DataFrame:
    """Per minute, how many counted creates were copies of a create already counted.

    A write counts once, in the minute of its first copy in the log. The log is read once: copies of
    a write within a minute collapse before the shuffle by write, and the lines that leave it are
    summed by minute.
    """
    minute = F.unix_micros(F.date_trunc("MINUTE", F.col("observed_time")))
    position = F.struct("kafka_offset", "kafka_partition")
    copies = (
        creates(enriched)
        .groupBy(*POST_KEY, minute.alias("minute"))
        .agg(F.count("*").alias("copies"), F.min(position).alias("position"))
    )
    order = Window.partitionBy(*POST_KEY).orderBy("position")
    return (
        copies.withColumn("first", F.row_number().over(order) == 1)
        .groupBy("minute")
        .agg(F.sum("copies").alias("raw_events"), F.count_if("first").alias("deduped_events"))
        .select(
            F.timestamp_micros("minute").alias("window_start"),
            "raw_events",
            "deduped_events",
            (F.col("raw_events") - F.col("deduped_events")).alias("inflation"),
        )
    )
