"""How long posts lived: each delete joined to what last happened to its record before it.

A delete names a record and carries nothing else, and a record's key may be used again after it. So the
create a delete belongs to is the latest one before it in the log, if nothing has deleted that already. The
log's order is the one clock both have: an author's messages are in one partition, in order. How long the
post lived is then told by the relay's clock, and, where the author's claim is plausible, by theirs.

No record's history is sorted in one task. Offsets fall into buckets of fixed width; within a bucket the
row before is found by a sort of at most as many rows, and what a bucket begins with is carried over from
the last line of the one before, a line for each record and bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settle.operators.dedup import first_writes

#: Offsets of a bucket: the most rows of one record that are sorted together.
BUCKET = 1 << 16
DELETED, AGAIN, UNKNOWN = "deleted", "already deleted", "no create"


def lifetimes(enriched: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row for each delete: the create it ends, if the log has it, and the time between them.

    Copies of a write count once. ``status`` tells deletes of a living post from those of one that was
    deleted before and those without a create in the log. Updates do not begin a life.
    """
    ends = F.col("operation").isin("create", "delete")
    claimed = F.when(~F.col("clock_suspect"), F.unix_micros("claimed_time"))
    happened = F.struct(
        "operation",
        F.col("rev").alias("rev"),
        F.unix_micros("observed_time").alias("observed_us"),
        claimed.alias("claimed_us"),
    )
    rows = first_writes(enriched.filter(ends)).select(
        "uri",
        "kafka_partition",
        "kafka_offset",
        F.call_function("div", F.col("kafka_offset"), F.lit(bucket)).alias("bucket"),
        happened.alias("own"),
    )
    inside = Window.partitionBy("uri", "bucket").orderBy("kafka_offset")
    deletes = rows.withColumn("before", F.lag("own").over(inside)).filter(
        F.col("own.operation") == "delete"
    )
    lines = rows.groupBy("uri", "bucket").agg(F.max_by("own", "kafka_offset").alias("last"))
    carried = lines.withColumn(
        "carried", F.lag("last").over(Window.partitionBy("uri").orderBy("bucket"))
    ).filter(F.col("carried").isNotNull())
    joined = deletes.join(carried.select("uri", "bucket", "carried"), ["uri", "bucket"], "left")
    known = joined.withColumn("before", F.coalesce("before", "carried"))
    status = (
        F.when(F.col("before").isNull(), UNKNOWN)
        .when(F.col("before.operation") == "delete", AGAIN)
        .otherwise(DELETED)
    )
    lived = F.col("status") == DELETED
    deleted_us, created_us = F.col("own.observed_us"), F.col("before.observed_us")
    return known.withColumn("status", status).select(
        "uri",
        F.col("own.rev").alias("rev"),
        "kafka_partition",
        "kafka_offset",
        "status",
        deleted_us.alias("deleted_us"),
        F.when(lived, F.col("before.rev")).alias("created_rev"),
        F.when(lived, deleted_us - created_us).alias("lifetime_us"),
        F.when(lived, deleted_us - F.col("before.claimed_us")).alias("claimed_lifetime_us"),
    )


def lifetime_profile(lived: DataFrame) -> DataFrame:
    """Deletes of each status per minute, and the shortest and longest life that ended in it."""
    minute = F.expr("deleted_us - pmod(deleted_us, 60000000)")
    return lived.groupBy(F.timestamp_micros(minute).alias("window_start")).agg(
        *(
            F.count_if(F.col("status") == status).alias(name)
            for status, name in ((DELETED, "deleted"), (AGAIN, "deleted_again"), (UNKNOWN, "unknown"))
        ),
        F.min("lifetime_us").alias("shortest_us"),
        F.max("lifetime_us").alias("longest_us"),
    )
