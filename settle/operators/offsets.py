"""What a stored log lacks and what it holds twice, as ranges of offsets per partition.

A partition is never sorted whole. Offsets fall into buckets of fixed width; holes and repeats are found
inside each bucket, and only a line or two of each bucket, those at its edges, are compared across.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets of a bucket: the most that are sorted together.
BUCKET = 1 << 16


def positions(log: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Each stored position once, with the number of its copies; copies collapse before the shuffle."""
    known = log.filter(F.col("kafka_partition").isNotNull() & F.col("kafka_offset").isNotNull())
    counted = known.groupBy("kafka_partition", "kafka_offset").agg(F.count("*").alias("copies"))
    number = F.call_function("div", F.col("kafka_offset"), F.lit(bucket))
    return counted.withColumn("bucket", number)


def missing_ranges(log: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Ranges of offsets that are not stored, between the first and the last stored one of a partition.

    In the raw table of a log that ingest has gated, these are losses. Of any other log, frames that are no
    commits are never stored, and show up here as well.
    """
    stored = positions(log, bucket)
    inside = Window.partitionBy("kafka_partition", "bucket").orderBy("kafka_offset")
    within = stored.select(
        "kafka_partition",
        F.lag("kafka_offset").over(inside).alias("before"),
        F.col("kafka_offset").alias("after"),
    )
    edges = stored.groupBy("kafka_partition", "bucket").agg(
        F.min("kafka_offset").alias("after"), F.max("kafka_offset").alias("last")
    )
    by_bucket = Window.partitionBy("kafka_partition").orderBy("bucket")
    across = edges.select("kafka_partition", F.lag("last").over(by_bucket).alias("before"), "after")
    return (
        within.unionByName(across)
        .filter(F.col("after") - F.col("before") > 1)
        .select(
            "kafka_partition",
            (F.col("before") + 1).alias("first_offset"),
            (F.col("after") - 1).alias("last_offset"),
            (F.col("after") - F.col("before") - 1).alias("missing"),
        )
    )


def repeated_ranges(log: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Ranges of consecutive offsets that are stored more than once, and the rows beyond the first."""
    again = positions(log, bucket).filter(F.col("copies") > 1)
    inside = Window.partitionBy("kafka_partition", "bucket").orderBy("kafka_offset")
    stretch = F.col("kafka_offset") - F.row_number().over(inside)
    pieces = again.withColumn("stretch", stretch).groupBy("kafka_partition", "bucket", "stretch").agg(
        F.min("kafka_offset").alias("first_offset"),
        F.max("kafka_offset").alias("last_offset"),
        F.sum(F.col("copies") - 1).alias("extra_rows"),
    )
    start = F.col("bucket") * bucket
    at_edge = (F.col("first_offset") == start) | (F.col("last_offset") == start + bucket - 1)
    columns = ["kafka_partition", "first_offset", "last_offset", "extra_rows"]
    # at most two pieces of a bucket touch its edges; only they may go on in the next one
    edges = pieces.filter(at_edge).select(*columns)
    in_order = Window.partitionBy("kafka_partition").orderBy("first_offset")
    starts = F.coalesce(F.col("first_offset") - F.lag("last_offset").over(in_order) > 1, F.lit(True))
    numbered = edges.withColumn("starts", starts.cast("int")).withColumn(
        "island", F.sum("starts").over(in_order)
    )
    joined = numbered.groupBy("kafka_partition", "island").agg(
        F.min("first_offset").alias("first_offset"),
        F.max("last_offset").alias("last_offset"),
        F.sum("extra_rows").alias("extra_rows"),
    )
    return pieces.filter(~at_edge).select(*columns).unionByName(joined.select(*columns))
