"""Exact discrete percentiles without gathering a group in one place.

``percentile_disc`` keeps a map of every distinct value of a group in one buffer. Here values are
first counted (which combines map-side), then located in two steps: which 65,536-wide bucket holds
the wanted rank, then which value inside that bucket. Each step sorts a bounded number of lines:
lags are limited to the plausible range, about 39,600 buckets, and a bucket has 65,536 values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 16
NO_BUCKET = -(1 << 62)


def exact_quantiles(
    counted: DataFrame, keys: list[str], value: str, percents: dict[str, int], weight: str
) -> DataFrame:
    """Smallest value at or above each percent of its group; NULL values do not take part.

    ``counted`` has one line per (keys, value) with its number of rows in ``weight`` and no NULL
    key; ``percents`` maps output column to a whole percent. Groups without any value have no line
    in the result. NULL values are weighed zero rather than filtered out: every use of ``counted``
    here and beside this stays the same plan, so Spark computes and shuffles it once.
    """
    values = counted.select(
        *keys,
        F.col(value).alias("v"),
        F.when(F.col(value).isNotNull(), F.col(weight)).otherwise(0).alias("n"),
        F.coalesce(F.shiftright(F.col(value), BUCKET_BITS), F.lit(NO_BUCKET)).alias("bucket"),
    )
    group = Window.partitionBy(*keys)
    ranks = {
        name: F.call_function("div", F.col("total") * percent + 99, F.lit(100))
        for name, percent in percents.items()
    }
    buckets = (
        values.groupBy(*keys, "bucket")
        .agg(F.sum("n").alias("held"))
        .withColumn("upto", F.sum("held").over(group.orderBy("bucket")))
        .withColumn("total", F.sum("held").over(group))
        .withColumn("before", F.col("upto") - F.col("held"))
        .withColumns({f"rank_{name}": rank for name, rank in ranks.items()})
    )
    holds_one = reduce(
        lambda a, b: a | b,
        [
            (F.col("before") < F.col(f"rank_{name}")) & (F.col(f"rank_{name}") <= F.col("upto"))
            for name in percents
        ],
    )
    wanted = buckets.filter(holds_one).drop("held", "upto", "total")
    inside = Window.partitionBy(*keys, "bucket").orderBy("v")
    placed = values.join(wanted, [*keys, "bucket"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(inside)
    )
    return placed.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("upto") >= F.col(f"rank_{name}"), F.col("v"))).alias(name)
            for name in percents
        ]
    )
