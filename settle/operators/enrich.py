"""Enrichment: the one place that decides what lag, suspicion and reply mean.

Batch and streaming, fast and settled, all call ``enrich``; a difference between two counts can
therefore only come from the watermark.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.functions import clocks
from settle.schema import COMMIT_KIND, DEFAULT_COLLECTIONS, RAW


def in_collections(collections: Iterable[str] = DEFAULT_COLLECTIONS) -> Column:
    return F.col("commit.collection").isin(*collections)


def only_collections(
    posts: DataFrame, collections: Iterable[str] | str = DEFAULT_COLLECTIONS
) -> DataFrame:
    """Keep the named collections. A string is a comma-separated list, blanks ignored."""
    if isinstance(collections, str):
        collections = [name.strip() for name in collections.split(",") if name.strip()]
    return posts.filter(in_collections(collections))


def enrich(posts: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Commits with uri, both clocks, lag, suspicion, language, text length and reply columns.

    Expects ``time_us, did, kind, commit, kafka_partition, kafka_offset`` and, when streaming, the
    watermarked ``observed_time`` added by the source. ``keep`` names further columns to carry.
    """
    if "observed_time" not in posts.columns:
        posts = posts.withColumn("observed_time", clocks.observed_time(F.col("time_us")))
    record = "commit.record"
    created_at = F.col(f"{record}.createdAt")
    with_claim = (
        posts.filter(F.col("kind") == COMMIT_KIND)
        .withColumn("claimed_time", clocks.claimed_time(created_at))
        .withColumn("lag_ms", clocks.lag_ms(F.col("time_us"), F.col("claimed_time")))
    )
    return with_claim.select(
        F.concat(
            F.lit("at://"),
            "did",
            F.lit("/"),
            F.col("commit.collection"),
            F.lit("/"),
            F.col("commit.rkey"),
        ).alias("uri"),
        "did",
        F.col("commit.collection").alias("collection"),
        F.col("commit.rkey").alias("rkey"),
        F.col("commit.rev").alias("rev"),
        F.col("commit.operation").alias("operation"),
        "observed_time",
        "claimed_time",
        F.when(F.col("claimed_time").isNull(), created_at).alias("claimed_time_raw"),
        "lag_ms",
        clocks.clock_suspect(F.col("lag_ms")).alias("clock_suspect"),
        F.col(f"{record}.langs").alias("langs"),
        F.get(F.col(f"{record}.langs"), F.lit(0)).alias("lang_primary"),
        F.char_length(F.coalesce(F.col(f"{record}.text"), F.lit(""))).alias("text_length"),
        F.col(f"{record}.reply").isNotNull().alias("is_reply"),
        F.col(f"{record}.reply.root.uri").alias("reply_root_uri"),
        "kafka_partition",
        "kafka_offset",
        *keep,
    )


def creates(enriched: DataFrame) -> DataFrame:
    """Posts being written; updates and deletes stay visible in raw and health only."""
    return enriched.filter(F.col("operation") == "create")


def raw_wire(enriched: DataFrame) -> DataFrame:
    """The raw output as sent on the wire: the contract's columns, timestamps as UTC text."""
    return enriched.select(
        *[
            clocks.wire_time(F.col(name)).alias(name) if name in RAW.times else F.col(name)
            for name in RAW.wire_schema.names
        ]
    )
