"""Raw frames to posts: classification, dead letters, decoding and ingest counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.functions import clocks, frames
from settle.operators.parse import parse_once
from settle.schema import (
    DEAD_LETTER_TOPIC,
    IGNORED_KINDS,
    PARSE_ERRORS,
    POST_SCHEMA,
    POSTS_TOPIC,
)


def classify(raw: DataFrame) -> DataFrame:
    """Add ``status, reason, key, time_us`` beside the untouched ``value`` bytes.

    ``key`` (the author) and ``time_us`` are set on usable frames only: they say where the frame
    goes and how far the stream has got.
    """
    columns = raw.columns
    body, envelope = F.col("frame_body"), F.col("envelope")
    bodies = raw.withColumn("frame_body", frames.body_of(frames.text_of(F.col("value"))))
    opened = parse_once(bodies, frames.envelope_of(body), "envelope")
    status = F.col("status")
    return opened.withColumn("status", frames.status_of(envelope)).select(
        *columns,
        "status",
        F.when(status == frames.UNDELIVERABLE, frames.fault_of(envelope, body)).alias("reason"),
        F.when(status == frames.USABLE, F.col("envelope.did")).alias("key"),
        F.when(status == frames.USABLE, F.col("envelope.time_us")).alias("time_us"),
    )


def usable(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("status") == frames.USABLE)


def dead_letters(classified: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Undeliverable frames as ``parse_errors`` rows: when received, what, and why."""
    received_at = F.current_timestamp() if received_at is None else received_at
    return (
        classified.filter(F.col("status") == frames.UNDELIVERABLE)
        .withColumn("observed_time", received_at)
        .withColumn("payload", F.make_valid_utf8(F.col("value").cast("string")))
        .withColumn("error", F.col("reason"))
        .select(*PARSE_ERRORS.table_schema.names)
    )


def decode(log: DataFrame) -> DataFrame:
    """Log messages (``value, partition, offset``) to posts with their event time.

    A field of the wrong shape becomes NULL and the rest of the row survives. A message without
    an event time has no place in any window and is dropped.
    """
    post = F.from_json(F.col("value").cast("string"), POST_SCHEMA)
    rest = [c for c in log.columns if c not in ("value", "partition", "offset")]
    return (
        parse_once(log, post, "post")
        .filter(F.col("post.time_us").isNotNull())
        .select(
            "post.*",
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            clocks.observed_time(F.col("post.time_us")).alias("observed_time"),
            *rest,
        )
    )


def counters(classified: DataFrame) -> DataFrame:
    """Frames per status."""
    return classified.groupBy("status").agg(F.count("*").alias("frames"))


def observed_counters(classified: DataFrame, name: str = "ingest") -> DataFrame:
    """The same counts as metrics of whatever query the frames pass through, at no extra pass."""
    return classified.observe(
        name,
        F.count_if(F.col("status") == frames.USABLE).alias("events"),
        F.count_if(F.col("status") == frames.SKIPPED).alias("skipped"),
        F.count_if(F.col("status") == frames.UNDELIVERABLE).alias("dead_lettered"),
    )


def log_messages(classified: DataFrame) -> DataFrame:
    """What ingest sends on: ``topic, key, value`` with the received bytes untouched.

    Usable frames are keyed by author, so that one author's posts stay in one partition and in
    order; undeliverable ones go to the dead-letter topic; skipped ones nowhere.
    """
    topic = F.when(F.col("status") == frames.USABLE, POSTS_TOPIC).otherwise(DEAD_LETTER_TOPIC)
    return classified.filter(F.col("status") != frames.SKIPPED).select(
        topic.alias("topic"), F.col("key"), F.col("value")
    )
