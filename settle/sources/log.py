"""The post log as a DataFrame of ``value, partition, offset``, whatever carries it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.schema import LOG_SCHEMA, POSTS_TOPIC
from settle.session import prepare


def kafka_source_options(
    servers: str,
    topic: str = POSTS_TOPIC,
    starting: str = "latest",
    max_offsets: int | None = None,
    flush: tuple[int, float] | None = None,
) -> dict[str, str]:
    """First start at the live end; after that the checkpoint's offsets take over.

    ``flush`` is a number of messages and of seconds: a micro-batch starts once so many have come, or after
    that time with what there is; with a short trigger, whichever is first. An empty batch never starts.

    A micro-batch takes all there is. ``max_offsets`` is for the fast and settled queries only, where
    a catch-up batch after downtime would otherwise count fewer rows as late; it also bounds their
    throughput, so it has to be chosen for the cluster.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if flush is not None:
        rows, seconds = flush
        options["minOffsetsPerTrigger"] = str(rows)
        options["maxTriggerDelay"] = f"{int(seconds * 1000)}ms"
    return options


def kafka_sink_options(servers: str) -> dict[str, str]:
    """The topic comes with each message, so one writer serves posts and dead letters."""
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.compression.type": "zstd",
        "kafka.linger.ms": "50",
    }


def kafka_log(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Needs the Kafka connector on the class path of the cluster."""
    stream = prepare(spark).readStream.format("kafka").options(**options).load()
    return stream.select("topic", "value", "partition", "offset")


def file_log(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """A streaming folder of log files (Parquet, or JSON lines with ``value`` as text)."""
    schema = LOG_SCHEMA if fmt == "parquet" else LOG_SCHEMA.replace("BINARY", "STRING")
    reader = prepare(spark).readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _binary(reader.load(path))


def stored_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The same folder read once, as a batch."""
    schema = LOG_SCHEMA if fmt == "parquet" else LOG_SCHEMA.replace("BINARY", "STRING")
    return _binary(prepare(spark).read.format(fmt).schema(schema).load(path))


def _binary(log: DataFrame) -> DataFrame:
    return log.withColumn("value", F.col("value").cast("binary"))
