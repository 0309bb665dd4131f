"""Counts under a watermark that follows the slowest partition of the log.

Spark's own watermark follows the newest event time of any partition, so a partition that lags by more
than the patience loses its rows. Here the watermark is the least of what the partitions have reached,
and a partition that has been silent for ``idle_s`` of processing time leaves the comparison until it
delivers again; if all are silent it stays where it is. It never goes back: rows that a partition brings
after it was left out may be late, as they would be from any other. As with Spark's own, rows of one
micro-batch are never late to each other and a cutoff takes effect with the next one.

How far each partition has got is carried by the commit record of each batch, with the minutes that are
open, and so can never disagree with the rows that were written. What a batch adds to an open minute is
stored as a line for each of its authors, in a folder of the minute; when the watermark passes the
minute's end, its lines, and no others, are read, added up and published, and the folder goes.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from settle.functions.clocks import minute_index
from settle.operators import frames
from settle.operators.enrich import enrich, only_collections
from settle.operators.windows import WINDOW, counts_of, health_of, per_author, per_minute
from settle.plans.commits import CommitLog
from settle.plans.tables import delete_folder, write_batch
from settle.schema import HEALTH, IDLE_S, MICROS, WINDOW_S, OutputSpec
from settle.streaming.queries import FAST_TRIGGER, _start, run_id

WINDOW_US = WINDOW_S * MICROS
#: What one batch knows of one author in one minute; sums and a maximum, so that lines add up.
LINES = T.StructType(
    [
        T.StructField("did", T.StringType()),
        *(T.StructField(n, T.LongType()) for n in
          ("n", "n_reply", "n_suspect", "n_future", "lag_sum", "n_lag", "n_all")),
        T.StructField("latest", T.TimestampType()),
    ]
)


@dataclass
class Progress:
    """How far each partition has got and when it last delivered; the watermark; the open minutes."""

    partitions: dict[int, tuple[int, int]] = field(default_factory=dict)
    watermark_us: int | None = None
    open: list[int] = field(default_factory=list)

    @classmethod
    def carried(cls, record: dict) -> Progress:
        partitions = {int(p): tuple(v) for p, v in record.get("partitions", {}).items()}
        return cls(partitions, record.get("watermark_us"), record.get("open", []))

    def record(self) -> dict:
        return {
            "partitions": {str(p): list(v) for p, v in self.partitions.items()},
            "watermark_us": self.watermark_us,
            "open": self.open,
        }

    def advance(self, seen: dict[int, int], now_ms: int, idle_s: float) -> Progress:
        """After a batch that reached ``seen`` (event time in microseconds) in its partitions."""
        partitions = dict(self.partitions)
        for partition, reached in seen.items():
            before = partitions.get(partition, (reached, now_ms))[0]
            partitions[partition] = (max(before, reached), now_ms)
        active = [us for us, at in partitions.values() if now_ms - at < idle_s * 1000]
        watermark = self.watermark_us
        if active:
            watermark = min(active) if watermark is None else max(watermark, min(active))
        return Progress(partitions, watermark, list(self.open))

    def passed(self, delay_s: float) -> int | None:
        """Minutes ending at this time or before are closed; None while nothing has been seen."""
        return None if self.watermark_us is None else self.watermark_us - int(delay_s * MICROS)


def publish_by_partition(
    spec: OutputSpec,
    delay_s: int,
    tables: str,
    with_health: bool = False,
    idle_s: float = IDLE_S,
    collections: Iterable[str] | None = None,
    gated: bool = False,
    clock: Callable[[int], float] | None = None,
) -> Callable:
    """Batch writer of the counts; ``clock`` gives the processing time of a batch in seconds."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, run_id(batch)
        log = CommitLog(spark, tables)
        if log.holds(run, batch_id):
            return
        log.begin(run)
        before = Progress.carried(log.read(run))
        lines = f"{tables}/{spec.name}_open/run={run}"
        received = batch if gated else frames.usable(frames.classify(batch))
        posts = frames.decode(received.select("value", "partition", "offset"))
        if collections is not None:
            posts = only_collections(posts, collections)
        minute = minute_index(F.unix_micros("observed_time")).alias("minute")
        rows = enrich(posts).select(
            "kafka_partition", minute, "did", "operation", "observed_time", "is_reply", "clock_suspect", "lag_ms"
        )
        # a line for each partition, minute and author, collapsed before the shuffle
        counted = rows.groupBy("kafka_partition", "minute", "did").agg(
            *per_author(F.col("operation") == "create"),
            F.count("*").alias("n_all"),
            F.max("observed_time").alias("latest"),
        ).persist()
        reached = counted.groupBy("kafka_partition").agg(F.max(F.unix_micros("latest")).alias("us"))
        seen = {row.kafka_partition: row.us for row in reached.collect()}  # a line a partition
        now = time.time() if clock is None else clock(batch_id)
        after = before.advance(seen, int(now * 1000), idle_s)
        cutoff = before.passed(delay_s)
        on_time = counted
        if cutoff is not None:
            on_time = counted.filter((F.col("minute") + 1) * WINDOW_US > cutoff)
        (
            on_time.select("minute", *LINES.names)
            .withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("minute", "batch_id")
            .parquet(lines)
        )
        fresh = [row.minute for row in on_time.select("minute").distinct().collect()]  # a line a minute
        counted.unpersist()
        minutes = sorted({*before.open, *fresh})
        limit = after.passed(delay_s)
        closed = [m for m in minutes if limit is not None and (m + 1) * WINDOW_US <= limit]
        after.open = [m for m in minutes if m not in set(closed)]
        if closed:
            totals = totals_of(spark, lines, closed).persist()
            write_batch(counts_of(totals, delay_s), spec, tables, run, batch_id)
            if with_health:
                write_batch(health_of(totals), HEALTH, tables, run, batch_id)
            totals.unpersist()
        log.commit(run, batch_id, after.record())
        for number in closed:
            delete_folder(spark, f"{lines}/minute={number}")

    return write


def totals_of(spark: SparkSession, lines: str, minutes: list[int]) -> DataFrame:
    """The totals of some minutes from the lines that batches have left in their folders."""
    schema = T.StructType(
        [*LINES.fields, T.StructField("minute", T.LongType()), T.StructField("batch_id", T.LongType())]
    )
    paths = [f"{lines}/minute={minute}" for minute in minutes]
    stored = spark.read.schema(schema).option("basePath", lines).parquet(*paths)
    sums = [F.sum(n).alias(n) for n in LINES.names[1:-1]]
    authors = stored.groupBy("minute", "did").agg(*sums, F.max("latest").alias("latest"))
    start = F.timestamp_micros(F.col("minute") * WINDOW_US)
    window = F.struct(
        start.alias("start"), (start + F.expr(f"INTERVAL {WINDOW}")).alias("end")
    ).alias("window")
    return authors.groupBy("minute").agg(
        *per_minute(),
        F.sum("n_all").alias("all_events"),
        F.max("latest").alias("max_observed_time"),
    ).select(window, "*").drop("minute")


def with_ticks(log: DataFrame) -> DataFrame:
    """The log with a message of nothing each second, so that silence is noticed while it lasts."""
    ticks = log.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    return log.select("value", "partition", "offset").unionByName(
        ticks.select(
            F.lit(None).cast("binary").alias("value"),
            F.lit(None).cast("int").alias("partition"),
            F.lit(None).cast("bigint").alias("offset"),
        )
    )


def start_by_partition(
    log: DataFrame,
    spec: OutputSpec,
    delay_s: int,
    tables: str,
    checkpoints: str,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Publish the counts of one patience level under the watermark of the slowest partition."""
    writer = log.writeStream.outputMode("append").foreachBatch(
        publish_by_partition(spec, delay_s, tables, **options)
    )
    name = f"{spec.name}_by_partition"
    return _start(writer, name, checkpoints, trigger or {"processingTime": FAST_TRIGGER})
