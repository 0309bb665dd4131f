"""The streaming queries: three over one log, and one on either side of it.

* raw       every commit, and the frames nobody could read
* fast      counts five seconds after a minute closes, and the liveness row
* settled   the same counts ten minutes after
* ingest    received frames to the keyed log, and to the dead-letter topic
* sink      output topics to their tables, for producers other than the queries above

Spark applies one watermark policy per query, so each patience level is a query with its own
checkpoint. An idle partition does not hold the watermark back: it follows the newest event time
seen. Rows in one micro-batch are never late to each other and a cutoff takes effect a batch
later, so the fast query wants short triggers, and a backlog must be measured with
``operators.replay`` rather than by re-streaming it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from settle.operators import contract, frames
from settle.operators.dedup import dedup_stream
from settle.operators.enrich import enrich, only_collections
from settle.operators.windows import author_totals, counts_of, health_of, totals_of_authors
from settle.plans.commits import CommitLog
from settle.plans.tables import write_batch
from settle.schema import (
    COUNTS_FAST,
    COUNTS_SETTLED,
    FAST_DELAY_S,
    HEALTH,
    PARSE_ERRORS,
    RAW,
    ROUTES,
    SETTLED_DELAY_S,
    OutputSpec,
)

FAST_TRIGGER = "1 second"
TRIGGER = "10 seconds"


def watermarked_posts(
    log: DataFrame,
    delay_s: int,
    collections: Iterable[str] | None = None,
    gated: bool = False,
) -> DataFrame:
    """Enriched commits whose event time is the relay's clock; no other column can be chosen.

    ``gated`` says the log already holds usable frames only and need not be classified again.
    """
    if not gated:
        log = frames.usable(frames.classify(log)).select("value", "partition", "offset")
    posts = frames.decode(log).withWatermark("observed_time", f"{delay_s} seconds")
    if collections is not None:
        posts = only_collections(posts, collections)
    return enrich(posts)


def live_totals(log: DataFrame, delay_s: int, dedup: bool = False, **options) -> DataFrame:
    """Totals of each minute's authors, emitted once when the watermark passes the minute's end.

    The authors of a minute leave the state in one batch, whose writer adds them up; a second stateful
    step would cost every batch another shuffle and commit. All commits reach the aggregate and creates are told apart inside it: a filter before it would
    be pushed below the watermark, and updates and deletes would no longer advance event time.
    """
    posts = watermarked_posts(log, delay_s, **options)
    return author_totals(dedup_stream(posts) if dedup else posts)


def run_id(batch: DataFrame) -> str:
    """The id of the streaming query a micro-batch belongs to."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def committed(tables: str, write: Callable[[DataFrame, str, int], dict | None]) -> Callable:
    """Batch writer whose tables show all of a batch or none of it.

    ``write`` gets the batch, the run and the batch's number, and returns what the record should carry.
    The rows count once the commit record is there; a batch that has one, repeated after a restart, is
    not written again.
    """

    def once(batch: DataFrame, batch_id: int) -> None:
        run, log = run_id(batch), CommitLog(batch.sparkSession, tables)
        if log.holds(run, batch_id):
            return
        log.begin(run)
        log.commit(run, batch_id, write(batch, run, batch_id))

    return once


def publish(spec: OutputSpec, delay_s: int, tables: str, with_health: bool) -> Callable:
    """Batch writer: the counts and, for the fast query, the liveness rows of the same minutes."""

    def write(batch: DataFrame, run: str, batch_id: int) -> None:
        totals = totals_of_authors(batch).withColumn("emitted_at", F.current_timestamp())
        totals = totals.coalesce(1).persist()  # a line a minute and task
        emitted_at = F.col("emitted_at")
        # Most batches of a short trigger close no minute; they leave no folder behind. A repeated
        # batch closes the same minutes, so it is empty exactly if it was empty before.
        if not totals.isEmpty():
            counts = counts_of(totals, delay_s, emitted_at)
            write_batch(counts, spec, tables, run, batch_id, gathered=True)
            if with_health:
                health = health_of(totals, emitted_at)
                write_batch(health, HEALTH, tables, run, batch_id, gathered=True)
        totals.unpersist()

    return committed(tables, write)


def publish_raw(
    tables: str, on_reject: str = "quarantine", collections=None, gated: bool = False
) -> Callable:
    """Batch writer: raw posts and dead letters; readers see both or neither.

    A ``gated`` log has no dead letters: ingest has sent those to a topic of their own.
    """

    def write(batch: DataFrame, run: str, batch_id: int) -> None:
        received = batch if gated else batch.persist()
        log = received if gated else frames.usable(received)
        posts = frames.decode(log.select("value", "partition", "offset"))
        if collections is not None:
            posts = only_collections(posts, collections)
        rows = enrich(posts).persist()
        write_batch(rows, RAW, tables, run, batch_id, on_reject)
        rows.unpersist()
        if not gated:
            write_batch(frames.dead_letters(received), PARSE_ERRORS, tables, run, batch_id)
            received.unpersist()

    return committed(tables, write)


def publish_routed(tables: str, on_reject: str = "fail") -> Callable:
    """Batch writer: every table's rows of the batch; readers see all of them or none."""

    def write(batch: DataFrame, run: str, batch_id: int) -> None:
        routed = batch.persist()
        for spec in ROUTES.values():
            rows = contract.rows_for(routed, spec)
            write_batch(rows, spec, tables, run, batch_id, on_reject)
        routed.unpersist()

    return committed(tables, write)


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in no more partitions than the cluster has cores.

    Every batch opens and commits each partition of the state, however few rows it brings, and the number
    is fixed by a checkpoint's first start. ``spark.sql.shuffle.partitions`` holds if it is less.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _start(writer: DataStreamWriter, name: str, checkpoints: str, trigger: dict) -> StreamingQuery:
    return (
        writer.queryName(name)
        .option("checkpointLocation", f"{checkpoints}/{name}")
        .trigger(**trigger)
        .start()
    )


def start_fast(
    log: DataFrame, tables: str, checkpoints: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    totals = live_totals(log, FAST_DELAY_S, **options)
    writer = totals.writeStream.outputMode("append").foreachBatch(
        publish(COUNTS_FAST, FAST_DELAY_S, tables, with_health=True)
    )
    with state_partitions(log.sparkSession):
        return _start(writer, "fast", checkpoints, trigger or {"processingTime": FAST_TRIGGER})


def start_settled(
    log: DataFrame, tables: str, checkpoints: str, trigger: dict | None = None, **options
) -> StreamingQuery:
    totals = live_totals(log, SETTLED_DELAY_S, **options)
    writer = totals.writeStream.outputMode("append").foreachBatch(
        publish(COUNTS_SETTLED, SETTLED_DELAY_S, tables, with_health=False)
    )
    with state_partitions(log.sparkSession):
        return _start(writer, "settled", checkpoints, trigger or {"processingTime": TRIGGER})


def start_raw(
    log: DataFrame,
    tables: str,
    checkpoints: str,
    trigger: dict | None = None,
    on_reject: str = "quarantine",
    collections=None,
    gated: bool = False,
) -> StreamingQuery:
    rows = log if gated else frames.observed_counters(frames.classify(log))
    writer = rows.writeStream.outputMode("append").foreachBatch(
        publish_raw(tables, on_reject, collections, gated)
    )
    return _start(writer, "raw", checkpoints, trigger or {"processingTime": TRIGGER})


def start_ingest(
    received: DataFrame,
    sink: dict[str, str],
    checkpoints: str,
    trigger: dict | None = None,
    fmt: str = "kafka",
) -> StreamingQuery:
    """Classify received frames (a ``value`` column) and pass them on under their topic and key."""
    classified = frames.observed_counters(frames.classify(received))
    writer = frames.log_messages(classified).writeStream.format(fmt).options(**sink)
    return _start(writer, "ingest", checkpoints, trigger or {"processingTime": FAST_TRIGGER})


def start_sink(
    messages: DataFrame,
    tables: str,
    checkpoints: str,
    trigger: dict | None = None,
    on_reject: str = "fail",
) -> StreamingQuery:
    """Write ``topic, value`` messages to the tables their topics are routed to."""
    routed = contract.observed_routing(contract.route(messages))
    writer = routed.writeStream.outputMode("append").foreachBatch(
        publish_routed(tables, on_reject)
    )
    return _start(writer, "sink", checkpoints, trigger or {"processingTime": TRIGGER})


def start_all(
    log: Callable[[int | None], DataFrame],
    tables: str,
    checkpoints: str,
    collections=None,
    gated: bool = False,
    max_offsets: int | None = None,
) -> list[StreamingQuery]:
    """Start the three queries; ``log`` is called once per query, each reads on its own.

    ``gated`` says that ingest has classified the log; nothing is then classified again. ``log`` is
    given the bound of a micro-batch: ``max_offsets`` for fast and settled, none for raw.
    """
    options = {"collections": collections, "gated": gated}
    return [
        start_raw(log(None), tables, checkpoints, **options),
        start_fast(log(max_offsets), tables, checkpoints, **options),
        start_settled(log(max_offsets), tables, checkpoints, **options),
    ]
