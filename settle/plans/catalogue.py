"""Named queries over the generated tables, one per operator; each reads whole tables.

Timestamps leave as epoch microseconds or as wire text, so that results compare across engines.
Nothing depends on the current time: the day and the instant of asking are fixed below.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.functions import clocks
from settle.operators import (
    alarms,
    audit,
    contract,
    dedup,
    frames,
    lifetimes,
    offsets,
    replay,
    sketches,
    windows,
)
from settle.operators.enrich import creates, enrich, only_collections, raw_wire
from settle.plans import curated, replayed, tables
from settle.schema import (
    COUNTS_FAST,
    COUNTS_SETTLED,
    FAST_DELAY_S,
    HEALTH,
    MICROS,
    PARSE_ERRORS,
    RAW,
    REVISIONS,
    ROUTES,
    SETTLED_DELAY_S,
    SKETCHES,
    OutputSpec,
)
from settle.session import ensure_checkpoint_dir
from settle.sources import derived, events
from settle.sources.log import file_log
from settle.streaming import partitions, revisions
from settle.streaming import queries as streaming

AS_OF = datetime(2024, 1, 1, 1, 5, tzinfo=timezone.utc)
LAST_DAY = date(2024, 1, 30)

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}


def query(build: Query) -> Query:
    CATALOGUE[build.__name__] = build
    return build


def us(name: str) -> Column:
    return F.unix_micros(name).alias(f"{name}_us")


def with_us(rows: DataFrame) -> DataFrame:
    """Replace every timestamp column by its epoch microseconds."""
    return rows.select(
        *[us(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in rows.schema]
    )


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(events.posts_from_events(spark, sf_dir))


def _month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log on the events' own clock, over 30 days instead of an hour."""
    return enrich(events.posts_from_events(spark, sf_dir, speedup=1))


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(events.posts_without_positions(spark, sf_dir))


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.classify(derived.frames_from_events(spark, sf_dir))


# --- sources and ingest -----------------------------------------------------------------------


@query
def scan_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every post as a log message and decode it again with the declared schema."""
    posts = frames.decode(events.as_log(events.posts_from_events(spark, sf_dir)))
    return posts.select(
        "time_us",
        "did",
        "kind",
        "commit.rev",
        "commit.operation",
        "commit.collection",
        "commit.rkey",
        "commit.cid",
        F.col("commit.record.createdAt").alias("created_at"),
        F.array_join("commit.record.langs", ",").alias("langs"),
        "commit.record.text",
        F.col("commit.record.reply").isNotNull().alias("is_reply"),
        F.col("commit.record.reply.root.uri").alias("reply_root_uri"),
        "kafka_partition",
        "kafka_offset",
        us("observed_time"),
    )


@query
def json_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the wrong shape become NULL, the rest of the row survives."""
    record = "commit.record"
    return frames.decode(
        frames.usable(_frames(spark, sf_dir)).select("event_id", "value", "partition", "offset")
    ).select(
        "event_id",
        F.col(f"{record}.createdAt").alias("created_at"),
        F.array_join(f"{record}.langs", ",").alias("langs"),
        F.col(f"{record}.text").alias("text"),
        F.col(record).isNotNull().alias("has_record"),
        F.col(f"{record}.reply").isNotNull().alias("is_reply"),
    )


@query
def frame_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frames(spark, sf_dir).select(
        "event_id", "status", "reason", "key", "time_us", F.hex("value").alias("value_hex")
    )


@query
def frame_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frames(spark, sf_dir).filter(F.col("status") == "skipped").select("event_id")


@query
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    received_at = F.timestamp_micros("received_us")
    return with_us(frames.dead_letters(_frames(spark, sf_dir), received_at))


@query
def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ingest sends on: posts under their author's key, dead letters under none."""
    sent = frames.log_messages(_frames(spark, sf_dir))
    return sent.select("topic", "key", F.hex("value").alias("value_hex"))


@query
def ingest_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.counters(_frames(spark, sf_dir))


@query
def collection_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = only_collections(events.posts_without_positions(spark, sf_dir))
    return posts.select("time_us", "did", F.col("commit.rkey").alias("rkey"), "arrival_us")


def _resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.resume_plan(derived.sessions_from_frames(_frames(spark, sf_dir)))


@query
def resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resumes(spark, sf_dir)


@query
def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = audit.first_seen(_frames(spark, sf_dir), _resumes(spark, sf_dir))
    return audit.gap_report(derived.shifted_first_seen(planned)).select(
        "session_id", "resume_us", "first_seen_us", "gap_us", "severity"
    )


# --- enrichment -------------------------------------------------------------------------------


@query
def enrich_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(_log(spark, sf_dir).withColumn("langs", F.array_join("langs", ",")))


@query
def claimed_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _posts(spark, sf_dir)
    return rows.select("uri", "rev", us("claimed_time"), "claimed_time_raw")


@query
def lag_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(spark, sf_dir).select("uri", us("observed_time"), us("claimed_time"), "lag_ms")


@query
def clock_suspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(spark, sf_dir).select(
        "uri",
        "lag_ms",
        "clock_suspect",
        (~F.col("clock_suspect") & (F.col("lag_ms") < 0)).alias("future_dated"),
    )


@query
def unparsed_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _posts(spark, sf_dir).filter(F.col("claimed_time_raw").isNotNull())
    return rows.groupBy("operation", "claimed_time_raw").agg(F.count("*").alias("posts"))


@query
def lang_primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _posts(spark, sf_dir)
    return rows.groupBy("lang_primary").agg(
        F.count("*").alias("posts"), F.count("langs").alias("with_langs")
    )


@query
def text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(spark, sf_dir).select("uri", "rev", "text_length")


@query
def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(spark, sf_dir).select("uri", "is_reply", "reply_root_uri")


@query
def raw_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_wire(_log(spark, sf_dir)).withColumn("langs", F.array_join("langs", ","))


# --- windows ----------------------------------------------------------------------------------


@query
def window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.window_counts(_posts(spark, sf_dir), FAST_DELAY_S)
    return with_us(rows.drop("emitted_at"))


@query
def window_counts_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts with copies collapsed first."""
    once = dedup.first_writes(_log(spark, sf_dir))
    return with_us(windows.window_counts(once, FAST_DELAY_S).drop("emitted_at"))


def _health(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = clocks.minute_index(F.unix_micros("window.start"))
    late_us = (minute * 7919) % 3000 * 1000
    emitted_at = F.timestamp_micros(F.unix_micros("window.end") + FAST_DELAY_S * MICROS + late_us)
    return windows.pipeline_health(_posts(spark, sf_dir), emitted_at)


@query
def pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(_health(spark, sf_dir))


@query
def clock_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(curated.clock_diagnosis(_posts(spark, sf_dir)))


# --- publication replay -----------------------------------------------------------------------


@query
def replay_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(replay.published(replay.replay(_log(spark, sf_dir)), 0))


@query
def replay_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(replay.published(replay.replay(_log(spark, sf_dir)), 1))


@query
def replay_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(replay.replay_revisions(replay.replay(_log(spark, sf_dir))))


@query
def replay_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(replay.late_rows(replay.replay(_log(spark, sf_dir))))


# --- deduplication and curated views ----------------------------------------------------------


@query
def dedup_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_writes(_log(spark, sf_dir)).select(
        "uri", "operation", "rev", "kafka_partition", "kafka_offset"
    )


@query
def duplicate_inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(dedup.duplicate_inflation(_log(spark, sf_dir)))


@query
def v_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last days of the events' own 30-day clock."""
    rows = curated.v_posts(_month(spark, sf_dir), LAST_DAY)
    return with_us(rows.withColumn("langs", F.array_join("langs", ",")))


@query
def v_skew_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(curated.v_skew_profile(_month(spark, sf_dir), LAST_DAY))


@query
def skew_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skew of creates per collection: shares and exact percentiles."""
    histogram = curated.lag_histogram(
        creates(_posts(spark, sf_dir)), {"collection": F.col("collection")}
    )
    return curated.skew_measures(histogram, ["collection"])


def _emitted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Fast rows (emitted, then emitted again) and settled rows up to the instant of asking.

    Every thirteenth minute never settled, as if the settled query had been down.
    """
    posts = enrich(events.posts_without_positions(spark, sf_dir), keep=["arrival_us"])
    fast = derived.emissions(posts, (FAST_DELAY_S, 20), FAST_DELAY_S)
    settled = derived.emissions(posts, (SETTLED_DELAY_S,), SETTLED_DELAY_S)
    minute = clocks.minute_index(F.unix_micros("window_start"))
    return fast, settled.filter((F.col("emitted_at") <= F.lit(AS_OF)) & (minute % 13 != 7))


@query
def latest_window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(dedup.latest_window_rows(_emitted(spark, sf_dir)[0]))


@query
def v_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(curated.v_revisions(*_emitted(spark, sf_dir)))


@query
def unsettled_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    revisions = curated.v_revisions(*_emitted(spark, sf_dir))
    return with_us(curated.unsettled_status(revisions, AS_OF))


@query
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(curated.freshness(_health(spark, sf_dir), AS_OF))


@query
def publish_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(curated.publish_latency(_health(spark, sf_dir)))


# --- sinks and tables -------------------------------------------------------------------------


@query
def route_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = contract.route(derived.topic_messages(spark, sf_dir))
    return routed.select("event_id", "topic", "table_name", "status")


def _as_text(spec: OutputSpec) -> Column:
    """All columns of a row in one text, so that rows of different tables can be told in one table."""
    cells = []
    for name, kind in spec.fields:
        column = F.col(name)
        if kind == "time":
            column = F.unix_micros(column)
        elif kind == "strings":
            column = F.concat(F.lit("["), F.array_join(column, ","), F.lit("]"))
        cells.append(F.coalesce(column.cast("string"), F.lit("-")))
    return F.concat_ws("|", *cells)


def _routed(spark: SparkSession, sf_dir: str) -> list[tuple[OutputSpec, DataFrame]]:
    routed = contract.route(derived.topic_messages(spark, sf_dir))
    return [(spec, contract.rows_for(routed, spec)) for spec in ROUTES.values()]


@query
def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the routed messages bring to each of the four tables."""
    parts = [
        contract.accepted(rows, spec).select(
            F.lit(spec.name).alias("table_name"), _as_text(spec).alias("row")
        )
        for spec, rows in _routed(spark, sf_dir)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def sink_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages no table takes, and why."""
    parts = [
        contract.rejected(rows, spec).select(
            F.lit(spec.name).alias("table_name"), "reject_reason", "message"
        )
        for spec, rows in _routed(spark, sf_dir)
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable frames whose row breaks the raw table's contract."""
    log = frames.usable(_frames(spark, sf_dir)).select("value", "partition", "offset")
    return contract.rejected(enrich(frames.decode(log)), RAW).select(
        "did", "rev", "operation", "reject_reason"
    )


@query
def expired_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days past retention, on the events' own 30-day clock."""
    posts = enrich(events.posts_without_positions(spark, sf_dir, speedup=1))
    expired = tables.expired_days(posts, RAW, LAST_DAY)
    return expired.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "rows")


# --- what the stored log tells ----------------------------------------------------------------

# Offsets of a bucket, small enough for the fixture to cross many of them.
SMALL_BUCKET = 256


@query
def post_lifetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delete with the create it ends, of records that are used again."""
    rows = derived.reused_records(_log(spark, sf_dir))
    return lifetimes.lifetimes(rows, SMALL_BUCKET)


@query
def lifetime_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.reused_records(_log(spark, sf_dir))
    return with_us(lifetimes.lifetime_profile(lifetimes.lifetimes(rows, SMALL_BUCKET)))


@query
def missing_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.missing_ranges(derived.with_holes(_log(spark, sf_dir)), SMALL_BUCKET)


@query
def repeated_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.repeated_ranges(derived.with_holes(_log(spark, sf_dir)), SMALL_BUCKET)


@query
def alarm_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alarm at each minute: some minutes nothing was published, some others nothing arrived."""
    arrived = events.posts_without_positions(spark, sf_dir)
    minute = clocks.minute_index(F.col("arrival_us")) - events.BASE_US // 60_000_000
    arrived = arrived.filter(~minute.between(40, 52))
    ends = clocks.minute_index(F.unix_micros("emitted_at")) - events.BASE_US // 60_000_000
    published = _health(spark, sf_dir).filter(~ends.between(15, 24) & ~ends.between(42, 53))
    return alarms.alarm_history(arrived, published)


@query
def skew_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily percentiles from stored sketches of minutes: totals, and whether each rank is near enough.

    The sketches are stored in three batches, as they would come, so most minutes have several.
    """
    folder = _folder(spark)
    once = dedup.first_writes(_month(spark, sf_dir)).cache()
    for batch_id in range(3):
        part = once.filter(F.pmod(F.col("kafka_offset"), F.lit(3)) == batch_id)
        tables.write_batch(sketches.minute_sketches(part), SKETCHES, folder, "a", batch_id)
    stored = tables.read_table(spark, folder, SKETCHES, _first_day(once), as_of=LAST_DAY)
    days = sketches.merged(stored, "DAY")
    answers = sketches.percentiles(days)
    errors = sketches.rank_errors(answers, once, "DAY")
    near = [(F.col(f"error_{p}") <= 0.025).alias(f"{p}_near") for p in ("p50", "p95", "p99")]
    return with_us(
        answers.join(errors, "window_start").select("window_start", "events", "suspect_clocks", "lags", *near)
    )


# --- stored tables ----------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"


def _first_day(rows: DataFrame) -> date:
    first = rows.agg(F.to_date(F.min("observed_time")).alias("day")).first()
    return first.day or LAST_DAY


def _store(rows: DataFrame, folder: str) -> date:
    """Write the raw table in several batches, some positions twice; returns its first day."""
    parts = F.pmod(F.col("kafka_offset"), F.lit(3))
    for batch_id in range(3):
        tables.write_batch(rows.filter(parts == batch_id), RAW, folder, "a", batch_id)
    again = rows.filter(F.pmod(F.col("kafka_offset"), F.lit(10)) == 3)
    tables.write_batch(again, RAW, folder, "b", 0)
    return _first_day(rows)


@query
def replay_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revision report replayed from the stored raw table, retried writes and all."""
    folder = _folder(spark)
    day = _store(_log(spark, sf_dir), folder)
    stored = tables.read_table(spark, folder, RAW, day, as_of=day)
    return with_us(replay.replay_revisions(replay.replay(stored, retried=True)))


@query
def replay_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revision report of a replay kept up in four parts, cut at another offset in each partition."""
    folder = _folder(spark)
    log = _log(spark, sf_dir).persist()
    ends = log.groupBy("kafka_partition").agg((F.max("kafka_offset") + 1).alias("size"))
    numbered = log.join(F.broadcast(ends), "kafka_partition")  # a row a partition
    reach = F.col("kafka_offset") * 4 + F.col("size") * F.col("kafka_partition") / 11
    part = F.least(F.floor(reach / F.col("size")), F.lit(3))
    for number in range(4):
        rows = numbered.filter(part == number).drop("size")
        replayed.extend(rows, folder, number)
    log.unpersist()
    return with_us(replay.replay_revisions(replayed.replayed(spark, folder)))


@query
def stored_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table written in batches, compacted, and read back."""
    folder = _folder(spark)
    day = _store(_log(spark, sf_dir), folder)
    tables.compact(spark, folder, RAW, day)
    stored = tables.read_table(spark, folder, RAW, day, as_of=day).drop("date")
    return with_us(stored.withColumn("langs", F.array_join("langs", ",")))


# --- streams, run to the end of what is there -------------------------------------------------

_LIVE: dict[tuple[str, str], str] = {}


def _live(spark: SparkSession, sf_dir: str) -> str:
    """Run the fast and the settled query side by side over the log, file by file in the order of
    arrival; returns the folder of their tables. Once per session: five queries read the tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LIVE:
        folder = _folder(spark)
        events.write_live_log(spark, sf_dir, f"{folder}/log")
        running = [
            start(
                file_log(spark, f"{folder}/log", max_files=1),
                f"{folder}/tables",
                f"{folder}/checkpoints",
                trigger={"availableNow": True},
            )
            for start in (streaming.start_fast, streaming.start_settled)
        ]
        for stream in running:
            stream.awaitTermination()
        _LIVE[key] = f"{folder}/tables"
    return _LIVE[key]


def _streamed(spark: SparkSession, sf_dir: str, spec: OutputSpec) -> DataFrame:
    folder, day = _live(spark, sf_dir), _first_day(_posts(spark, sf_dir))
    return tables.read_table(spark, folder, spec, day, as_of=day)


@query
def stream_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(_streamed(spark, sf_dir, COUNTS_FAST).drop("emitted_at", "date"))


@query
def stream_settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(_streamed(spark, sf_dir, COUNTS_SETTLED).drop("emitted_at", "date"))


@query
def stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_us(_streamed(spark, sf_dir, HEALTH).drop("emitted_at", "date"))


@query
def live_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the fast stream published and what the settled one made of it."""
    fast, settled = (_streamed(spark, sf_dir, spec) for spec in (COUNTS_FAST, COUNTS_SETTLED))
    return with_us(curated.v_revisions(fast, settled))


@query
def live_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates that each stream dropped as too late, per published minute."""
    every = windows.window_counts(_posts(spark, sf_dir), FAST_DELAY_S)
    late = every.select("window_start", F.col("events").alias("all_events"))
    for spec, name in ((COUNTS_FAST, "late_5s"), (COUNTS_SETTLED, "late_600s")):
        counted = _streamed(spark, sf_dir, spec).select("window_start", F.col("events").alias(name))
        how = "inner" if spec is COUNTS_FAST else "left"
        late = late.join(counted, "window_start", how)
        late = late.withColumn(name, F.col("all_events") - F.col(name))
    return with_us(late.drop("all_events"))


@query
def live_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, published by a join of the two streams of counts as they are written."""
    folder, day = _live(spark, sf_dir), _first_day(_posts(spark, sf_dir))
    running = revisions.start_revisions(
        spark, folder, f"{_folder(spark)}/checkpoints", trigger={"availableNow": True}, max_files=8
    )
    running.awaitTermination()
    fast, decided = (
        tables.read_table(spark, folder, spec, day, as_of=day) for spec in (COUNTS_FAST, REVISIONS)
    )
    return with_us(curated.v_live_revisions(fast, decided))


@query
def stream_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fast counts under the watermark of the slowest partition, one of which is silent for a while.

    A file of the log is two minutes of arrival, and so is the time between two batches.
    """
    folder = _folder(spark)
    events.write_live_log(spark, sf_dir, f"{folder}/log", silent=True)
    running = partitions.start_by_partition(
        file_log(spark, f"{folder}/log", max_files=1),
        COUNTS_FAST,
        FAST_DELAY_S,
        f"{folder}/tables",
        f"{folder}/checkpoints",
        trigger={"availableNow": True},
        clock=lambda batch_id: batch_id * events.FILE_MINUTES * 60,
    )
    running.awaitTermination()
    day = _first_day(_posts(spark, sf_dir))
    counts = tables.read_table(spark, f"{folder}/tables", COUNTS_FAST, day, as_of=day)
    return with_us(counts.drop("emitted_at", "date"))


@query
def errors_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of two batches, many of them equal, compacted and counted."""
    folder = _folder(spark)
    received = F.timestamp_micros(F.expr("received_us div 60000000 * 60000000"))
    letters = frames.dead_letters(_frames(spark, sf_dir), received)
    for batch_id in range(2):
        tables.write_batch(letters, PARSE_ERRORS, folder, "a", batch_id)
    day = _first_day(letters)
    tables.compact(spark, folder, PARSE_ERRORS, day)
    stored = tables.read_table(spark, folder, PARSE_ERRORS, day, as_of=day)
    return with_us(
        stored.groupBy("observed_time", "payload", "error").agg(F.count("*").alias("letters"))
    )
