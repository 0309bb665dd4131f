"""Declared schemas and the fixed values of the wire contract. Nothing is inferred from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------------------------

# Topics and collection names are the wire contract shared with the producers.
POSTS_TOPIC = "bsky.posts.v1"
DEAD_LETTER_TOPIC = "bsky.posts.dlq.v1"
RAW_TOPIC = "bsky.raw.v1"
FAST_TOPIC = "bsky.counts.fast.v1"
SETTLED_TOPIC = "bsky.counts.settled.v1"
HEALTH_TOPIC = "bsky.health.v1"
DEFAULT_COLLECTIONS = ("app.bsky.feed.post",)
COMMIT_KIND = "commit"
IGNORED_KINDS = ("identity", "account")

# The two patience levels, the window, and the plausible range of a claimed time.
FAST_DELAY_S = 5
SETTLED_DELAY_S = 600
IDLE_S = 30
WINDOW_S = 60
MAX_BEHIND_MS = 30 * 24 * 3600 * 1000
MAX_AHEAD_MS = 3600 * 1000

# A sink's batch starts after so many messages, or so many seconds with what there is.
FLUSH_ROWS = 500
FLUSH_S = 10

# Resume and gap audit.
REPLAY_OVERLAP_S = 5
MAX_REPLAY_S = 3600
UPSTREAM_RETENTION_S = 36 * 3600

# Retention and reading.
RAW_RETENTION_DAYS = 14
VIEW_DAYS = 2

MICROS = 1_000_000

# --- input ------------------------------------------------------------------------------------

POST_SCHEMA = """
    time_us BIGINT,
    did STRING,
    kind STRING,
    commit STRUCT<
        rev: STRING,
        operation: STRING,
        collection: STRING,
        rkey: STRING,
        cid: STRING,
        record: STRUCT<
            createdAt: STRING,
            langs: ARRAY<STRING>,
            text: STRING,
            reply: STRUCT<root: STRUCT<uri: STRING>>
        >
    >
"""

# One message of the log, whatever carried it: Kafka's own columns, or a file of the same shape.
LOG_SCHEMA = "value BINARY, partition INT, offset BIGINT"

# --- outputs ----------------------------------------------------------------------------------

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "strings": T.ArrayType(T.StringType()),
    "time": T.TimestampType(),
    "double": T.DoubleType(),
    "binary": T.BinaryType(),
}

_COUNTS = """
    window_start time, window_end time, events long, distinct_authors long, replies long,
    suspect_clocks long, future_dated long, avg_lag_ms long, emitted_at time,
    watermark_delay_s int
"""
_RAW = """
    uri string, did string, collection string, rkey string, rev string, operation string,
    observed_time time, claimed_time time, claimed_time_raw string, lag_ms long,
    clock_suspect bool, langs strings, lang_primary string, text_length int,
    is_reply bool, reply_root_uri string, kafka_partition int, kafka_offset long
"""
_HEALTH = "window_end time, max_observed_time time, events long, emitted_at time"
_ERRORS = "observed_time time, payload string, error string"
_SKETCHES = "window_start time, events long, suspect_clocks long, lags binary"
_ALARMS = "checked_at time, status string, last_window_end time, last_heard time"
_REVISIONS = """
    window_start time, window_end time, published long, settled long, delta long,
    pct_revision double, avg_lag_ms long, suspect_clocks long, future_dated long, unsettled bool
"""


@dataclass(frozen=True)
class OutputSpec:
    """One output: its topic, its table, its columns in order, and the ones that may not be NULL.

    The column list is written once; the wire form renders timestamps as strings and the stored
    form keeps them as timestamps, so the two cannot drift apart.
    """

    name: str
    topic: str | None
    columns: str
    required: tuple[str, ...]
    date_from: str
    cluster_by: tuple[str, ...] = ()
    retention_days: int | None = None
    # One row a minute: written as one file per day instead of one per shuffle partition.
    one_row_a_minute: bool = False

    @property
    def fields(self) -> list[tuple[str, str]]:
        return [tuple(column.split()) for column in self.columns.split(",")]

    @property
    def times(self) -> tuple[str, ...]:
        return tuple(name for name, kind in self.fields if kind == "time")

    @property
    def table_schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in self.fields])

    @property
    def wire_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, _TYPES["string" if kind == "time" else kind])
                for name, kind in self.fields
            ]
        )


RAW = OutputSpec(
    "posts",
    RAW_TOPIC,
    _RAW,
    ("uri", "did", "observed_time"),
    "observed_time",
    ("collection", "operation", "did"),
    RAW_RETENTION_DAYS,
)
COUNTS_FAST = OutputSpec(
    "window_counts_fast",
    FAST_TOPIC,
    _COUNTS,
    ("window_start", "window_end"),
    "window_start",
    one_row_a_minute=True,
)
COUNTS_SETTLED = OutputSpec(
    "window_counts_settled",
    SETTLED_TOPIC,
    _COUNTS,
    ("window_start", "window_end"),
    "window_start",
    one_row_a_minute=True,
)
HEALTH = OutputSpec(
    "pipeline_health",
    HEALTH_TOPIC,
    _HEALTH,
    ("window_end",),
    "window_end",
    one_row_a_minute=True,
)
PARSE_ERRORS = OutputSpec(
    "parse_errors",
    None,
    _ERRORS,
    ("observed_time",),
    "observed_time",
    retention_days=RAW_RETENTION_DAYS,
)

REVISIONS = OutputSpec(
    "revisions",
    None,
    _REVISIONS,
    ("window_start", "window_end"),
    "window_start",
    one_row_a_minute=True,
)

# Several rows of a minute add up, so equal ones are no copies.
SKETCHES = OutputSpec("lag_sketches", None, _SKETCHES, ("window_start",), "window_start")

ALARMS = OutputSpec("alarms", None, _ALARMS, ("checked_at", "status"), "checked_at")

OUTPUTS = (RAW, COUNTS_FAST, COUNTS_SETTLED, HEALTH, PARSE_ERRORS, REVISIONS, SKETCHES, ALARMS)
ROUTES = {spec.topic: spec for spec in OUTPUTS if spec.topic}
