"""Curated views. Every read collapses at-least-once copies first; a retry is not a revision."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.operators.dedup import first_writes, latest_window_rows
from settle.operators.enrich import creates
from settle.operators.quantiles import exact_quantiles
from settle.operators.windows import WINDOW
from settle.schema import REVISIONS, SETTLED_DELAY_S, VIEW_DAYS

PERCENTS = {"p50_lag_ms": 50, "p95_lag_ms": 95, "p99_lag_ms": 99}
_TOTALS = ("events", "suspect_clocks", "future_dated", "backdated")


def day(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def instant(as_of: datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of)


def recent(raw: DataFrame, as_of: date | None = None, days: int = VIEW_DAYS) -> DataFrame:
    """Rows observed on or after the day ``days`` before ``as_of``: a range the scan can use.

    A stored table also has its partition column ``date``, which is bounded with the same day.
    """
    first = F.date_sub(day(as_of), days)
    rows = raw.filter(F.col("observed_time") >= first.cast("timestamp"))
    return rows.filter(F.col("date") >= first) if "date" in raw.columns else rows


def v_posts(raw: DataFrame, as_of: date | None = None, days: int = VIEW_DAYS) -> DataFrame:
    """Recent raw posts, each write once."""
    return first_writes(recent(raw, as_of, days))


def revision_columns() -> list[Column | str]:
    """The revision report from rows with ``published`` and ``settled`` counts of a window."""
    delta = F.col("settled") - F.col("published")
    return [
        "window_start",
        "window_end",
        "published",
        "settled",
        delta.alias("delta"),
        F.try_divide(delta, F.col("published")).alias("pct_revision"),
        "avg_lag_ms",
        "suspect_clocks",
        "future_dated",
        F.col("settled").isNull().alias("unsettled"),
    ]


def v_revisions(fast: DataFrame, settled: DataFrame) -> DataFrame:
    """What was published, what proved true, and the revision between them, per window."""
    later = latest_window_rows(settled).select("window_start", F.col("events").alias("settled"))
    return (
        latest_window_rows(fast)
        .withColumnRenamed("events", "published")
        .join(later, "window_start", "left")
        .select(*revision_columns())
    )


def v_live_revisions(fast: DataFrame, decided: DataFrame) -> DataFrame:
    """The revisions a stream has published, and the windows it has not decided yet as unsettled."""
    published = decided.select(*REVISIONS.table_schema.names).dropDuplicates(["window_start"])
    waiting = latest_window_rows(fast).join(published, "window_start", "left_anti")
    waiting = waiting.withColumnRenamed("events", "published")
    return published.unionByName(
        waiting.withColumn("settled", F.lit(None).cast("long")).select(*revision_columns())
    )


def lag_histogram(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Rows per group and plausible lag (``lag`` is NULL for suspect clocks)."""
    lag = F.when(~F.col("clock_suspect"), F.col("lag_ms"))
    return rows.groupBy(*[c.alias(n) for n, c in keys.items()], lag.alias("lag")).agg(
        F.count("*").alias("n")
    )


def skew_measures(histogram: DataFrame, keys: list[str]) -> DataFrame:
    """Totals and lag percentiles per group from its histogram, read once from the rows."""
    lag, n = F.col("lag"), F.col("n")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    measures = [
        F.sum("n").alias("events"),
        total(lag.isNull()).alias("suspect_clocks"),
        total(lag < 0).alias("future_dated"),
        total(lag > 0).alias("backdated"),
    ]
    # as one struct, so that a NULL key is a group like any other and finds itself in a join
    histogram = histogram.select(F.struct(*keys).alias("keys"), "lag", "n")
    exact = exact_quantiles(histogram, ["keys"], "lag", PERCENTS, weight="n")
    return histogram.groupBy("keys").agg(*measures).join(exact, "keys", "left").select(
        "keys.*", *(name for name in (*_TOTALS, *PERCENTS))
    )


def skew_measures_approx(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The percentiles alone from one fixed-size sketch per group, for a quick look."""
    lag = F.when(~F.col("clock_suspect"), F.col("lag_ms"))
    sketches = [
        F.percentile_approx(lag, percent / 100).alias(name) for name, percent in PERCENTS.items()
    ]
    return rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(*sketches)


def v_skew_profile(
    raw: DataFrame, as_of: date | None = None, days: int = VIEW_DAYS
) -> DataFrame:
    """Clock skew per minute over recent creates, each write once; percentiles are exact."""
    rows = first_writes(creates(recent(raw, as_of, days)))
    minute = F.date_trunc("MINUTE", F.col("observed_time"))
    return skew_measures(lag_histogram(rows, {"window_start": minute}), ["window_start"])


def freshness(health: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """End and age of the newest closed window. Whoever watches it should expect no row at all from an
    idle pipeline, and treat a growing age as the fault."""
    newest = F.max("window_end")
    return health.agg(
        newest.alias("last_window_end"),
        (F.unix_millis(instant(as_of)) - F.unix_millis(newest)).alias("age_ms"),
    )


def publish_latency(health: DataFrame) -> DataFrame:
    """How long after its end each window was written out."""
    return health.select(
        "window_end",
        "max_observed_time",
        (F.unix_millis("emitted_at") - F.unix_millis("window_end")).alias("latency_ms"),
    )


def unsettled_status(
    revisions: DataFrame, as_of: datetime | None = None, delay_s: int = SETTLED_DELAY_S
) -> DataFrame:
    """Split windows that have not settled by age: not due yet, or a stalled pipeline."""
    due = F.timestamp_micros(F.unix_micros("window_end") + delay_s * 1_000_000)
    status = (
        F.when(~F.col("unsettled"), "settled")
        .when(instant(as_of) < due, "not due yet")
        .otherwise("stalled")
    )
    return revisions.select("window_start", "window_end", status.alias("status"))


def clock_diagnosis(enriched: DataFrame) -> DataFrame:
    """Suspect clocks beside unparsed claims, per minute of creates.

    Read together they say who is at fault: suspects whose claims do parse point at authors' clocks,
    suspects whose claims do not at a changed time format.
    """
    return (
        creates(enriched)
        .groupBy(F.window("observed_time", WINDOW).alias("window"))
        .agg(
            F.count("*").alias("events"),
            F.count_if("clock_suspect").alias("suspect_clocks"),
            F.count_if(F.col("claimed_time_raw").isNotNull()).alias("unparsed_claims"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            "events",
            "suspect_clocks",
            "unparsed_claims",
            F.try_divide("suspect_clocks", "events").alias("suspect_rate"),
            F.try_divide("unparsed_claims", "events").alias("unparsed_rate"),
        )
    )
