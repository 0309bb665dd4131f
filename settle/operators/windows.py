"""One-minute window aggregates, in a form that runs unchanged as batch and as stream.

Distinct authors are counted in two steps, per (minute, author) and then per minute. Streaming
has no distinct count, and in batch it is the plan Spark would choose anyway: the busy minute is
spread over its authors, and a busy author is collapsed before the shuffle. A stream keeps state for
the first step only: a minute's authors leave it together, in the batch that closes the minute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settle.operators.enrich import creates
from settle.schema import COUNTS_FAST, HEALTH, WINDOW_S

WINDOW = f"{WINDOW_S} seconds"

# The count columns every published window carries, in contract order.
MEASURES = (
    "events",
    "distinct_authors",
    "replies",
    "suspect_clocks",
    "future_dated",
    "avg_lag_ms",
)


def per_author(included: Column, tag: str = "") -> list[Column]:
    """Aggregates of one author's included rows in one minute. ``tag`` keeps variants apart."""
    plausible = included & ~F.col("clock_suspect")
    return [
        F.count_if(included).alias(f"n{tag}"),
        F.count_if(included & F.col("is_reply")).alias(f"n_reply{tag}"),
        F.count_if(included & F.col("clock_suspect")).alias(f"n_suspect{tag}"),
        F.count_if(plausible & (F.col("lag_ms") < 0)).alias(f"n_future{tag}"),
        F.sum(F.when(plausible, F.col("lag_ms"))).alias(f"lag_sum{tag}"),
        F.count_if(plausible).alias(f"n_lag{tag}"),
    ]


def per_minute(tag: str = "") -> list[Column]:
    """The window measures from the per-author aggregates of the same tag."""
    lag_rows = F.nullif(F.sum(f"n_lag{tag}"), F.lit(0))
    return [
        F.sum(f"n{tag}").alias(f"events{tag}"),
        F.count_if((F.col(f"n{tag}") > 0) & F.col("did").isNotNull()).alias(
            f"distinct_authors{tag}"
        ),
        F.sum(f"n_reply{tag}").alias(f"replies{tag}"),
        F.sum(f"n_suspect{tag}").alias(f"suspect_clocks{tag}"),
        F.sum(f"n_future{tag}").alias(f"future_dated{tag}"),
        F.call_function("div", F.sum(f"lag_sum{tag}"), lag_rows).alias(f"avg_lag_ms{tag}"),
    ]


def author_totals(enriched: DataFrame) -> DataFrame:
    """Counts of creates and the liveness of all commits, per minute and author: the first step."""
    return enriched.groupBy(F.window("observed_time", WINDOW).alias("window"), "did").agg(
        *per_author(F.col("operation") == "create"),
        F.count("*").alias("n_all"),
        F.max("observed_time").alias("latest"),
    )


def totals_of_authors(authors: DataFrame) -> DataFrame:
    """The second step: totals per minute from all of the minute's authors."""
    return authors.groupBy("window").agg(
        *per_minute(),
        F.sum("n_all").alias("all_events"),
        F.max("latest").alias("max_observed_time"),
    )


def minute_totals(enriched: DataFrame) -> DataFrame:
    """Counts of creates and the liveness of all commits, per minute, in one chained aggregate."""
    return totals_of_authors(author_totals(enriched))


def counts_of(totals: DataFrame, delay_s: int, emitted_at: Column | None = None) -> DataFrame:
    """The published counts row; a minute without creates publishes nothing."""
    emitted_at = F.current_timestamp() if emitted_at is None else emitted_at
    return (
        totals.filter(F.col("events") > 0)
        .withColumn("window_start", F.col("window.start"))
        .withColumn("window_end", F.col("window.end"))
        .withColumn("emitted_at", emitted_at)
        .withColumn("watermark_delay_s", F.lit(delay_s))
        .select(*COUNTS_FAST.table_schema.names)
    )


def health_of(totals: DataFrame, emitted_at: Column | None = None) -> DataFrame:
    """The liveness row; any commit counts, so a minute of deletes alone still has one."""
    emitted_at = F.current_timestamp() if emitted_at is None else emitted_at
    return (
        totals.withColumn("window_end", F.col("window.end"))
        .withColumn("events", F.col("all_events"))
        .withColumn("emitted_at", emitted_at)
        .select(*HEALTH.table_schema.names)
    )


def window_counts(
    enriched: DataFrame, delay_s: int, emitted_at: Column | None = None
) -> DataFrame:
    """Counts over everything that is there (no lateness): only creates leave the scan."""
    return counts_of(minute_totals(creates(enriched)), delay_s, emitted_at)


def pipeline_health(enriched: DataFrame, emitted_at: Column | None = None) -> DataFrame:
    """Health alone, without the per-author step it does not need."""
    totals = enriched.groupBy(F.window("observed_time", WINDOW).alias("window")).agg(
        F.count("*").alias("all_events"), F.max("observed_time").alias("max_observed_time")
    )
    return health_of(totals, emitted_at)
