"""Deduplication, revisions, percentiles and the reports built on them."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timezone

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from settle.operators import dedup
from settle.operators.enrich import enrich
from settle.operators.quantiles import exact_quantiles
from settle.plans import curated
from settle.sources.events import posts_from_events

COUNTS = (
    "window_start timestamp, window_end timestamp, events bigint, distinct_authors bigint,"
    " replies bigint, suspect_clocks bigint, future_dated bigint, avg_lag_ms bigint,"
    " emitted_at timestamp, watermark_delay_s int"
)


def at(minute: int, second: int = 0) -> datetime:
    return datetime(2024, 1, 1, 0, minute, second, tzinfo=timezone.utc)


def counts_row(minute: int, events: int, emitted: datetime, lag: int = 7) -> tuple:
    return (at(minute), at(minute + 1), events, 1, 0, 2, 3, lag, emitted, 5)


def test_the_last_emission_of_a_window_counts_and_nothing_fans_out(spark):
    fast = spark.createDataFrame(
        [
            counts_row(0, 10, at(1, 5), lag=1),
            counts_row(0, 12, at(1, 9), lag=2),
            counts_row(1, 8, at(2, 5)),
            counts_row(1, 8, at(2, 5)),
            counts_row(2, 0, at(3, 5)),
            counts_row(3, 4, at(4, 5)),
        ],
        COUNTS,
    )
    settled = spark.createDataFrame(
        [
            counts_row(0, 99, at(10)),
            counts_row(0, 15, at(11)),
            counts_row(1, 8, at(12)),
            counts_row(2, 3, at(13)),
        ],
        COUNTS,
    )
    rows = curated.v_revisions(fast, settled).orderBy("window_start").collect()
    got = [(r.published, r.settled, r.delta, r.pct_revision, r.unsettled) for r in rows]
    assert got == [
        (12, 15, 3, 0.25, False),
        (8, 8, 0, 0.0, False),
        (0, 3, 3, None, False),
        (4, None, None, None, True),
    ]
    # the explanatory columns come from what was published
    assert (rows[0].avg_lag_ms, rows[0].suspect_clocks, rows[0].future_dated) == (2, 2, 3)


def test_of_two_rows_emitted_together_the_more_complete_one_counts(spark):
    rows = spark.createDataFrame(
        [counts_row(0, 3, at(1, 5)), counts_row(0, 5, at(1, 5))], COUNTS
    )
    assert dedup.latest_window_rows(rows).first().events == 5


def test_windows_that_did_not_settle_are_told_apart_by_age(spark):
    fast = spark.createDataFrame([counts_row(m, 1, at(m + 1, 5)) for m in (0, 1, 2)], COUNTS)
    settled = spark.createDataFrame([counts_row(0, 1, at(11))], COUNTS)
    revisions = curated.v_revisions(fast, settled)
    rows = curated.unsettled_status(revisions, at(12)).orderBy("window_start").collect()
    assert [r.status for r in rows] == ["settled", "stalled", "not due yet"]


RAW = (
    "uri string, operation string, rev string, kafka_partition int, kafka_offset bigint,"
    " observed_time timestamp, clock_suspect boolean, lag_ms bigint"
)


def raw(uri, operation, rev, offset, when, suspect=False, lag=1, partition=0):
    return (uri, operation, rev, partition, offset, when, suspect, lag)


def test_first_write_wins_per_uri_operation_and_rev(spark):
    rows = spark.createDataFrame(
        [
            raw("u", "create", "1", 9, at(0)),
            raw("u", "create", "1", 7, at(0)),
            raw("u", "update", "1", 8, at(0)),
            raw("u", "create", "2", 6, at(0)),
            raw(None, "create", "1", 5, at(0)),
            raw(None, "create", "1", 4, at(0)),
        ],
        RAW,
    )
    kept = {(r.uri, r.operation, r.rev, r.kafka_offset) for r in dedup.first_writes(rows).collect()}
    assert kept == {
        ("u", "create", "1", 7),
        ("u", "update", "1", 8),
        ("u", "create", "2", 6),
        (None, "create", "1", 4),
    }


def test_copies_are_reduced_before_the_shuffle(spark):
    rows = spark.createDataFrame([raw("u", "create", "1", 9, at(0))], RAW)
    plan = dedup.first_writes(rows)._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan and partial > exchange  # below the exchange in the tree


def test_retried_table_writes_are_removed_by_position(spark):
    rows = spark.createDataFrame([raw("u", "create", "1", 9, at(0))] * 3, RAW)
    assert dedup.one_per_position(rows).count() == 1


def test_duplicate_inflation(spark):
    rows = [raw("a", "create", "1", i, at(0)) for i in range(50)]
    rows += [raw("b", "create", "1", 60, at(0)), raw("b", "delete", "1", 61, at(0))]
    rows += [raw("c", "create", "1", 70, at(1)), raw("c", "create", "1", 71, at(2))]
    # the same offset in two partitions: the lower partition was first
    rows += [raw("d", "create", "1", 80, at(3), partition=1), raw("d", "create", "1", 80, at(4))]
    got = dedup.duplicate_inflation(spark.createDataFrame(rows, RAW)).collect()
    assert {(r.window_start.minute, r.raw_events, r.deduped_events, r.inflation) for r in got} == {
        (0, 51, 2, 49),
        (1, 1, 1, 0),
        (2, 1, 0, 1),
        (3, 1, 0, 1),
        (4, 1, 1, 0),
    }


def test_views_reach_two_days_back(spark):
    def on(day: int, hour: int = 0) -> datetime:
        return datetime(2024, 1, day, hour, tzinfo=timezone.utc)

    rows = spark.createDataFrame(
        [raw(f"u{d}", "create", "1", d, on(d, 23 if d == 7 else 0)) for d in range(6, 11)], RAW
    )
    kept = {r.uri for r in curated.v_posts(rows, date(2024, 1, 10)).collect()}
    assert kept == {"u8", "u9", "u10"}


def test_the_date_bound_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([raw("u", "create", "1", 1, at(0))], RAW).write.parquet(path)
    rows = curated.v_posts(spark.read.parquet(path), date(2024, 1, 2))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(observed_time" in plan


def nearest_rank(values: list[int], percent: int) -> int:
    ordered = sorted(values)
    return ordered[math.ceil(len(ordered) * percent / 100) - 1]


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_are_exact(spark, seed):
    rng = random.Random(seed)
    groups = {
        "wide": [rng.randrange(-3_600_000, 2_592_000_000) for _ in range(700)],
        "hot": [1000] * 900 + [rng.randrange(0, 5000) for _ in range(90)],
        "negative": [-rng.randrange(1, 200_000) for _ in range(301)],
        "edges": [-65_537, -65_536, -1, 0, 65_535, 65_536],
        "one": [42],
        "nothing": [],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("nothing", None), ("hot", None)]
    counted = (
        spark.createDataFrame(rows, "k string, v bigint")
        .groupBy("k", "v")
        .agg(F.count("*").alias("n"))
    )
    percents = {"p1": 1, "p50": 50, "p95": 95, "p99": 99, "p100": 100}
    got = exact_quantiles(counted, ["k"], "v", percents, "n").collect()
    want = {
        k: tuple(nearest_rank(vs, p) for p in percents.values()) for k, vs in groups.items() if vs
    }
    assert {r.k: tuple(r[name] for name in percents) for r in got} == want


def test_skew_profile_of_a_minute_of_suspect_clocks(spark):
    rows = [raw(f"u{i}", "create", "1", i, at(0), suspect=True, lag=None) for i in range(3)]
    rows += [raw(f"w{i}", "create", "1", 10 + i, at(1), lag=lag) for i, lag in enumerate((-5, 0, 9))]
    rows += [raw("x", "delete", "1", 30, at(1), lag=None, suspect=True)]
    got = curated.v_skew_profile(spark.createDataFrame(rows, RAW), date(2024, 1, 1))
    assert [tuple(r)[1:] for r in got.orderBy("window_start").collect()] == [
        (3, 3, 0, 0, None, None, None),
        (3, 0, 1, 1, 0, 9, 9),
    ]


def test_skew_profile_shuffles_its_posts_and_its_histogram_once(spark):
    profile = curated.v_skew_profile(enrich(posts_from_events(spark, SMALL)), date(2024, 1, 2))
    profile.collect()
    plan = profile._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(uri") == 1
    assert plan.count("ReusedExchange") == 2


def test_a_missing_key_is_a_group_of_its_own(spark):
    rows = [raw(f"u{i}", "create", "1", i, at(0), lag=i) for i in range(10)]
    frame = spark.createDataFrame(rows, RAW)
    kind = F.when(F.col("lag_ms") >= 4, F.lit("late"))
    got = curated.skew_measures(curated.lag_histogram(frame, {"kind": kind}), ["kind"]).collect()
    assert {(r.kind, r.events, r.p50_lag_ms) for r in got} == {(None, 4, 1), ("late", 6, 6)}


def test_approximate_percentiles_are_close(spark):
    rows = [raw(f"u{i}", "create", "1", i, at(0), lag=i) for i in range(1000)]
    minute = {"window_start": F.date_trunc("MINUTE", F.col("observed_time"))}
    row = curated.skew_measures_approx(spark.createDataFrame(rows, RAW), minute).first()
    assert abs(row.p50_lag_ms - 500) <= 5 and abs(row.p99_lag_ms - 990) <= 5


def test_freshness_and_latency(spark):
    health = spark.createDataFrame(
        [(at(1), at(0, 59), 5, at(1, 6)), (at(2), at(1, 30), 1, at(2, 8))],
        "window_end timestamp, max_observed_time timestamp, events bigint, emitted_at timestamp",
    )
    row = curated.freshness(health, at(5)).first()
    assert row.age_ms == 180_000
    latencies = curated.publish_latency(health).orderBy("window_end").collect()
    assert [r.latency_ms for r in latencies] == [6000, 8000]
