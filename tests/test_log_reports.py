"""Lifetimes of posts, holes and repeats of a stored log, and percentiles that merge."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from settle.operators import lifetimes, offsets, sketches
from settle.operators.dedup import first_writes
from settle.operators.enrich import enrich
from settle.sources.events import posts_from_events

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
POSTS = (
    "uri string, did string, operation string, rev string, observed_time timestamp, claimed_time timestamp, "
    "lag_ms bigint, clock_suspect boolean, kafka_partition int, kafka_offset bigint"
)

# --- lifetimes ------------------------------------------------------------------------------------


def posts(spark, rows):
    """(uri, operation, offset, second, claimed second or None), with the offset as revision."""
    out = []
    for uri, operation, offset, second, claimed in rows:
        claim = None if claimed is None else START + timedelta(seconds=claimed)
        out.append((uri, "d", operation, f"v{offset}", START + timedelta(seconds=second), claim, 0,
                    claimed is None, 0, offset))
    return spark.createDataFrame(out, POSTS)


def plain_lives(rows):
    last, out = {}, {}
    for uri, operation, offset, second, claimed in sorted(rows, key=lambda r: r[2]):
        if operation == "update":
            continue
        if operation == "delete":
            before = last.get(uri)
            if before is None:
                out[offset] = ("no create", None, None)
            elif before[0] == "delete":
                out[offset] = ("already deleted", None, None)
            else:
                told = None if before[2] is None else (second - before[2]) * 1_000_000
                out[offset] = ("deleted", (second - before[1]) * 1_000_000, told)
        last[uri] = (operation, second, claimed)
    return out


def lives(frame):
    return {r.kafka_offset: (r.status, r.lifetime_us, r.claimed_lifetime_us) for r in frame.collect()}


@pytest.mark.parametrize("bucket", [1, 4, 1 << 16])
def test_lives_by_their_definition(spark, bucket):
    """Most rows are of one record, whose history no bucket holds whole."""
    own = random.Random(bucket)
    rows = []
    for offset in range(400):
        uri = "hot" if own.random() < 0.6 else f"u{own.randrange(30)}"
        operation = own.choice(["create", "create", "delete", "update"])
        claimed = own.choice([None, offset - own.randrange(100)]) if operation == "create" else None
        rows.append((uri, operation, offset, offset * 3 - own.randrange(50), claimed))
    frame = posts(spark, rows)
    assert lives(lifetimes.lifetimes(frame, bucket)) == plain_lives(rows)
    # copies that arrive later change nothing
    again = frame.filter("kafka_offset % 3 = 0").withColumn("kafka_offset", F.col("kafka_offset") + 1000)
    assert lives(lifetimes.lifetimes(frame.unionByName(again), bucket)) == plain_lives(rows)


def test_no_record_is_sorted_whole(spark):
    plan = lifetimes.lifetimes(posts(spark, [("u", "create", 1, 1, 1)]))._jdf.queryExecution().toString()
    sorted_by = [line for line in plan.splitlines() if "Window [lag(own" in line]
    assert sorted_by and all("bucket#" in line.split("], [")[1] for line in sorted_by)


# --- holes and repeats ----------------------------------------------------------------------------


def stored(spark, held):
    rows = [(p, o) for p, found in held.items() for o in found]
    return spark.createDataFrame(rows, "kafka_partition int, kafka_offset bigint")


def plain_ranges(numbers):
    out = []
    for n in sorted(numbers):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


@pytest.mark.parametrize("bucket", [1, 8, 10, 1 << 16])
def test_ranges_by_their_definition(spark, bucket):
    own = random.Random(7)
    held = {p: [o for o in range(20, 300) if own.random() < 0.8] for p in (0, 1)}
    held[0] += [o for o in held[0] if 60 <= o <= 130 or own.random() < 0.1]
    held[1] += held[1] * 2
    held[2] = [5]
    held[3] = [0, 1000]
    log = stored(spark, held)
    missing = {(r.kafka_partition, r.first_offset, r.last_offset, r.missing)
               for r in offsets.missing_ranges(log, bucket).collect()}
    assert missing == {
        (p, a, b, b - a + 1)
        for p, found in held.items()
        for a, b in plain_ranges(set(range(min(found), max(found))) - set(found))
    }
    repeated = sorted(tuple(r) for r in offsets.repeated_ranges(log, bucket).collect())
    want = []
    for p, found in held.items():
        times = {o: found.count(o) for o in set(found)}
        for a, b in plain_ranges([o for o, n in times.items() if n > 1]):
            want.append((p, a, b, sum(n - 1 for o, n in times.items() if a <= o <= b)))
    assert repeated == sorted(want)


def test_rows_without_a_position_are_no_holes(spark):
    log = spark.createDataFrame([(None, 1), (0, None), (0, 4)], "kafka_partition int, kafka_offset bigint")
    assert offsets.missing_ranges(log).count() == offsets.repeated_ranges(log).count() == 0
    assert offsets.missing_ranges(log.limit(0)).count() == 0


# --- sketches -------------------------------------------------------------------------------------


def lag_rows(spark, lags):
    rows = [(f"u{i}", "d", "create", "v", START + timedelta(seconds=i % 7200), None, lag, lag is None, 0, i)
            for i, lag in enumerate(lags)]
    return spark.createDataFrame(rows, POSTS)


def test_merged_percentiles_are_near_however_they_were_split(spark):
    own = random.Random(3)
    rows = lag_rows(spark, [int(own.lognormvariate(7, 2)) - 500 for _ in range(20_000)])
    one = sketches.minute_sketches(rows)
    several = one.limit(0)
    for part in range(4):
        several = several.unionByName(sketches.minute_sketches(rows.filter(F.col("kafka_offset") % 4 == part)))
    for stored_ in (one, several):
        for unit, spans in (("HOUR", 2), ("DAY", 1)):
            answers = sketches.percentiles(sketches.merged(stored_, unit))
            errors = sketches.rank_errors(answers, rows, unit).collect()
            assert len(errors) == spans and sum(r.lags for r in errors) == 20_000
            assert max(max(r.error_p50, r.error_p95, r.error_p99) for r in errors) < 0.025
            assert answers.agg(F.sum("events")).first()[0] == 20_000


def test_small_and_suspect_groups(spark):
    rows = lag_rows(spark, [5, 7, 9, None])
    (found,) = sketches.percentiles(sketches.merged(sketches.minute_sketches(rows), "DAY")).collect()
    assert tuple(found)[1:] == (4, 1, 7, 9, 9)
    (found,) = sketches.percentiles(sketches.merged(sketches.minute_sketches(lag_rows(spark, [None])))).collect()
    assert tuple(found)[1:] == (1, 1, None, None, None)
    with pytest.raises(ValueError):
        sketches.merged(sketches.minute_sketches(rows), "WEEK")


def test_sketches_of_the_fixture_have_exact_totals(spark):
    once = first_writes(enrich(posts_from_events(spark, SMALL)))
    (day,) = sketches.merged(sketches.minute_sketches(once), "DAY").collect()
    assert day.events == once.filter("operation = 'create'").count()
