"""Publication replay against its row-by-row definition, and its goldens."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from conftest import BASE_US, SMALL
from pyspark.sql import functions as F

from settle.operators.enrich import enrich
from settle.operators.replay import late_rows, published, replay, replay_revisions
from settle.operators.windows import window_counts
from settle.sources.events import posts_from_events

W = 60_000_000
LOG = (
    "kafka_partition int, kafka_offset bigint, observed_us bigint, did string,"
    " operation string, is_reply boolean, clock_suspect boolean, lag_ms bigint"
)


def make_log(seed: int, rows: int = 400, partitions: int = 3) -> list[tuple]:
    """A disordered log: gaps in the offsets, idle stretches, rows minutes late."""
    rng = random.Random(seed)
    log, offsets = [], defaultdict(int)
    now = BASE_US
    for _ in range(rows):
        now += rng.choice([0, 1, 3_000_000, 9_000_000, 150_000_000 if rng.random() < 0.05 else 0])
        p = rng.choice([0] * 4 + list(range(partitions)))
        offsets[p] += rng.choice([1, 1, 1, 7])
        behind = rng.choice([0, 0, 0, 2_000_000, 30_000_000, 700_000_000])
        suspect = rng.random() < 0.1
        log.append(
            (
                p,
                offsets[p],
                now - behind,
                f"d{rng.choice([0, 0, 0, 1, 2, 3])}",
                rng.choice(["create"] * 4 + ["delete", "update"]),
                rng.random() < 0.3,
                suspect,
                None if suspect else rng.randrange(-4000, 4000),
            )
        )
    return log


def expected(log: list[tuple], delay_s: float) -> dict[int, tuple]:
    """The definition: a row is late if the earlier maximum of its partition has passed its end."""
    delay = int(delay_s * 1e6)
    latest, admitted, late = {}, defaultdict(list), defaultdict(int)
    for p, _, us, *rest in sorted(log, key=lambda r: (r[0], r[1])):
        end = us // W * W + W
        if rest[1] == "create":
            if p in latest and latest[p] - delay >= end:
                late[end] += 1
            else:
                admitted[end].append(rest)
        latest[p] = max(latest.get(p, us), us)
    horizon = min(latest.values()) - delay
    counts = {}
    for end, rows in admitted.items():
        if end > horizon:
            continue
        lags = [r[4] for r in rows if not r[3]]
        mean = int(sum(lags) / len(lags)) if lags else None
        counts[end] = (
            len(rows),
            len({r[0] for r in rows}),
            sum(r[2] for r in rows),
            sum(r[3] for r in rows),
            sum(1 for r in rows if not r[3] and r[4] < 0),
            mean,
        )
    return counts, dict(late)


def frame_of(spark, log):
    return spark.createDataFrame(log, LOG).select(
        "*", F.timestamp_micros("observed_us").alias("observed_time")
    ).drop("observed_us")


def got_counts(rows) -> dict[int, tuple]:
    columns = [
        "events", "distinct_authors", "replies", "suspect_clocks", "future_dated", "avg_lag_ms"
    ]
    keyed = rows.select(F.unix_micros("window_end").alias("end"), *columns).collect()
    return {r.end: tuple(r[c] for c in columns) for r in keyed}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("broadcast_rows", [10**9, 0])
def test_matches_the_row_by_row_definition(spark, seed, broadcast_rows):
    log = make_log(seed)
    delays = (5, 600)
    replayed = replay(frame_of(spark, log), delays, broadcast_rows).persist()
    for i, delay in enumerate(delays):
        counts, late = expected(log, delay)
        assert got_counts(published(replayed, i, delays)) == counts
        got_late = {
            r[0]: r[1]
            for r in replayed.select(F.unix_micros("window_end"), f"late_{i}").collect()
            if r[1]
        }
        assert got_late == late
    replayed.unpersist()


def test_endless_patience_equals_the_plain_aggregate(spark):
    log = make_log(11)
    # nothing closes with endless patience, so compare the admitted counts themselves
    replayed = replay(frame_of(spark, log), (10**9,))
    wide = replayed.select("window_end", *[
        F.col(f"{c}_0").alias(c)
        for c in ("events", "distinct_authors", "replies", "suspect_clocks", "future_dated",
                  "avg_lag_ms")
    ])
    plain = window_counts(frame_of(spark, log), 5)
    assert got_counts(wide) == got_counts(plain)


def test_more_patience_never_counts_fewer(spark):
    delays = (0, 1, 5, 60, 600)
    rows = replay(frame_of(spark, make_log(5)), delays).collect()
    for row in rows:
        events = [row[f"events_{i}"] for i in range(len(delays))]
        assert events == sorted(events)


def test_a_silent_partition_holds_closing_back(spark):
    a = ("did", "create", False, False, 1)
    log = [(0, i, BASE_US + i * 30_000_000, *a) for i in range(40)] + [(1, 0, BASE_US, *a)]
    replayed = replay(frame_of(spark, log)).collect()
    assert not any(r.closed_0 for r in replayed)


def test_an_empty_log_publishes_nothing(spark):
    assert replay_revisions(replay(frame_of(spark, make_log(1)).filter("false"))).count() == 0


@pytest.mark.parametrize(
    ("folder", "closed", "unsettled", "revised", "published_sum", "settled_sum", "admitted"),
    [
        (SMALL, 58, 10, 12, 576, 493, (600, 613)),
        ("/root/testdata/sf0.01", 59, 10, 49, 5792, 4938, (5903, 6051)),
    ],
)
def test_goldens(
    spark, folder, closed, unsettled, revised, published_sum, settled_sum, admitted
):
    replayed = replay(enrich(posts_from_events(spark, folder))).persist()
    rows = replay_revisions(replayed).collect()
    assert len(rows) == closed
    assert sum(r.unsettled for r in rows) == unsettled
    assert sum(1 for r in rows if r.delta) == revised
    assert sum(r.published for r in rows) == published_sum
    assert sum(r.settled or 0 for r in rows) == settled_sum
    sums = replayed.agg(F.sum("events_0"), F.sum("events_1")).first()
    assert tuple(sums) == admitted
    assert late_rows(replayed).count() == replayed.count()
    replayed.unpersist()


@pytest.mark.parametrize("cuts", [(), (300,), (0, 1, 500), (40, 41, 42, 120)])
def test_a_replay_that_is_extended_equals_one_of_the_whole_log(spark, tmp_path, cuts):
    from settle.plans import replayed

    log = enrich(posts_from_events(spark, SMALL)).persist()
    # partitions are cut at different offsets
    place = F.col("kafka_offset") - 13 * F.col("kafka_partition")
    bounds = [-(10**6), *cuts, 10**6]
    parts = [log.filter(place.between(a, b - 1)) for a, b in zip(bounds, bounds[1:], strict=False)]
    for number, rows in enumerate(parts):
        for _ in range(2):  # a repeated part is not added twice
            replayed.extend(rows, str(tmp_path), number)
    found = sorted(map(tuple, replayed.replayed(spark, str(tmp_path)).collect()))
    assert found == sorted(map(tuple, replay(log).collect()))
    with pytest.raises(ValueError):
        replayed.extend(parts[0], str(tmp_path), len(parts) + 1)
    with pytest.raises(ValueError):
        replayed.replayed(spark, str(tmp_path / "nothing"))
    log.unpersist()


def test_a_part_that_did_not_end_counts_for_nothing(spark, tmp_path, monkeypatch):
    from settle.plans import replayed
    from settle.plans.commits import CommitLog

    log = enrich(posts_from_events(spark, SMALL))
    early, late = log.filter("kafka_offset < 60"), log.filter("kafka_offset >= 60")
    replayed.extend(early, str(tmp_path), 0)
    before = sorted(map(tuple, replayed.replayed(spark, str(tmp_path)).collect()))
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            replayed.extend(late, str(tmp_path), 1)
    assert sorted(map(tuple, replayed.replayed(spark, str(tmp_path)).collect())) == before
    replayed.extend(late, str(tmp_path), 1)
    assert sorted(map(tuple, replayed.replayed(spark, str(tmp_path)).collect())) == sorted(
        map(tuple, replay(log).collect())
    )
