"""Contracts, routing, and the stored tables."""

from __future__ import annotations

import os
import shutil
from datetime import date, datetime, timezone

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from settle.operators import contract
from settle.operators.enrich import enrich
from settle.operators.windows import pipeline_health, window_counts
from settle.plans import tables
from settle.schema import COUNTS_FAST, HEALTH, OUTPUTS, RAW, ROUTES
from settle.sources.events import posts_from_events

DAY = date(2024, 1, 1)
HEALTH_ROW = "window_end timestamp, max_observed_time timestamp, events bigint, emitted_at timestamp"


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 1, day, hour, tzinfo=timezone.utc)


def health(spark, *rows):
    return spark.createDataFrame(list(rows), HEALTH_ROW)


def test_the_pipeline_fulfils_its_contracts(spark):
    posts = enrich(posts_from_events(spark, SMALL))
    for rows, spec in (
        (posts, RAW),
        (window_counts(posts, 5), COUNTS_FAST),
        (pipeline_health(posts), HEALTH),
    ):
        assert contract.conform(rows, spec) is rows


def test_other_columns_are_refused_before_any_write(spark, tmp_path):
    good = health(spark, (at(1), at(1), 1, at(1)))
    for bad in (
        good.drop("events"),
        good.withColumn("extra", F.lit(1)),
        good.withColumn("events", F.col("events").cast("int")),
        good.select(*reversed(good.columns)),
    ):
        with pytest.raises(contract.ContractError):
            tables.write_batch(bad, HEALTH, str(tmp_path), "r", 0)
    assert os.listdir(tmp_path) == []


def test_a_bad_row_fails_the_batch_or_is_quarantined(spark, tmp_path):
    rows = health(spark, (at(1), at(1), 1, at(1)), (None, at(1), 2, at(1)))
    with pytest.raises(Exception, match="window_end is NULL"):
        tables.write_batch(rows, HEALTH, str(tmp_path / "a"), "r", 0)
    root = str(tmp_path / "b")
    tables.write_batch(rows, HEALTH, root, "r", 0, on_reject="quarantine")
    assert tables.read_table(spark, root, HEALTH, DAY).count() == 1
    rejects = spark.read.parquet(f"{root}/pipeline_health_rejects").collect()
    assert [(r.events, r.reject_reason) for r in rejects] == [(2, "window_end is NULL")]


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    first = health(spark, (at(1), at(1), 1, at(1)))
    for _ in range(2):
        tables.write_batch(first, HEALTH, root, "r", 0)
    tables.write_batch(health(spark, (at(1, 1), at(1), 2, at(1))), HEALTH, root, "r", 1)
    tables.write_batch(health(spark, (at(1, 2), at(1), 3, at(1))), HEALTH, root, "new", 0)
    rows = tables.read_table(spark, root, HEALTH, DAY)
    assert sorted(r.events for r in rows.collect()) == [1, 2, 3]


def test_reading_prunes_days(spark, tmp_path):
    root = str(tmp_path)
    rows = health(spark, *[(at(d), at(d), d, at(d)) for d in (1, 2, 3, 4)])
    tables.write_batch(rows, HEALTH, root, "r", 0)
    read = tables.read_table(spark, root, HEALTH, date(2024, 1, 2), until=date(2024, 1, 3))
    assert sorted(r.events for r in read.collect()) == [2, 3]
    assert "PartitionFilters: [isnotnull(date" in read._jdf.queryExecution().toString()
    with pytest.raises(TypeError):
        tables.read_table(spark, root, HEALTH)


def _raw(spark, *days):
    posts = enrich(posts_from_events(spark, SMALL))
    row = posts.limit(1)
    frames = [row.withColumn("observed_time", F.lit(at(d, 12))) for d in days]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def test_retention_hides_and_then_drops_days(spark, tmp_path):
    root = str(tmp_path)
    rows = _raw(spark, 1, 2, 3)
    tables.write_batch(rows, RAW, root, "r", 0)
    as_of = date(2024, 1, 16)
    live = tables.read_table(spark, root, RAW, DAY, as_of=as_of)
    assert [r.date for r in live.select("date").collect()] == [date(2024, 1, 3)]
    expired = tables.expired_days(rows, RAW, as_of).orderBy("date").collect()
    assert [(r.date.day, r.rows) for r in expired] == [(1, 1), (2, 1)]
    dropped = tables.drop_expired(spark, root, RAW, as_of)
    assert sorted(p[-2:] for p in dropped) == ["01", "02"]
    assert tables.drop_expired(spark, root, RAW, as_of) == []
    assert tables.drop_expired(spark, root, HEALTH, as_of) == []
    assert spark.read.parquet(f"{root}/posts").count() == 1


def test_backfills_are_clustered_and_complete(spark, tmp_path):
    posts = enrich(posts_from_events(spark, SMALL))
    tables.write_clustered(posts, RAW, str(tmp_path), "backfill")
    stored = tables.read_table(spark, str(tmp_path), RAW, DAY, as_of=DAY).drop("date")
    assert stored.exceptAll(posts).count() == 0 and stored.count() == posts.count()


def test_rows_survive_the_wire(spark):
    posts = enrich(posts_from_events(spark, SMALL))
    counts = window_counts(posts, 5)
    for rows, spec in ((posts, RAW), (counts, COUNTS_FAST)):
        to_ms = [
            F.timestamp_millis(F.unix_millis(n)).alias(n) if n in spec.times else F.col(n)
            for n in spec.table_schema.names
        ]
        rows = rows.select(*to_ms)
        if "emitted_at" in rows.columns:
            rows = rows.withColumn("emitted_at", F.lit(at(1)))
        routed = contract.route(contract.to_messages(rows, spec))
        back = contract.accepted(contract.rows_for(routed, spec), spec)
        assert contract.conform(back, spec) is back
        assert back.exceptAll(rows).count() == 0 and back.count() == rows.count()


def test_routing(spark):
    messages = spark.createDataFrame(
        [
            (1, "bsky.health.v1", bytearray(b'{"events": 3}')),
            (2, "bsky.health.v1", bytearray(b"{not json")),
            (3, "bsky.unknown.v1", bytearray(b'{"events": 3}')),
            (4, "bsky.raw.v1", bytearray(b'{"uri": "u"} x')),
            (5, "bsky.raw.v1", None),
        ],
        "id int, topic string, value binary",
    )
    routed = contract.route(messages)
    assert {(r.id, r.table_name, r.status) for r in routed.collect()} == {
        (1, "pipeline_health", "routed"),
        (2, "pipeline_health", "unparseable"),
        (3, None, "unrouted"),
        (4, "posts", "unparseable"),
        (5, "posts", "unparseable"),
    }
    assert [r.events for r in contract.rows_for(routed, HEALTH).collect()] == [3]


def messages(spark, *bodies, topic=HEALTH.topic):
    rows = [(topic, bytearray(body.encode())) for body in bodies]
    return contract.route(spark.createDataFrame(rows, "topic string, value binary"))


END = '"window_end":"2024-01-01 00:01:00.000"'


@pytest.mark.parametrize(
    ("body", "reason"),
    [
        ("{%s,\"events\":\"abc\"}", "events is not of type bigint"),
        ("{%s,\"events\":1.5}", "events is not of type bigint"),
        ("{%s,\"events\":true}", "events is not of type bigint"),
        ("{%s,\"events\":99999999999999999999}", "events is not of type bigint"),
        ("{%s,\"evnts\":7}", "unknown member evnts"),
        ("{%s,\"emitted_at\":\"noon\"}", "emitted_at is not of type timestamp"),
        ("{%s,\"emitted_at\":7}", "emitted_at is not of type timestamp"),
        ("[{%s}]", "message is not an object"),
        ("{\"events\":7}", "window_end is NULL"),
        ("{\"window_end\":null}", "window_end is NULL"),
        ("{%s,\"events\":null}", None),
        ("{%s}", None),
    ],
)
def test_damaged_messages_are_rejected_with_their_reason(spark, tmp_path, body, reason):
    body = body.replace("%s", END)
    rows = contract.rows_for(messages(spark, body), HEALTH)
    root = str(tmp_path)
    if reason:
        with pytest.raises(Exception, match=reason):
            tables.write_batch(rows, HEALTH, root, "r", 0, on_reject="fail")
    tables.write_batch(rows, HEALTH, root, "q", 0, on_reject="quarantine")
    rejects = tables.read_rejects(spark, root, HEALTH, DAY).collect()
    assert [(r.message, r.reject_reason) for r in rejects] == ([(body, reason)] if reason else [])
    assert tables.read_table(spark, root, HEALTH, DAY).count() == (reason is None)


def folders(root, table):
    return sorted(d for d in os.listdir(f"{root}/{table}") if d.startswith("date="))


def test_only_the_days_asked_for_are_listed(spark, tmp_path):
    root = str(tmp_path)
    rows = health(spark, *[(at(d), at(d), d, at(d)) for d in (1, 2, 3, 4)])
    tables.write_batch(rows, HEALTH, root, "r", 0)
    assert folders(root, "pipeline_health") == [f"date=2024-01-0{d}" for d in (1, 2, 3, 4)]
    read = tables.read_table(spark, root, HEALTH, date(2024, 1, 2), until=date(2024, 1, 3))
    assert {f.split("date=")[1][:10] for f in read.inputFiles()} == {"2024-01-02", "2024-01-03"}
    assert tables.read_table(spark, root, HEALTH, date(2025, 1, 1)).count() == 0
    assert tables.read_table(spark, root, RAW, DAY).count() == 0


def test_empty_batches_leave_no_folder(spark, tmp_path):
    root = str(tmp_path)
    tables.write_batch(health(spark).filter("false"), HEALTH, root, "r", 0, "quarantine")
    assert folders(root, "pipeline_health") == folders(root, "pipeline_health_rejects") == []


def test_compaction_is_safe_to_repeat(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(5):
        rows = health(spark, (at(1, batch), at(1), batch, at(1)), (at(2, batch), at(2), 9, at(2)))
        tables.write_batch(rows, HEALTH, root, "r", batch)
    tables.write_batch(health(spark, (at(1, 0), at(1), 0, at(1))), HEALTH, root, "again", 0)
    assert tables.compact(spark, root, HEALTH, DAY) == 6
    stored = tables.read_table(spark, root, HEALTH, DAY, until=DAY)
    assert sorted(r.events for r in stored.collect()) == [0, 1, 2, 3, 4]
    assert len(stored.inputFiles()) == 1
    assert tables.compact(spark, root, HEALTH, DAY) == 0
    assert tables.compact(spark, root, HEALTH, date(2024, 2, 1)) == 0
    # stopped before the old folders were deleted: the rows are there twice, and then once again
    old = f"{root}/pipeline_health/date={DAY}"
    shutil.copytree(f"{old}/{os.listdir(old)[0]}", f"{old}/run=left-over")
    assert tables.read_table(spark, root, HEALTH, DAY, until=DAY).count() == 10
    assert tables.compact(spark, root, HEALTH, DAY) == 2
    assert tables.read_table(spark, root, HEALTH, DAY, until=DAY).count() == 5
    assert tables.read_table(spark, root, HEALTH, date(2024, 1, 2)).count() == 5


def test_rejects_expire_with_their_table(spark, tmp_path):
    root = str(tmp_path)
    bad = _raw(spark, 1, 3).withColumn("uri", F.lit(None).cast("string"))
    tables.write_batch(bad, RAW, root, "r", 0, on_reject="quarantine")
    assert tables.read_rejects(spark, root, RAW, DAY).count() == 2
    dropped = tables.drop_expired(spark, root, RAW, date(2024, 1, 15))
    assert [p.rpartition("/")[2] for p in dropped] == ["date=2024-01-01"]
    assert folders(root, "posts_rejects") == ["date=2024-01-03"]


def test_outputs_agree_with_each_other():
    assert len(ROUTES) == 4
    assert all(topic.rpartition(".v")[2].isdigit() for topic in ROUTES)
    for spec in OUTPUTS:
        assert spec.wire_schema.names == spec.table_schema.names
        assert set(spec.required) <= set(spec.table_schema.names)
        assert spec.date_from in spec.required
    assert [s.name for s in OUTPUTS if s.retention_days] == ["posts", "parse_errors"]
    names = {s.name: s for s in OUTPUTS}
    assert names["window_counts_fast"].columns == names["window_counts_settled"].columns
