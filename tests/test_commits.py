"""Commit records, compaction under them, the live join of revisions, and the partition watermark."""

from __future__ import annotations

import json
import os
from datetime import date, datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import BASE_US, LogFolder, post
from pyspark.sql import functions as F

from settle.operators import contract
from settle.plans import curated, tables
from settle.plans.commits import CommitLog
from settle.schema import (
    COUNTS_FAST,
    COUNTS_SETTLED,
    HEALTH,
    OUTPUTS,
    PARSE_ERRORS,
    RAW,
    REVISIONS,
    ROUTES,
)
from settle.sources.log import file_log
from settle.streaming import partitions, queries, revisions

DAY = date(2024, 1, 1)
HEALTH_ROW = "window_end timestamp, max_observed_time timestamp, events bigint, emitted_at timestamp"
ERROR_ROW = "observed_time timestamp, payload string, error string"


def at(hour: float) -> datetime:
    return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=hour)


def read(spark, root, spec):
    return tables.read_table(spark, str(root), spec, DAY, until=DAY, as_of=DAY)


# --- one record for all tables --------------------------------------------------------------------


def routed(spark, minutes):
    """A message for each of the four tables, for each minute."""
    rows = []
    for minute in minutes:
        end = f"2024-01-01 00:{minute:02d}:00.000"
        window = {"window_start": end, "window_end": end, "events": minute}
        raw = {"uri": f"u{minute}", "did": "d", "observed_time": end}
        for topic, spec in ROUTES.items():
            body = raw if spec is RAW else {"window_end": end} if spec is HEALTH else window
            rows.append((topic, bytearray(json.dumps(body).encode())))
    return contract.route(spark.createDataFrame(rows, "topic string, value binary"))


@pytest.fixture
def as_run(spark):
    def name(run):
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", run)

    yield name
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def seen(spark, root):
    return {spec.name: read(spark, root, spec).count() for spec in ROUTES.values()}


def test_readers_see_all_tables_of_a_batch_or_none(spark, tmp_path, as_run, monkeypatch):
    as_run("sink")
    root = str(tmp_path)
    write = queries.publish_routed(root)
    write(routed(spark, [1]), 0)
    assert set(seen(spark, root).values()) == {1}
    names = list(ROUTES.values())
    stored = queries.write_batch
    for dies_at in range(1, len(names)):

        def killed(rows, spec, *rest, dies_at=dies_at):
            if spec is names[dies_at]:
                raise RuntimeError("killed")
            stored(rows, spec, *rest)

        monkeypatch.setattr(queries, "write_batch", killed)
        with pytest.raises(RuntimeError):
            write(routed(spark, [2, 3]), 1)
        assert os.path.isdir(f"{root}/{names[0].name}/date=2024-01-01/run=sink/batch_id=1")
        assert set(seen(spark, root).values()) == {1}
        # nor does compaction touch what is not committed
        assert tables.compact(spark, root, names[0], DAY) == 0
    monkeypatch.setattr(queries, "write_batch", stored)
    write(routed(spark, [2, 3]), 1)
    assert set(seen(spark, root).values()) == {3}


def test_a_committed_batch_is_not_written_again(spark, tmp_path, as_run):
    as_run("sink")
    root = str(tmp_path)
    write = queries.publish_routed(root)
    write(routed(spark, [1]), 0)
    write(routed(spark, [2, 3]), 1)
    for spec in ROUTES.values():
        assert tables.compact(spark, root, spec, DAY) == 2
    # restarted before its offsets were recorded: the rows are in the compacted folder
    write(routed(spark, [2, 3]), 1)
    assert set(seen(spark, root).values()) == {3}
    write(routed(spark, [4]), 2)
    assert set(seen(spark, root).values()) == {4}


def test_records_are_few_and_carry_what_they_are_given(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path))
    assert log.newest("a") is None and log.read("a") == {} and not log.holds("a", 0)
    log.begin("a")
    assert log.newest("a") == -1 and log.read("a") == {}
    for batch_id in range(3):
        log.commit("a", batch_id, {"n": batch_id})
    assert log.holds("a", 2) and not log.holds("a", 3) and log.read("a") == {"n": 2}
    names = [n for n in os.listdir(f"{tmp_path}/_commits/a") if not n.startswith(".")]
    assert names == [f"{2:020d}.json"]


def test_only_runs_with_records_are_held_back(spark, tmp_path):
    root = str(tmp_path)
    for run in ("plain", "kept", "begun"):
        rows = spark.createDataFrame([(at(1), at(1), len(run), at(1))], HEALTH_ROW)
        for batch_id in range(3):
            tables.write_batch(rows, HEALTH, root, run, batch_id)
    log = CommitLog(spark, root)
    log.begin("begun")
    log.begin("kept")
    log.commit("kept", 1)
    found = read(spark, root, HEALTH)
    assert sorted(r.events for r in found.collect()) == [4, 4, 5, 5, 5]
    assert sum("run=begun" in f for f in found.inputFiles()) in (0, 3)
    assert "run#" in found._jdf.queryExecution().toString().split("PartitionFilters")[1]


# --- compaction -----------------------------------------------------------------------------------


def letters(spark, n, payload="{"):
    return spark.createDataFrame([(at(2), payload, "bad")] * n, ERROR_ROW)


def test_compaction_keeps_equal_dead_letters(spark, tmp_path):
    root = str(tmp_path)
    for batch_id in range(2):
        tables.write_batch(letters(spark, 5), PARSE_ERRORS, root, "r", batch_id)
    assert tables.compact(spark, root, PARSE_ERRORS, DAY) == 2
    assert read(spark, root, PARSE_ERRORS).count() == 10
    assert len(read(spark, root, PARSE_ERRORS).inputFiles()) == 1
    assert tables.compact(spark, root, PARSE_ERRORS, DAY) == 0


def test_compaction_leaves_rows_that_nothing_places(spark, tmp_path):
    schema = RAW.table_schema
    base = {"uri": "u", "did": "d", "observed_time": at(1)}
    rows = [{**base, "kafka_partition": 1, "kafka_offset": 7}] * 2 + [base] * 3
    frame = spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)
    root = str(tmp_path)
    for batch_id in range(2):
        tables.write_batch(frame, RAW, root, "r", batch_id)
    tables.compact(spark, root, RAW, DAY)
    found = read(spark, root, RAW)
    assert found.filter("kafka_offset = 7").count() == 1
    assert found.filter("kafka_offset IS NULL").count() == 6


def test_a_batch_written_while_a_day_is_compacted_stays(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for batch_id in range(3):
        tables.write_batch(letters(spark, 2), PARSE_ERRORS, root, "r", batch_id)
    save, meanwhile = tables._save, []

    def slow(*args):
        save(*args)
        if not meanwhile:
            meanwhile.append(True)
            tables.write_batch(letters(spark, 4, "late"), PARSE_ERRORS, root, "r", 3)
            tables.write_batch(letters(spark, 1, "other"), PARSE_ERRORS, root, "new", 0)

    monkeypatch.setattr(tables, "_save", slow)
    assert tables.compact(spark, root, PARSE_ERRORS, DAY) == 3
    monkeypatch.setattr(tables, "_save", save)

    def payloads():
        found = read(spark, root, PARSE_ERRORS).groupBy("payload").count().collect()
        return {r.payload: r["count"] for r in found}

    assert payloads() == {"{": 6, "late": 4, "other": 1}
    assert tables.compact(spark, root, PARSE_ERRORS, DAY) == 3
    assert payloads() == {"{": 6, "late": 4, "other": 1}


@pytest.mark.parametrize("dies_at", ["rename", "commit", "delete", "second commit"])
def test_readers_never_miss_or_repeat_a_row_of_a_stopped_compaction(spark, tmp_path, monkeypatch, dies_at):
    root = str(tmp_path)
    for batch_id in range(3):
        tables.write_batch(letters(spark, 2), PARSE_ERRORS, root, "r", batch_id)

    class Killed(Exception):
        pass

    def killed(*_):
        raise Killed

    commit, calls = CommitLog.commit, []

    def commits(self, *args):
        calls.append(args)
        if dies_at == "commit" or (dies_at == "second commit" and len(calls) == 2):
            raise Killed
        commit(self, *args)

    with monkeypatch.context() as patch:
        if dies_at == "rename":
            patch.setattr(CommitLog, "begin", killed)
        elif dies_at == "delete":
            delete, times = tables._delete_batches, []

            def deletes(*args):
                times.append(args)
                if len(times) == 2:
                    raise Killed
                delete(*args)

            patch.setattr(tables, "_delete_batches", deletes)
        else:
            patch.setattr(CommitLog, "commit", commits)
        with pytest.raises(Killed):
            tables.compact(spark, root, PARSE_ERRORS, DAY)
    assert read(spark, root, PARSE_ERRORS).count() == 6
    tables.compact(spark, root, PARSE_ERRORS, DAY)
    assert read(spark, root, PARSE_ERRORS).count() == 6
    tables.write_batch(letters(spark, 1), PARSE_ERRORS, root, "r", 3)
    tables.compact(spark, root, PARSE_ERRORS, DAY)
    assert read(spark, root, PARSE_ERRORS).count() == 7
    assert len(read(spark, root, PARSE_ERRORS).inputFiles()) == 1


# --- revisions as a stream ------------------------------------------------------------------------


class Counts:
    """Writes counts of minutes into the folder of a table, a file each."""

    def __init__(self, spark, root) -> None:
        self.root, self.files = str(root), 0
        for spec in (COUNTS_FAST, COUNTS_SETTLED):
            os.makedirs(f"{self.root}/{spec.name}")

    def add(self, spec, minutes, run="r", more=0) -> None:
        for minute in minutes:
            start = at(minute / 60)
            row = {name: 1 for name in COUNTS_FAST.table_schema.names}
            row |= {
                "window_start": start,
                "window_end": start + timedelta(minutes=1),
                "events": 100 + minute + more,
                "emitted_at": start,
                "watermark_delay_s": 5,
            }
            us = pa.timestamp("us", tz="UTC")
            kinds = {"time": us, "long": pa.int64(), "int": pa.int32()}
            schema = pa.schema([(name, kinds[kind]) for name, kind in spec.fields])
            folder = f"{self.root}/{spec.name}/date={start.date()}/run={run}/batch_id={self.files}"
            os.makedirs(folder)
            path = f"{folder}/part-{self.files:05d}.parquet"
            pq.write_table(pa.Table.from_pylist([row], schema=schema), path)
            os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
            self.files += 1


def run_revisions(spark, root):
    running = revisions.start_revisions(
        spark, str(root / "tables"), str(root / "checkpoints"), trigger={"availableNow": True}
    )
    running.awaitTermination()
    progress = [p for p in running.recentProgress if p["stateOperators"]]
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in progress]


def reported(frame):
    rows = frame.select((F.unix_micros("window_start") / 60_000_000 - BASE_US / 60_000_000).alias("minute"),
                        "published", "settled", "delta", "unsettled").collect()
    assert len({r.minute for r in rows}) == len(rows)
    return {round(r.minute): (r.published, r.settled, r.delta, r.unsettled) for r in rows}


def test_revisions_of_three_hours_need_little_state(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    counts = Counts(spark, tmp_path / "tables")
    held, step, missing = [], 30, {m for m in range(180) if m % 13 == 7}
    for first in range(0, 180, step):
        counts.add(COUNTS_FAST, range(first, first + step))
        if first == 60:
            counts.add(COUNTS_FAST, range(60, 70), run="again")  # written twice
        settled = range(max(0, first - 10), first + step - 10)
        counts.add(COUNTS_SETTLED, [m for m in settled if m not in missing], more=3)
        held += run_revisions(spark, tmp_path)
    assert max(held) < 6 * step and max(held[8:]) <= max(held[:8]) + 2
    decided = read(spark, tmp_path / "tables", REVISIONS)
    whole = {m: (100 + m, None, None, True) if m in missing or m >= 170 else (100 + m, 103 + m, 3, False)
             for m in range(180)}
    early = {m: row for m, row in whole.items() if m < 165}
    found = reported(decided)
    assert {m: row for m, row in found.items() if m in early} == early
    assert set(found) <= {m for m in whole if m < 170}
    both = [read(spark, tmp_path / "tables", spec) for spec in (COUNTS_FAST, COUNTS_SETTLED)]
    assert reported(curated.v_live_revisions(both[0], decided)) == whole
    assert reported(curated.v_revisions(*both)) == whole


def test_a_settled_query_that_is_down_loses_no_revision(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    counts = Counts(spark, tmp_path / "tables")
    counts.add(COUNTS_FAST, range(0, 60))
    run_revisions(spark, tmp_path)
    assert read(spark, tmp_path / "tables", REVISIONS).count() == 0
    counts.add(COUNTS_SETTLED, range(0, 50), more=1)
    run_revisions(spark, tmp_path)
    found = reported(read(spark, tmp_path / "tables", REVISIONS))
    assert found == {m: (100 + m, 101 + m, 1, False) for m in range(50)}


# --- the slowest partition ------------------------------------------------------------------------


class MixedLog(LogFolder):
    def add_mixed(self, rows) -> None:
        """One file, so one micro-batch, of (second, partition, author)."""
        posts = [post(second, did=did) for second, _, did in rows]
        table = pa.table(
            {
                "value": pa.array([json.dumps(p).encode() for p in posts], pa.binary()),
                "partition": pa.array([p for _, p, _ in rows], pa.int32()),
                "offset": pa.array(range(len(rows)), pa.int64()),
            }
        )
        target = f"{self.path}/{self.files:05d}.parquet"
        pq.write_table(table, target)
        os.utime(target, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1


def plain_counts(batches, times, delay, idle):
    """Row by row: minute to (creates, authors) of what is published."""
    latest, mark, kept = {}, None, {}
    for rows, now in zip(batches, times, strict=True):
        limit = None if mark is None else mark - delay
        for second, partition, did in rows:
            minute = int(second // 60)
            if limit is None or (minute + 1) * 60 > limit:
                kept.setdefault(minute, []).append(did)
        for second, partition, _ in rows:
            latest[partition] = (max(second, latest.get(partition, (second, 0))[0]), now)
        active = [s for s, seen_at in latest.values() if now - seen_at < idle]
        if active:
            mark = min(active) if mark is None else max(mark, min(active))
    return {m: (len(d), len(set(d))) for m, d in kept.items() if (m + 1) * 60 <= mark - delay}


SCRIPTS = {
    # a partition lags by minutes: nothing of it is late, where the newest time would have closed its window
    "lagging": ([[(1, 0, "a"), (1, 1, "b")], [(130, 0, "a"), (20, 1, "b")], [(260, 0, "a"), (30, 1, "c")],
                 [(300, 0, "a"), (40, 1, "b")], [(400, 0, "a"), (200, 1, "b")], [(500, 0, "a"), (400, 1, "b")]],
                [0, 10, 20, 30, 40, 50]),
    # silent for 30 s, so left out; what it brings later for closed minutes is late
    "silent": ([[(1, 0, "a"), (1, 1, "b")], [(70, 0, "a")], [(140, 0, "a")], [(210, 0, "a")],
                [(20, 1, "b"), (150, 1, "b")], [(280, 0, "a"), (190, 1, "c")], [(400, 0, "a"), (400, 1, "b")]],
               [0, 10, 29, 40, 50, 60, 70]),
    # exactly at the limit it still counts, a moment later it does not
    "at the limit": ([[(1, 0, "a"), (1, 1, "b")], [(200, 0, "a")], [(300, 0, "a")]], [0, 29.9, 30]),
    # all silent: the watermark stays, and goes on with the first that delivers
    "all silent": ([[(10, 0, "a"), (70, 1, "b")], [(90, 2, "c")], [(80, 0, "a")], [(500, 0, "a")]],
                   [0, 100, 200, 300]),
}


@pytest.mark.parametrize("script", SCRIPTS)
def test_counts_by_the_slowest_partition(spark, tmp_path, script):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    batches, times = SCRIPTS[script]
    log = MixedLog(tmp_path / "log")
    for rows in batches:
        log.add_mixed(rows)
    root = str(tmp_path / "tables")
    half = len(batches) // 2
    for upto in (half, len(batches)):  # stopped half way and started again
        folder = tmp_path / f"log-{upto}"
        running = partitions.start_by_partition(
            file_log(spark, str(folder if folder.exists() else log.path), max_files=1),
            COUNTS_FAST, 5, root, str(tmp_path / "checkpoints"),
            trigger={"availableNow": True}, with_health=True, clock=lambda batch_id: times[batch_id],
        )
        running.awaitTermination()
    found = {
        r.minute: (r.events, r.distinct_authors)
        for r in read(spark, root, COUNTS_FAST).withColumn("minute", F.minute("window_start")).collect()
    }
    assert found == plain_counts(batches, times, 5, 30)
    ends = {r.window_end.minute: r.events for r in read(spark, root, HEALTH).collect()}
    assert ends == {m + 1: n for m, (n, _) in found.items()}
    # open minutes keep a folder, closed ones do not
    (run,) = [n for n in os.listdir(f"{root}/window_counts_fast_open") if n.startswith("run=")]
    left = {n for n in os.listdir(f"{root}/window_counts_fast_open/{run}") if n.startswith("minute=")}
    assert left.isdisjoint({f"minute={BASE_US // 60_000_000 + m}" for m in found})


def test_progress_never_goes_back():
    progress = partitions.Progress()
    for seen_, now, mark in [({0: 100, 1: 50}, 0, 50), ({0: 200}, 10, 50), ({0: 300}, 31, 300), ({1: 60}, 40, 300),
                             ({}, 100, 300), ({1: 70}, 110, 300), ({0: 900, 1: 800}, 120, 800)]:
        progress = progress.advance(seen_, now * 1000, 30)
        assert progress.watermark_us == mark
        assert partitions.Progress.carried(json.loads(json.dumps(progress.record()))) == progress


def test_all_outputs_have_a_name_of_their_own():
    assert len({spec.name for spec in OUTPUTS}) == len(OUTPUTS)
