from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from conftest import SMALL, post
from pyspark.sql import functions as F

from settle.__main__ import arguments, ingest, report, sink_options
from settle.operators.enrich import enrich
from settle.operators.replay import replay, replay_revisions
from settle.plans.tables import today, write_clustered
from settle.schema import RAW
from settle.sources.events import posts_from_events
from settle.sources.log import stored_log
from settle.streaming.queries import watermarked_posts


@pytest.mark.parametrize(
    "argv",
    [
        ["replay", "--tables", "t"],
        ["stream", "--tables", "t", "--checkpoints", "c"],
        ["stream", "--tables", "t", "--checkpoints", "c", "--log", "l", "--servers", "s"],
        ["sink", "--tables", "t", "--checkpoints", "c"],
        ["revise", "--tables", "t"],
        ["watch", "--tables", "t", "--checkpoints", "c"],
        ["lifetimes", "--tables", "t"],
        ["stream", "--tables", "t", "--log", "l"],
        ["nothing", "--tables", "t"],
        ["ingest", "--checkpoints", "c", "--servers", "s"],
        ["ingest", "--received", "r", "--checkpoints", "c"],
        ["compact", "--tables", "t"],
        ["expire"],
    ],
)
def test_incomplete_commands_are_refused(argv):
    with pytest.raises(SystemExit):
        arguments(argv)


def test_reports_read_the_stored_tables(spark, tmp_path):
    # stored as if observed yesterday, because reports and retention look back from now
    start = datetime.combine(today() - timedelta(days=1), datetime.min.time(), timezone.utc)
    shift = int(start.timestamp() * 1e6) - 1_704_067_200_000_000
    posts = enrich(posts_from_events(spark, SMALL))
    moved = posts.withColumn(
        "observed_time", F.timestamp_micros(F.unix_micros("observed_time") + shift)
    )
    # a retried write: the same log positions stored twice
    for name in ("first", "again"):
        write_clustered(moved, RAW, str(tmp_path), name)
    since = str(start.date())

    def run(command):
        return report(
            spark,
            arguments([command, "--tables", str(tmp_path), "--since", since, "--out", "o"]),
        )

    want = replay_revisions(replay(posts)).agg(F.sum("published"), F.sum("settled")).first()
    assert run("replay").agg(F.sum("published"), F.sum("settled")).first() == want
    assert run("posts").count() == 990
    # of this log, which nothing has gated, the frames that are no commits were never stored
    others = posts_from_events(spark, SMALL).filter("kind <> 'commit'").count()
    assert run("missing").agg(F.sum("missing")).first()[0] == others
    assert run("repeated").agg(F.sum("extra_rows")).first()[0] == posts.count()
    deletes = posts.filter("operation = 'delete'").select("uri", "rev").distinct().count()
    assert run("lifetimes").count() == deletes
    creates = posts.filter("operation = 'create'").select("uri", "operation", "rev")
    assert run("skew").agg(F.sum("events")).first()[0] == creates.distinct().count()


def test_a_sink_flushes_after_so_many_messages_or_seconds():
    args = arguments(["sink", "--servers", "b:1", "--tables", "t", "--checkpoints", "c"])
    options = sink_options(args)
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("500", "10000ms")
    assert options["startingOffsets"] == "earliest" and len(options["subscribe"].split(",")) == 4


def test_ingest_writes_what_a_gated_stream_reads(spark, log_folder, tmp_path):
    log_folder.add([post(1), post(2, operation="delete")])
    args = ["ingest", "--received", log_folder.path, "--out", f"{tmp_path}/sent"]
    running = ingest(spark, arguments([*args, "--checkpoints", f"{tmp_path}/c"]))
    running.processAllAvailable()
    running.stop()
    sent = spark.read.parquet(f"{tmp_path}/sent")
    assert sorted(r.topic for r in sent.collect()) == ["bsky.posts.v1"] * 2


def test_a_gated_query_parses_a_row_once(spark, log_folder):
    log_folder.add([post(1)])
    rows = watermarked_posts(stored_log(spark, log_folder.path), 5, gated=True)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    counted = [plan.count(name) for name in ("from_json(", "parse_json(", "json_array_length(")]
    assert counted == [1, 0, 0], plan
