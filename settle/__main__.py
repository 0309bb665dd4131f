"""Run the pipeline or print a report.

    python -m settle ingest  --received DIR --servers host:9092 --checkpoints DIR
    python -m settle ingest  --received DIR --out DIR --checkpoints DIR
    python -m settle stream  --servers host:9092 --tables DIR --checkpoints DIR
    python -m settle stream  --log DIR --tables DIR --checkpoints DIR
    python -m settle sink    --servers host:9092 --tables DIR --checkpoints DIR
    python -m settle revise  --tables DIR --checkpoints DIR
    python -m settle watch   --servers host:9092 | --log DIR  --tables DIR --checkpoints DIR
    python -m settle replay  --tables DIR --since 2024-01-01 --out DIR
    python -m settle revisions | skew | posts | lifetimes | missing | repeated  --tables DIR --since 2024-01-01 --out DIR
    python -m settle expire  --tables DIR
    python -m settle compact --tables DIR --since 2024-01-01

``ingest`` classifies received frames and sends them on; ``stream`` trusts the posts topic to hold what
``ingest`` let through, and classifies the frames of a ``--log`` folder itself unless ``--gated`` says
that they come from ``ingest`` too. The master, the Kafka connector and all sizing come from the cluster's Spark configuration.
"""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from settle.operators.lifetimes import lifetimes
from settle.operators.offsets import missing_ranges, repeated_ranges
from settle.operators.replay import replay, replay_revisions
from settle.plans import curated
from settle.plans.tables import compact, drop_expired, read_table, today
from settle.schema import (
    COUNTS_FAST,
    COUNTS_SETTLED,
    FLUSH_ROWS,
    FLUSH_S,
    OUTPUTS,
    RAW,
    ROUTES,
)
from settle.session import REQUIRED, STREAMING, prepare
from settle.sources.log import file_log, kafka_log, kafka_sink_options, kafka_source_options
from settle.streaming.queries import FAST_TRIGGER, start_all, start_ingest, start_sink
from settle.streaming.revisions import start_revisions
from settle.streaming.watch import start_alarms

REPORTS = ("replay", "revisions", "skew", "posts", "lifetimes", "missing", "repeated")
STREAMS = ("stream", "sink", "revise", "watch")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="settle")
    parser.add_argument(
        "command", choices=("ingest", *STREAMS, *REPORTS, "expire", "compact")
    )
    parser.add_argument("--tables")
    parser.add_argument("--checkpoints")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--log", help="folder of log files, instead of Kafka")
    parser.add_argument("--received", help="folder of received frames, for ingest")
    parser.add_argument("--gated", action="store_true", help="the --log folder comes from ingest")
    parser.add_argument(
        "--max-offsets", type=int, help="bound of a micro-batch of the fast and settled queries"
    )
    parser.add_argument("--collections", help="comma-separated; all if not given")
    parser.add_argument("--since", type=date.fromisoformat)
    parser.add_argument("--out")
    args = parser.parse_args(argv)
    if args.command != "ingest" and not args.tables:
        parser.error(f"{args.command} needs --tables")
    if args.command == "ingest" and not (args.received and args.checkpoints):
        parser.error("ingest needs --received and --checkpoints")
    if args.command == "ingest" and bool(args.servers) == bool(args.out):
        parser.error("ingest needs either --servers or --out")
    if args.command == "compact" and not args.since:
        parser.error("compact needs --since")
    if args.command in REPORTS and not (args.since and args.out):
        parser.error(f"{args.command} needs --since and --out")
    if args.command in STREAMS and not args.checkpoints:
        parser.error(f"{args.command} needs --checkpoints")
    if args.command == "sink" and not args.servers:
        parser.error("sink needs --servers")
    if args.command in ("stream", "watch") and bool(args.servers) == bool(args.log):
        parser.error(f"{args.command} needs either --servers or --log")
    return args


def report(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    def table(spec):
        return read_table(spark, args.tables, spec, args.since)

    if args.command == "replay":
        return replay_revisions(replay(table(RAW), retried=True))
    if args.command == "revisions":
        return curated.v_revisions(table(COUNTS_FAST), table(COUNTS_SETTLED))
    if args.command == "skew":
        return curated.v_skew_profile(table(RAW))
    if args.command == "lifetimes":
        return lifetimes(table(RAW))
    if args.command == "missing":
        return missing_ranges(table(RAW))
    if args.command == "repeated":
        return repeated_ranges(table(RAW))
    return curated.v_posts(table(RAW))


def ingest(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    """Frames from a folder to the posts and dead-letter topics, or to a folder of messages."""
    received = file_log(spark, args.received).select("value")
    if args.servers:
        return start_ingest(received, kafka_sink_options(args.servers), args.checkpoints)
    return start_ingest(received, {"path": args.out}, args.checkpoints, fmt="parquet")


def sink_options(args: argparse.Namespace) -> dict[str, str]:
    """The output topics from their beginning, in batches of so many messages or so many seconds."""
    flush = (FLUSH_ROWS, FLUSH_S)
    return kafka_source_options(args.servers, ",".join(ROUTES), starting="earliest", flush=flush)


def stream(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    def log(max_offsets: int | None) -> DataFrame:
        if args.log:
            return file_log(spark, args.log)
        return kafka_log(spark, kafka_source_options(args.servers, max_offsets=max_offsets))

    return start_all(
        log,
        args.tables,
        args.checkpoints,
        args.collections,
        gated=args.gated or bool(args.servers),
        max_offsets=args.max_offsets,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    builder = SparkSession.builder.appName("settle")
    for key, value in {**REQUIRED, **STREAMING}.items():
        builder = builder.config(key, value)
    spark = prepare(builder.getOrCreate())
    if args.command == "ingest":
        ingest(spark, args).awaitTermination()
    elif args.command == "stream":
        stream(spark, args)
        spark.streams.awaitAnyTermination()
    elif args.command == "sink":
        messages = kafka_log(spark, sink_options(args))
        trigger = {"processingTime": FAST_TRIGGER}
        start_sink(messages, args.tables, args.checkpoints, trigger).awaitTermination()
    elif args.command == "revise":
        start_revisions(spark, args.tables, args.checkpoints).awaitTermination()
    elif args.command == "watch":
        log = file_log(spark, args.log) if args.log else None
        log = log or kafka_log(spark, kafka_source_options(args.servers))
        start_alarms(log, args.tables, args.checkpoints).awaitTermination()
    elif args.command == "expire":
        for spec in OUTPUTS:
            for path in drop_expired(spark, args.tables, spec):
                print(path)
    elif args.command == "compact":
        day = args.since
        while day < today():  # a day still being written is left alone
            for spec in OUTPUTS:
                compact(spark, args.tables, spec, day)
            day += timedelta(days=1)
    else:
        report(spark, args).write.mode("errorifexists").parquet(args.out)


if __name__ == "__main__":
    main()
