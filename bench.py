"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is run once to warm up and then timed, its rows written to the no-op sink. The
streaming figure is rows per second of the fast query over the whole log, from its own progress.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from settle.plans.catalogue import CATALOGUE
from settle.session import local_session
from settle.sources import events
from settle.sources.log import file_log
from settle.streaming import queries as streaming

HEADLINE = (
    "window_counts",
    "pipeline_health",
    "replay_revisions",
    "v_skew_profile",
    "dedup_posts",
    "duplicate_inflation",
    "v_revisions",
    "frame_classify",
    "scan_posts",
    "raw_projection",
)
RUNS = 3


def timed(spark, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    CATALOGUE[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def stream_rows_per_second(spark, sf_dir: str) -> dict[str, float]:
    folder = tempfile.mkdtemp(prefix="settle-bench-")
    log = events.as_log(events.posts_from_events(spark, sf_dir))
    files = 8
    by_arrival = log.repartitionByRange(files, "offset").sortWithinPartitions("offset")
    by_arrival.write.parquet(f"{folder}/log")
    running = streaming.start_fast(
        file_log(spark, f"{folder}/log", max_files=1),
        f"{folder}/tables",
        f"{folder}/checkpoints",
        trigger={"availableNow": True},
    )
    running.awaitTermination()
    batches = [p for p in running.recentProgress if p["numInputRows"]]
    rows = sum(p["numInputRows"] for p in batches)
    seconds = sum(p["durationMs"]["triggerExecution"] for p in batches) / 1000
    return {"rows": rows, "batches": len(batches), "rows_per_sec": round(rows / seconds, 1)}


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    results = {}
    for name in HEADLINE:
        timed(spark, sf_dir, name)
        runs = [timed(spark, sf_dir, name) for _ in range(RUNS)]
        results[name] = round(statistics.median(runs), 3)
    stream = stream_rows_per_second(spark, sf_dir)
    spark.stop()
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "stream_fast": stream,
    }
    print(json.dumps(line))
    return 0


if __name__ == "__main__":
    sys.exit(main())
