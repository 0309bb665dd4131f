"""Revisions published as they become known: the fast and the settled counts joined as two streams.

Both sides are read from their tables as they are written, and joined on the window. A published minute
waits in the state of the join for its settled count and leaves as one row. If both streams have gone
``patience_s`` past a minute's end and no settled count has come, none will: the row leaves unsettled. The
watermark is the lesser one of the two streams, so a settled query that is down loses nothing; its minutes
wait, a row each. What waits is bounded by the settled delay and the patience while both queries run.

Counts that were written twice are dropped by window while the state remembers it. A batch that is not yet
committed may be read early: repeated, it has the same counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from settle.plans.curated import revision_columns
from settle.plans.tables import ensure_folder, write_batch
from settle.schema import COUNTS_FAST, COUNTS_SETTLED, REVISIONS, OutputSpec
from settle.session import prepare
from settle.streaming.queries import TRIGGER, _start, committed, state_partitions

#: How far both streams must be past a minute before it is given up; their batches hold few minutes.
PATIENCE_S = 120


def table_stream(
    spark: SparkSession, tables: str, spec: OutputSpec, max_files: int | None = None
) -> DataFrame:
    """A stored table as a stream of the rows that are added to it."""
    path = f"{tables}/{spec.name}"
    ensure_folder(spark, path)
    stored = [
        T.StructField("date", T.DateType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
    reader = prepare(spark).readStream.schema(T.StructType([*spec.table_schema.fields, *stored]))
    # a repeated batch replaces its files, which the stream then finds under another name
    reader = reader.option("ignoreMissingFiles", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(path).filter(~F.col("run").startswith("compact-"))
    return rows.select(*spec.table_schema.names)


def joined(fast: DataFrame, settled: DataFrame, patience_s: int = PATIENCE_S) -> DataFrame:
    """The revision rows of two streams of counts; each window once."""
    delay = f"{patience_s} seconds"
    published = fast.withWatermark("window_end", delay).dropDuplicatesWithinWatermark(["window_start"])
    later = (
        settled.select("window_end", "window_start", F.col("events").alias("settled"))
        .withWatermark("window_end", delay)
        .dropDuplicatesWithinWatermark(["window_start"])
        .select(F.col("window_end").alias("settled_end"), "settled")
    )
    # the window's end is the key, so that the watermark bounds the state of both sides
    same = F.col("window_end") == F.col("settled_end")
    rows = published.withColumnRenamed("events", "published").join(later, same, "left")
    return rows.select(*revision_columns())


def start_revisions(
    spark: SparkSession,
    tables: str,
    checkpoints: str,
    trigger: dict | None = None,
    patience_s: int = PATIENCE_S,
    max_files: int | None = None,
) -> StreamingQuery:
    """Publish revisions into their table as the counts tables grow."""

    def write(batch: DataFrame, run: str, batch_id: int) -> None:
        rows = batch.persist()
        if not rows.isEmpty():
            write_batch(rows, REVISIONS, tables, run, batch_id)
        rows.unpersist()

    fast, settled = (
        table_stream(spark, tables, spec, max_files) for spec in (COUNTS_FAST, COUNTS_SETTLED)
    )
    rows = joined(fast, settled, patience_s)
    writer = rows.writeStream.outputMode("append").foreachBatch(committed(tables, write))
    with state_partitions(spark):
        return _start(writer, "revisions", checkpoints, trigger or {"processingTime": TRIGGER})
