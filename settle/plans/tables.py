"""Stored tables: Parquet under ``root/<table>/date=<day>/run=<query>/batch_id=<n>``.

The day is the outermost folder: a reader lists the days it was asked for and no others, and a day
past retention goes as one folder. A micro-batch replaces the folders of its own number, day by day,
so a repeated batch leaves no duplicate, and a batch without rows leaves no folder. ``run`` is the
streaming query's id, which survives restarts from the same checkpoint and changes with a new one,
so a fresh query can never overwrite an older one's rows. Which batches count is for the records of
``plans.commits`` to say; readers honour them.
"""

from __future__ import annotations

import time
import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from settle.operators import contract
from settle.plans.commits import CommitLog, compaction_prefix, compaction_run
from settle.schema import OutputSpec

REJECT_POLICIES = ("fail", "quarantine")
POSITION = ("kafka_partition", "kafka_offset")
REJECTS, ASIDE = "_rejects", "_compacting"


def today() -> date:
    return datetime.now(timezone.utc).date()


def with_date(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    """Partition by the relay's clock; the author's claim may be any date at all."""
    return rows.withColumn("date", F.to_date(spec.date_from))


def _save(
    rows: DataFrame, spec: OutputSpec, path: str, run: str, batch_id: int, gathered: bool = False
) -> None:
    """Replace what this run has stored under this batch number, on the days the rows are of."""
    if spec.one_row_a_minute and not gathered:
        rows = rows.repartition("date")
    (
        rows.withColumn("run", F.lit(run))
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .sortWithinPartitions("date", *spec.cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "run", "batch_id")
        .parquet(path)
    )


def write_batch(
    rows: DataFrame,
    spec: OutputSpec,
    root: str,
    run: str,
    batch_id: int,
    on_reject: str = "fail",
    gathered: bool = False,
) -> None:
    """Write one batch after checking its contract; ``gathered`` rows are in one partition already.

    ``fail`` stops the write on the first bad row, so the batch is retried whole. ``quarantine``
    writes the good rows and puts the bad ones, with the reason, under ``<table>_rejects``; it
    reads ``rows`` twice, so the caller should have persisted them.
    """
    if on_reject not in REJECT_POLICIES:
        raise ValueError(f"on_reject must be one of {REJECT_POLICIES}")
    contract.conform(rows, spec)
    path = f"{root}/{spec.name}"
    if on_reject == "fail":
        _save(with_date(contract.or_fail(rows, spec), spec), spec, path, run, batch_id, gathered)
        return
    _save(with_date(contract.accepted(rows, spec), spec), spec, path, run, batch_id, gathered)
    # a reject may be rejected for want of a day; it is then filed under the day of its writing
    rejected = with_date(contract.rejected(rows, spec), spec)
    rejected = rejected.withColumn("date", F.coalesce("date", F.current_date()))
    _save(rejected, spec, f"{path}{REJECTS}", run, batch_id)


def write_clustered(rows: DataFrame, spec: OutputSpec, root: str, run: str) -> None:
    """Write a backfill clustered for reading: each file covers a narrow range of the keys.

    The log position ends the range key, so a day or an author holding a large share of the rows
    is still split over many tasks.
    """
    contract.conform(rows, spec)
    dated = with_date(contract.or_fail(rows, spec), spec)
    if spec.cluster_by:
        dated = dated.repartitionByRange("date", *spec.cluster_by, *POSITION)
    _save(dated, spec, f"{root}/{spec.name}", run, 0)


def first_live_day(spec: OutputSpec, as_of: date | None = None) -> date | None:
    """Oldest day still held; NULL retention keeps everything."""
    if spec.retention_days is None:
        return None
    return (as_of or today()) - timedelta(days=spec.retention_days - 1)


def _days(path: str, first: date, last: date) -> str:
    """A pattern for the folders of some days; others are not even listed."""
    days = (first + timedelta(days=i) for i in range((last - first).days + 1))
    return f"{path}/date={{{','.join(map(str, days))}}}"


def _read(
    spark: SparkSession, root: str, table: str, fields: list[T.StructField], first: date, last: date
) -> DataFrame:
    """The rows that count, of some days, with the run and batch that wrote them."""
    path = f"{root}/{table}"
    stored = [
        T.StructField("date", T.DateType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
    schema = T.StructType([*fields, *stored])
    try:
        if first > last:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema).option("basePath", path)
        rows = reader.parquet(_days(path, first, last))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.col("date").between(first, last))
    days = (first + timedelta(days=i) for i in range((last - first).days + 1))
    counts = CommitLog(spark, root).visible(table, days).condition()
    return rows if counts is None else rows.filter(counts)


def read_table(
    spark: SparkSession,
    root: str,
    spec: OutputSpec,
    since: date,
    until: date | None = None,
    as_of: date | None = None,
) -> DataFrame:
    """Rows from ``since`` to ``until`` (or tomorrow). The bound is mandatory, and only the folders
    of those days are listed; there is no reader without one. Days past the table's retention are
    never returned, dropped yet or not. Days without rows are no error."""
    live = first_live_day(spec, as_of)
    first = max(since, live) if live else since
    last = until or max(today(), as_of or today()) + timedelta(days=1)
    rows = _read(spark, root, spec.name, spec.table_schema.fields, first, last)
    return rows.drop("run", "batch_id")


def read_rejects(
    spark: SparkSession, root: str, spec: OutputSpec, since: date, until: date | None = None
) -> DataFrame:
    """Quarantined rows with their ``reject_reason``, and the message they came in, if any."""
    extra = [T.StructField(name, T.StringType()) for name in ("message", "reject_reason")]
    last = until or today() + timedelta(days=1)
    fields = [*spec.table_schema.fields, *extra]
    rows = _read(spark, root, f"{spec.name}{REJECTS}", fields, since, last)
    return rows.drop("run", "batch_id")


def without_copies(rows: DataFrame, spec: OutputSpec) -> DataFrame:
    """Rows without those that are provably written twice.

    Two equal rows of one log position, or of one minute of a table with a row a minute, are one. Rows
    that nothing identifies are all kept, however equal: two dead letters may well be.
    """
    columns = spec.table_schema.names
    if spec.one_row_a_minute:
        return rows.dropDuplicates(columns)
    if not set(POSITION) <= set(columns):
        return rows
    placed = F.lit(True)
    for name in POSITION:
        placed = placed & F.col(name).isNotNull()
    return rows.filter(placed).dropDuplicates(columns).unionByName(rows.filter(~placed))


def compact(spark: SparkSession, root: str, spec: OutputSpec, day: date) -> int:
    """Gather the batch folders of a day that is over into one; returns how many went.

    The rows of the batches that count now are written aside and moved in; one commit record then shows
    them and hides the batches they were read from, and only those folders are deleted. A batch written
    meanwhile stays as it is, and readers see every row, and see it once, at any moment. Stopped half way,
    the next call finishes what the record says, or starts over. Safe to repeat; one call at a time for a day.
    """
    path, folder = f"{root}/{spec.name}", f"date={day}"
    files, at = _files(spark, f"{path}/{folder}")
    if not files.exists(at(f"{path}/{folder}")):
        return 0
    log = CommitLog(spark, root)
    visible = log.visible(spec.name, [day])
    _delete_batches(files, at, f"{path}/{folder}", visible.replaced)
    for run, upto in visible.upto.items():
        if run.startswith(compaction_prefix(spec.name, day)) and upto < 0:  # stopped before it counted
            files.delete(at(f"{path}/{folder}/run={run}"), True)
            log.forget(run)
    found: dict[str, list[int]] = {}
    for run, batch_id in _batches(files, at, f"{path}/{folder}"):
        if visible.shows(run, batch_id):
            found.setdefault(run, []).append(batch_id)
    if sum(map(len, found.values())) < 2:
        return 0
    stored = _read(spark, root, spec.name, spec.table_schema.fields, day, day)
    wanted = F.lit(False)
    for run, batches in found.items():
        wanted = wanted | ((F.col("run") == run) & F.col("batch_id").isin(*batches))
    rows = without_copies(stored.filter(wanted).drop("run", "batch_id", "date"), spec)
    rows = rows.withColumn("date", F.lit(day))
    aside, run = f"{path}{ASIDE}/{uuid.uuid4().hex}", compaction_run(spec.name, day)
    if spec.cluster_by:
        keys = [*spec.cluster_by, *(name for name in POSITION if name in rows.columns)]
        rows = rows.repartitionByRange(*keys)
    else:
        rows = rows.hint("rebalance")  # as few files as their size asks for
    _save(rows, spec, aside, run, 0)
    log.begin(run)
    if not files.rename(at(f"{aside}/{folder}/run={run}"), at(f"{path}/{folder}/run={run}")):
        raise OSError(f"could not move the compacted day to {path}/{folder}")
    log.commit(run, 0, {"replaces": found})
    _delete_batches(files, at, f"{path}/{folder}", found)
    log.commit(run, 1)  # nothing is left to hide
    for other in found:
        if other.startswith(run.rpartition("-")[0]):
            log.forget(other)
    files.delete(at(aside), True)
    return sum(map(len, found.values()))


def _batches(files, at, path: str) -> list[tuple[str, int]]:
    """(run, batch_id) of the batch folders of a day."""
    out = []
    for run in files.listStatus(at(path)):
        for batch in files.listStatus(run.getPath()) if run.isDirectory() else ():
            name = batch.getPath().getName()
            if name.startswith("batch_id="):
                own = run.getPath().getName().removeprefix("run=")
                out.append((own, int(name.removeprefix("batch_id="))))
    return out


def _delete_batches(files, at, path: str, batches) -> None:
    """Delete batch folders, and those of their runs that hold no other batch."""
    for run, numbers in batches.items():
        own = at(f"{path}/run={run}")
        for number in numbers:
            files.delete(at(f"{path}/run={run}/batch_id={number}"), True)
        if files.exists(own) and not len(files.listStatus(own)):
            files.delete(own, False)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and how to make its paths. Spark's own API cannot move or delete."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def ensure_folder(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.mkdirs(at(path))


def gather_in_order(spark: SparkSession, staged: str, folders: list[str], path: str) -> None:
    """Move the one file of each staged folder to ``path``, with times that follow the folders' order.

    Streams of files take the older one first. Where times cannot be set, a move is a copy and its own
    time follows the order; files whose times do not are an error. Only names and times are touched.
    """
    files, at = _files(spark, path)
    start_ms, last_ms = int(time.time() - len(folders)) * 1000, -1
    for number, folder in enumerate(folders):
        listed = [status.getPath() for status in files.listStatus(at(f"{staged}/{folder}"))]
        (source,) = [file for file in listed if file.getName().startswith("part-")]
        target = at(f"{path}/{number:06d}.parquet")
        if not files.rename(source, target):
            raise OSError(f"could not move {source} to {target}")
        files.setTimes(target, start_ms + number * 1000, -1)
        found_ms = files.getFileStatus(target).getModificationTime()
        if found_ms <= last_ms:
            raise OSError(f"{target} is not newer than the file before it")
        last_ms = found_ms
    files.delete(at(staged), True)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at(path), True)


def expired_days(rows: DataFrame, spec: OutputSpec, as_of: date) -> DataFrame:
    """Days of a table past its retention, with the rows they hold."""
    day = F.to_date(spec.date_from)
    live = first_live_day(spec, as_of)
    past = F.lit(False) if live is None else day < F.lit(live)
    return rows.filter(past).groupBy(day.alias("date")).agg(F.count("*").alias("rows"))


def drop_expired(
    spark: SparkSession, root: str, spec: OutputSpec, as_of: date | None = None
) -> list[str]:
    """Delete the days past retention, rejects included; returns their paths. Lists days only."""
    live = first_live_day(spec, as_of)
    if live is None:
        return []
    dropped = []
    for table in (spec.name, f"{spec.name}{REJECTS}"):
        files, at = _files(spark, f"{root}/{table}")
        for status in files.globStatus(at(f"{root}/{table}/date=*")) or []:
            folder = status.getPath()
            if date.fromisoformat(folder.getName().removeprefix("date=")) < live:
                files.delete(folder, True)
                dropped.append(folder.toString())
    return dropped
