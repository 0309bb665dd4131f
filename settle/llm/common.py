"""What the operators share: tables, a folder every executor reaches, Arrow batches of bounded size."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.session import ensure_checkpoint_dir

#: Fixed value: the white space of every contract, as a Java or Python character class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes handed to a Python function at a time.
BATCH_ROWS = 512
BATCH_BYTES = 8 << 20
ARROW = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}


def prepare(spark: SparkSession) -> None:
    """Keep the batches that pass between Spark and Python small, and give workers this package."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    ship_package(spark)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once a session, so that no executor needs it installed.

    The archive is written to the shared folder, from where Spark hands it out.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    ensure_checkpoint_dir(spark)
    root = Path(__file__).resolve().parents[1]
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    path, files = hadoop_path(spark, f"{context.getCheckpointDir()}/{root.name}-{uuid.uuid4().hex}.zip")
    stream = files.create(path)
    stream.write(bytearray(archive.getvalue()))
    stream.close()
    context.addPyFile(path.toString())
    _shipped.add(context.applicationId)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as Spark reaches them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the shared folder that ``spark.checkpoint.dir`` names.

    A saved table cuts the lineage: a lost executor costs its own tasks, not the steps before. Whoever has
    saved a result of its own may drop the folders that were ``opened`` for it.
    """

    opened: list[Scratch] = []

    def __init__(self, spark: SparkSession) -> None:
        ensure_checkpoint_dir(spark)
        prepare(spark)
        self.spark = spark
        self.path = f"{spark.sparkContext.getCheckpointDir()}/llm-{uuid.uuid4().hex}"
        Scratch.opened.append(self)

    def save(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop(self) -> None:
        """Remove what was saved; only for callers whose result no longer reads it."""
        path, files = hadoop_path(self.spark, self.path)
        files.delete(path, True)
        if self in Scratch.opened:
            Scratch.opened.remove(self)

    @staticmethod
    def drop_since(mark: int) -> None:
        """Drop every folder opened since ``len(Scratch.opened)`` was ``mark``."""
        for own in Scratch.opened[mark:]:
            own.drop()


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a few very long texts do not meet in one call."""
    each = max(1, batch.nbytes // max(1, batch.num_rows))
    step = max(1, min(BATCH_ROWS, BATCH_BYTES // max(1, each)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def map_batches(
    rows: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply ``function`` to slices of the Arrow batches of each partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield function(part)

    return rows.mapInArrow(run, schema)


def columns_of(columns: list, schema: str) -> pa.RecordBatch:
    """A batch of lists or arrays in the order of a schema like ``a long, b string``."""
    kinds = {
        "long": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "string": pa.string(),
        "binary": pa.binary(),
    }
    names, types = zip(*(field.split() for field in schema.split(", ")), strict=True)
    arrays = [pa.array(c, kinds[kind]) for c, kind in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8, null as empty."""
    return column.fill_null("").cast(pa.binary()).to_pylist()


def texts(column: pa.Array) -> list[str]:
    return column.fill_null("").to_pylist()


def crc_of_id(doc_id: str = "doc_id"):
    """crc32 of the id as text, as a column."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))
