"""Integer vectors: a vector's entries c become floor(256 * c), packed into one binary per row.

A packed vector starts with the bytes of one entry (2, 4 or 8, the least that holds all of them), followed
by the entries as little-endian integers, so equal vectors are equal binaries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries to a unit.
SCALE = 256
WIDTHS = ((2, "<i2"), (4, "<i4"), (8, "<i8"))


def integers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Places of the usable vectors of a batch, and their entries, one row each.

    Null and empty vectors and those with a null or non-finite entry are left out. Vectors of several
    lengths cannot be compared, and entries beyond 62 bits cannot be counted: both raise ValueError.
    """
    lengths = pc.list_value_length(column).fill_null(0).to_numpy().astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    finite = np.concatenate([[0], np.cumsum(np.isfinite(flat))])
    usable = (finite[ends] - finite[ends - lengths] == lengths) & (lengths > 0)
    at = np.flatnonzero(usable)
    if not len(at):
        return at, np.zeros((0, 0), np.int64)
    width = int(lengths[at[0]])
    if (lengths[at] != width).any():
        raise ValueError("vectors of several lengths")
    entries = np.floor(SCALE * flat[np.repeat(usable, lengths)]).reshape(-1, width)
    if np.abs(entries).max() >= 2.0**62:
        raise ValueError("an entry is beyond 62 bits")
    return at, entries.astype(np.int64)


def packed(entries: np.ndarray) -> pa.Array:
    """One binary for each row of a matrix of longs."""
    if not entries.size:
        return pa.array([b""] * len(entries), pa.binary())
    largest = np.maximum(entries.max(axis=1), -1 - entries.min(axis=1))
    out = np.empty(len(entries), object)
    below = -1
    for width, kind in WIDTHS:
        limit = (1 << (8 * width - 1)) - 1
        own = np.flatnonzero((largest > below) & (largest <= limit))
        below = limit
        if len(own):
            head = np.full((len(own), 1), width, np.uint8)
            body = np.ascontiguousarray(entries[own].astype(kind)).view(np.uint8)
            whole = np.hstack([head, body.reshape(len(own), -1)])
            out[own] = [row.tobytes() for row in whole]
    return pa.array(out.tolist(), pa.binary())


def unpacked(column: pa.Array) -> np.ndarray:
    """The longs of packed vectors, one row each."""
    rows = column.to_pylist()
    kinds = dict(WIDTHS)
    if not rows:
        return np.zeros((0, 0), np.int64)
    if len({row[0] for row in rows}) == 1:  # as a rule
        flat = np.frombuffer(b"".join(row[1:] for row in rows), kinds[rows[0][0]])
        return flat.astype(np.int64).reshape(len(rows), -1)
    return np.array([np.frombuffer(row, kinds[row[0]], offset=1) for row in rows], np.int64)


def totals(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows of packed ``x`` and the exact sum of each dimension."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                entries = unpacked(batch.column(0))
                n += len(entries)
                total = entries.sum(axis=0) + (total if total.size else 0)
        dims = np.arange(len(total))
        counts = np.full(len(total), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(dims, pa.int32()), pa.array(counts, pa.int64()), pa.array(total, pa.int64())],
            ["dim", "n", "total"],
        )

    parts = rows.select("x").mapInArrow(run, "dim int, n long, total long")
    found = parts.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    found = sorted(found.collect())  # a row a dimension
    if len({row.n for row in found}) > 1:
        raise ValueError("vectors of several lengths")
    return (found[0].n if found else 0), np.array([row.total for row in found], np.int64)


def covariance(rows: DataFrame, n: int, total: np.ndarray) -> np.ndarray:
    """Covariance of packed ``x`` with divisor n; entries are centred before they are multiplied.

    A task sends the upper triangle of its own sum of products, and Spark adds those up by their place.
    """
    size = len(total)
    centre = total / n
    above = np.triu_indices(size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                centred = unpacked(batch.column(0)) - centre
                own += centred.T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(above[0], pa.int32()), pa.array(above[1], pa.int32()), pa.array(own[above])],
            ["i", "j", "product"],
        )

    parts = rows.select("x").mapInArrow(run, "i int, j int, product double")
    found = parts.groupBy("i", "j").agg(F.sum("product").alias("product")).toArrow()
    out = np.zeros((size, size))
    i, j = found.column("i").to_numpy(), found.column("j").to_numpy()
    out[i, j] = out[j, i] = found.column("product").to_numpy() / n
    return out
