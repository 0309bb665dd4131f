"""Whitening of embeddings by spectral divide and conquer.

Spark finds the distinct vectors, their sums and their covariance. The covariance, whose size depends on the
dimension alone, is split on the driver: the polar factor of the covariance less a shift, by the QDWH
iteration, is the matrix sign of it, half of that plus a half projects on the components above the shift, and
both invariant subspaces are split again until each is one component. The whitening matrix is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.common import Scratch, prepare
from settle.llm.vectors import covariance, integers, packed, totals, unpacked

EPS = np.finfo(float).eps


# --- the spectrum of a symmetric matrix ----------------------------------------------------------


def polar(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps."""
    size = len(matrix)
    scale = np.linalg.norm(matrix)
    x = matrix / scale
    least = EPS  # below the least singular value, or else a few steps more are taken
    eye = np.eye(size)
    for _ in range(60):
        square = least * least
        root = np.cbrt(4 * (1 - square) / (square * square)) if least < 1 else 0.0
        half = np.sqrt(1 + root)
        a = half + np.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - square) / (square * half))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:  # orthogonalise, as the inverse would be inaccurate
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            step = (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            step = (a - b / c) * np.linalg.solve(eye + c * (x.T @ x), x.T).T
        new = b / c * x + step
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        least = min(1.0, least * (a + b * square) / (1 + c * square))
        if moved < np.cbrt(4 * EPS) and 1 - least < 10 * EPS:
            break
    return x


def eigenvectors(matrix: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of a symmetric matrix, as columns in no particular order."""
    size = len(matrix)
    scale = np.linalg.norm(matrix)
    middle = np.trace(matrix) / max(1, size)
    rest = np.linalg.norm(matrix - np.diag(np.diag(matrix)))
    if size == 1 or rest <= EPS * scale:
        return np.eye(size)
    own = np.random.default_rng(size)
    diagonal = np.sort(np.diag(matrix))
    shifts = [np.median(diagonal), middle, *np.quantile(diagonal, [0.4, 0.6, 0.25, 0.75, 0.1, 0.9])]
    best: tuple[float, np.ndarray, int] | None = None
    for shift in shifts:
        shifted = matrix - shift * np.eye(size)
        if np.linalg.norm(shifted) <= EPS * scale:
            continue
        above = (polar(shifted) + np.eye(size)) / 2
        rank = int(round(np.trace(above)))
        if not 0 < rank < size:
            continue
        basis, _ = np.linalg.qr(above @ own.standard_normal((size, rank)))
        basis, _ = np.linalg.qr(above @ basis, mode="complete")
        left = np.linalg.norm(basis[:, :rank].T @ matrix @ basis[:, rank:])
        if best is None or left < best[0]:
            best = left, basis, rank
        if left <= 10 * EPS * scale:
            break
    if best is None:
        # all that is left are components that doubles cannot tell apart
        return np.eye(size)
    _, basis, rank = best
    out = np.empty((size, size))
    for part, place in ((basis[:, :rank], slice(0, rank)), (basis[:, rank:], slice(rank, size))):
        inner = part.T @ matrix @ part
        out[:, place] = part @ eigenvectors((inner + inner.T) / 2)
    return out


def components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns, ``most`` at the most.

    Values that are zero to double precision have no component: nothing can be scaled to unit variance.
    """
    if not matrix.size:
        return np.zeros(0), np.zeros((0, 0))
    vectors = eigenvectors(matrix)
    vectors /= np.linalg.norm(vectors, axis=0)
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")[:most]
    order = order[values[order] > len(matrix) * EPS * max(0.0, values.max())]
    return values[order], vectors[:, order]


# --- the corpus -------------------------------------------------------------------------------------


def fit_list(rows: DataFrame, vector: str) -> DataFrame:
    """Each distinct usable vector once, packed as ``x``; a task sends its own distinct ones only."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, entries = integers(batch.column(0))
            yield pa.RecordBatch.from_arrays([packed(entries)], ["x"])

    return rows.select(vector).mapInArrow(run, "x binary").distinct()


def identity_error(fitted: DataFrame, n: int, centre: np.ndarray, matrix: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the identity."""
    size = matrix.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                white = (unpacked(batch.column(0)) - centre) @ matrix
                total += white.sum(axis=0)
                product += white.T @ white
        i, j = (index.ravel() for index in np.indices((size, size + 1)))
        sums = np.hstack([product, total[:, None]]).ravel()  # the last column holds the sums
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(sums)], ["i", "j", "sum"]
        )

    parts = fitted.select("x").mapInArrow(run, "i int, j int, sum double")
    found = parts.groupBy("i", "j").agg(F.sum("sum").alias("sum")).collect()
    sums = np.zeros((size, size + 1))
    for row in found:
        sums[row.i, row.j] = row.sum / n
    # the mean is zero but for rounding, so nothing cancels here
    spread = sums[:, :size] - np.outer(sums[:, size], sums[:, size])
    return float(np.abs(spread - np.eye(size)).max())


WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double,"
    " identity_error double"
)


def deviations(n: int, entries: np.ndarray, sums: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n*x - S)**2 of each row, exact; null where it is beyond a long."""
    about = np.square(n * entries.astype(float) - sums).sum(axis=1)
    if about.max() < 2.0**62 and n * np.abs(entries).max().astype(float) < 2.0**62:
        far = n * entries - sums
        return pa.array(np.einsum("ij,ij->i", far, far))
    whole = sums.tolist()
    out: list[int | None] = []
    for row, near in zip(entries, about.tolist(), strict=True):
        exact = None
        if near < 2.0**63 * 1.001:
            exact = sum((n * x - s) ** 2 for x, s in zip(row.tolist(), whole, strict=True))
        out.append(exact if exact is not None and exact < 1 << 63 else None)
    return pa.array(out, pa.int64())


def whiten(
    rows: DataFrame, scratch: Scratch, most: int = 4, row_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Each usable row projected on the first ``most`` components, one row for each component.

    Rows whose vector is null, empty or holds a null or non-finite entry are left out. Entries are
    floor(256 * c); statistics are over the distinct vectors, so copies weigh as one, while every row,
    repeated or without an id, is projected. Components without variance are left out: an empty table,
    a single distinct vector and equal vectors give no rows. ``deviation`` is exact, and null where it
    does not fit a long. Only the id and the vector are read, so further columns cannot clash. What
    passes through the driver are sums and products of dimensions, never rows.
    """
    prepare(rows.sparkSession)
    fitted = scratch.save(fit_list(rows, vector), "fit")
    n, total = totals(fitted)
    if n == 0:
        return rows.sparkSession.createDataFrame([], WHITENED)
    matrix = covariance(fitted, n, total)
    values, vectors = components(matrix, most)
    if not len(values):
        return rows.sparkSession.createDataFrame([], WHITENED)
    centre = total / n
    scaled = vectors / np.sqrt(values)
    explained = values / np.trace(matrix)
    error = identity_error(fitted, n, centre, scaled)
    shared = rows.sparkSession.sparkContext.broadcast((total, scaled))
    size = len(values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, to_white = shared.value
        for batch in batches:
            at, entries = integers(batch.column(1))
            if not len(at):
                continue
            deviation = deviations(n, entries, sums)
            white = (entries - sums / n) @ to_white
            ids = batch.column(0).take(pa.array(np.repeat(at, size)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids.cast(pa.int64()),
                    pa.array(np.tile(np.arange(1, size + 1), len(at)), pa.int32()),
                    pa.array(np.full(len(at) * size, n), pa.int64()),
                    deviation.take(pa.array(np.repeat(np.arange(len(at)), size))),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(len(at) * size, error)),
                ],
                [field.split()[0] for field in WHITENED.split(", ")],
            )

    return rows.select(row_id, vector).mapInArrow(run, WHITENED)
