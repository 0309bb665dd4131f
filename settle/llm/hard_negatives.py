"""Hard negatives by threshold joins over an inverted index, after L2AP.

Queries (an anchor and a window of scores) are joined with all rows above a threshold. A block of rows is
indexed by groups of dimensions. A row's first groups are left out of the index as long as their norm alone,
by the inequality of Cauchy and Schwarz, cannot reach the threshold; the lists of the other groups are
prefixes of the block, as rows are ordered by their first indexed group. Partial scores are added up from the
last group to the first, and pairs whose remaining norms cannot reach the threshold are given up.

Where a window does not fill, its threshold is lowered and it is joined again. The first threshold comes from
the mean and the covariance of all rows, as if scores were normal: that decides how often a window is
joined, never what is found.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from settle.llm.common import Scratch, prepare
from settle.llm.token_files import opened
from settle.llm.vectors import covariance, integers, packed, totals, unpacked

#: Rows of a block, queries joined with it at a time, and dimensions of a group of the index.
BLOCK_ROWS = 16_384
CHUNK_QUERIES = 256
GROUP = 8
#: Rows a threshold is meant to let through for each row wanted, and the factor of the next one.
EXPECTED = 3
LOWERED = 8
#: Share of pairs of a block and a chunk below which the pairs left are followed one by one.
FEW_PAIRS = 1 / 16
#: Bounds of norms are widened by this much, so that rounding never gives up a pair.
SLACK = 1 + 1e-9
EVERY = -(1 << 62)


# --- one block of rows, one chunk of queries ---------------------------------------------------


def exact_kind(*parts: np.ndarray) -> type:
    """Doubles where every partial score is a whole number below 2**53, else Python's integers."""
    norms = [float(np.square(p.astype(float)).sum(axis=1).max()) if len(p) else 0.0 for p in parts]
    return np.float64 if np.prod(np.sqrt(norms)) < 2.0**52 else object


class Block:
    """Rows of one label or of several, with the norms of their first dimensions, group by group."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, entries: np.ndarray) -> None:
        self.ids, self.labels, self.entries = ids, labels, entries
        self.edges = [*range(0, entries.shape[1], GROUP), entries.shape[1]]
        self.before = self.norms(entries)

    def norms(self, entries: np.ndarray) -> np.ndarray:
        """Norm of the dimensions before each edge."""
        squares = np.square(entries.astype(float))
        sums = np.add.reduceat(squares, self.edges[:-1], axis=1)
        return np.sqrt(np.hstack([np.zeros((len(entries), 1)), np.cumsum(sums, axis=1)]))

    def pairs(
        self, queries: np.ndarray, least: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the pairs that score ``least`` of the query or more, as places."""
        kind = exact_kind(queries, self.entries)
        before = self.norms(queries)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.nan_to_num(least / (before[:, -1] * SLACK), nan=0.0).min()
        # groups of each row whose norm alone cannot reach any query's threshold
        omitted = (self.before[:, 1:] < ratio).sum(axis=1)
        order = np.argsort(omitted, kind="stable")
        first = omitted[order]
        rows, row_norms = self.entries[order].astype(kind), self.before[order]
        own = queries.astype(kind)
        scores = np.zeros((len(queries), len(rows)), kind)
        groups = len(self.edges) - 1
        for group in range(groups - 1, -1, -1):
            listed = int(np.searchsorted(first, group, side="right"))
            dims = slice(self.edges[group], self.edges[group + 1])
            scores[:, :listed] += own[:, dims] @ rows[:listed, dims].T
            if group and group % 2 == 0:
                alive = scores + self._left(before, row_norms, np.maximum(first, group)) >= least[:, None]
                if np.count_nonzero(alive) <= FEW_PAIRS * alive.size:
                    break
        else:
            group = 0
            alive = scores + self._left(before, row_norms, first) >= least[:, None]
        query, row = np.nonzero(alive)
        found = scores[query, row]
        del scores, alive
        for step in range(group - 1, -1, -1):  # the other groups, pair by pair
            own_pairs = np.flatnonzero(first[row] <= step)
            found[own_pairs] += self._products(own, rows, query[own_pairs], row[own_pairs], step)
            reach = np.maximum(first[row], step)
            left = before[query, reach] * row_norms[row, reach] * SLACK
            keep = found + left >= least[query]
            query, row, found = query[keep], row[keep], found[keep]
        for step in range(int(first.max(initial=0))):  # those left out of the index
            own_pairs = np.flatnonzero(first[row] > step)
            found[own_pairs] += self._products(own, rows, query[own_pairs], row[own_pairs], step)
        keep = found >= least[query]
        return query[keep], order[row[keep]], found[keep].astype(np.int64)

    def _left(self, before: np.ndarray, row_norms: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """What the dimensions before group ``reach`` of each row can still add to a pair's score."""
        return before[:, reach] * (row_norms[np.arange(len(reach)), reach] * SLACK)

    def _products(self, own, rows, query, row, group: int) -> np.ndarray:
        dims = slice(self.edges[group], self.edges[group + 1])
        return (own[query, dims] * rows[row, dims]).sum(axis=1)


def first_of(group: np.ndarray, score: np.ndarray, row_id: np.ndarray, want: int) -> np.ndarray:
    """Places of the first ``want`` of each group: higher scores first, then smaller ids."""
    order = np.lexsort((row_id, -score, group))
    group = group[order]
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else []
    rank = np.arange(len(group)) - np.repeat(starts, np.diff([*starts, len(group)]))
    return order[rank < want]


# --- all rows against all queries ---------------------------------------------------------------

#: One window of one anchor: ``least`` is the threshold now, ``low`` and ``high`` bound the window.
ASKS = (
    "key long, ask int, anchor_id long, label long, x binary, low long, high long, least long"
)
HITS = "key long, ask int, row_id long, score long"


def join(rows: DataFrame, asks_path: str, want: int, same_label: bool) -> DataFrame:
    """The first ``want`` rows of each block for each stored query: score in the window, ``least`` or more.

    A task holds one block of rows and reads the stored queries chunk by chunk; neither side is ever
    whole in a task. Rows with the anchor's id are never found.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield from block(held)
                held = []
        if held:
            yield from block(held)

    def block(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        if not whole.num_rows:
            return
        ids, labels = whole.column(0).to_numpy(), whole.column(1).to_numpy()
        entries = unpacked(whole.column(2))
        parts = [np.arange(len(ids))]
        if same_label:
            order = np.argsort(labels, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(labels[order])) + 1)
        blocks = [(labels[p[0]], Block(ids[p], labels[p], entries[p])) for p in parts]
        system, path = opened(asks_path)
        stored = ds.dataset(path, filesystem=system, format="parquet")
        for chunk in stored.to_batches(batch_size=CHUNK_QUERIES, batch_readahead=1, fragment_readahead=1):
            for start in range(0, chunk.num_rows, CHUNK_QUERIES):
                found = list(searched(blocks, chunk.slice(start, CHUNK_QUERIES)))
                if found:
                    yield pa.Table.from_batches(found).combine_chunks().to_batches()[0]

    def searched(blocks, chunk: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        longs = ("key", "ask", "anchor_id", "label", "low", "high", "least")
        key, ask, anchor, label, low, high, least = (chunk.column(n).to_numpy() for n in longs)
        entries = unpacked(chunk.column("x"))
        for own_label, block_ in blocks:
            # the windows of one anchor share its scores
            chosen = np.flatnonzero(label == own_label) if same_label else np.arange(len(key))
            if not len(chosen):
                continue
            _, firsts, anchor_of = np.unique(key[chosen], return_index=True, return_inverse=True)
            lowest = np.full(len(firsts), np.iinfo(np.int64).max)
            np.minimum.at(lowest, anchor_of, np.maximum(low, least)[chosen])
            at, row, score = block_.pairs(entries[chosen[firsts]], lowest)
            other = block_.ids[row] != anchor[chosen[firsts[at]]]
            if not same_label:
                other &= block_.labels[row] != label[chosen[firsts[at]]]
            at, row, score = at[other], row[other], score[other]
            windows: list[list[int]] = [[] for _ in firsts]
            for place, of in zip(chosen.tolist(), anchor_of.tolist(), strict=True):
                windows[of].append(place)
            most = max(map(len, windows))
            for nth in range(most):  # one window of each anchor at a time
                place = np.array([w[nth] if nth < len(w) else -1 for w in windows])[at]
                within = (place >= 0) & (score >= np.maximum(low, least)[place]) & (score <= high[place])
                p, r, s = place[within], row[within], score[within]
                best = first_of(p, s, block_.ids[r], want)
                if len(best):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[p[best]], pa.int64()),
                            pa.array(ask[p[best]], pa.int32()),
                            pa.array(block_.ids[r[best]], pa.int64()),
                            pa.array(s[best], pa.int64()),
                        ],
                        ["key", "ask", "row_id", "score"],
                    )

    return rows.select("row_id", "label", "x").mapInArrow(run, HITS)


def thresholds(asks: DataFrame, mean: np.ndarray, spread: np.ndarray, expected: int) -> DataFrame:
    """``least`` of each query: the score that about ``expected`` rows reach within its window.

    Read from a normal distribution with the mean and the variance that all rows' scores have with the
    anchor. Where so many rows are not there, it is the lower end of the window.
    """
    normal = NormalDist()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            entries = unpacked(batch.column("x")).astype(float)
            centre = entries @ mean
            width = np.sqrt(np.maximum(np.einsum("ij,ij->i", entries @ spread, entries), 0))
            least = []
            bounds = (batch.column(n).to_pylist() for n in ("low", "high", "n_rows"))
            for m, w, low, high, n in zip(centre.tolist(), width.tolist(), *bounds, strict=True):
                below = normal.cdf((high - m) / w) if w > 0 else 0.0
                share = below - expected / max(1, n)
                within = low
                if 0 < share < 1:
                    within = max(low, int(np.floor(m + w * normal.inv_cdf(share))))
                least.append(within)
            at = batch.schema.get_field_index("least")
            yield batch.set_column(at, "least", pa.array(least, pa.int64()))

    schema = f"{ASKS}, n_rows long"
    names = [field.split()[0] for field in schema.split(", ")]
    return asks.select(*names).mapInArrow(run, schema)


def fill(
    rows: DataFrame,
    asks: DataFrame,
    statistics: tuple[np.ndarray, np.ndarray],
    scratch: Scratch,
    name: str,
    want: int,
    same_label: bool,
) -> DataFrame:
    """(key, ask, row_id, score, rank): the first ``want`` rows of each query's window, all if fewer."""
    found: list[DataFrame] = []
    expected, turn = EXPECTED * want, 0
    open_ = asks.withColumn("least", F.lit(0).cast("long"))
    while True:
        now = thresholds(open_, *statistics, expected)
        now = now.sortWithinPartitions("label", "anchor_id", "key", "ask")
        path = f"{name}-asks-{turn}"
        now = scratch.save(now, path)
        hits = join(rows, f"{scratch.path}/{path}", want, same_label)
        best = Window.partitionBy("key", "ask").orderBy(F.desc("score"), "row_id")
        hits = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= want)
        hits = scratch.save(hits, f"{name}-hits-{turn}")
        filled = hits.filter(F.col("rank") == want).select("key", "ask")
        whole = now.filter("least <= low").select("key", "ask")
        done = filled.unionByName(whole).distinct()
        left = scratch.save(now.join(done, ["key", "ask"], "left_anti"), f"{name}-left-{turn}")
        if left.isEmpty():
            found.append(hits)
            break
        found.append(hits.join(left.select("key", "ask"), ["key", "ask"], "left_anti"))
        open_, expected, turn = left, expected * LOWERED, turn + 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# --- the corpus -----------------------------------------------------------------------------------

MINED = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long,"
    " negative_score long"
)


def usable(rows: DataFrame, row_id: str, vector: str, label: str, anchor) -> DataFrame:
    """(row_id, label, x, anchor) of the rows with an id, a label and a whole vector."""
    known = rows.filter(F.col(row_id).isNotNull() & F.col(label).isNotNull())
    narrow = known.select(
        F.col(row_id).cast("long").alias("row_id"),
        F.col(label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.col(vector).alias("vector"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, entries = integers(batch.column(3))
            kept = [batch.column(i).take(pa.array(at)) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*kept, packed(entries)], ["row_id", "label", "anchor", "x"]
            )

    return narrow.mapInArrow(run, "row_id long, label long, anchor boolean, x binary")


def mine(
    rows: DataFrame,
    scratch: Scratch,
    anchor,
    row_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """For each anchor and positive, the hardest rows of other labels whose score is no more than
    ``high`` and no less than ``low`` hundredths of the positive's.

    A score is the inner product of the integer vectors. Higher scores come first, of equal scores the
    smaller id. An anchor's positives are its first rows of the same label. ``anchor`` is a condition on
    the rows. Rows without an id or label, or without a whole vector, take no part. Rows that repeat an id
    are rows of their own, but never positives of an anchor with that id, and an anchor that is there
    twice asks once. Positives below zero have an empty window. Anchors without a positive or a row in
    the window, and empty tables, give no rows. Only the named columns are read.
    """
    prepare(rows.sparkSession)
    base = scratch.save(usable(rows, row_id, vector, label, anchor), "rows")
    n, total = totals(base)
    if n == 0:
        return rows.sparkSession.createDataFrame([], MINED)
    statistics = total / n, covariance(base, n, total)
    counts = base.groupBy("label").agg(F.count("*").alias("n_same"))
    asked = base.filter("anchor").select("row_id", "label", "x").distinct()
    asked = asked.select(
        F.xxhash64("row_id", "label", "x").alias("key"),
        F.col("row_id").alias("anchor_id"),
        "label",
        "x",
    )
    asked = scratch.save(asked.join(counts, "label"), "anchors")
    first = asked.select(
        "key",
        F.lit(0).alias("ask"),
        "anchor_id",
        "label",
        "x",
        F.lit(EVERY).alias("low"),
        F.lit(-EVERY).alias("high"),
        F.col("n_same").alias("n_rows"),
    )
    near = fill(base, first, statistics, scratch, "positives", positives, same_label=True)
    near = near.select("key", F.col("rank").alias("ask"), F.col("row_id").alias("positive_id"),
                       F.col("score").alias("positive_score"))
    # a positive below zero has an empty window
    windows = near.filter("positive_score >= 0").select(
        "*",
        F.expr(f"({low} * positive_score + 99) div 100").alias("low"),
        F.expr(f"({high} * positive_score) div 100").alias("high"),
    )
    windows = scratch.save(windows.filter("low <= high"), "windows")
    second = windows.join(asked, "key").select(
        "key", "ask", "anchor_id", "label", "x", "low", "high", (F.lit(n) - F.col("n_same")).alias("n_rows")
    )
    hard = fill(base, second, statistics, scratch, "negatives", negatives, same_label=False)
    named = windows.join(asked.select("key", "anchor_id"), "key").select(
        "key", "ask", "anchor_id", "positive_id", "positive_score"
    )
    return hard.join(named, ["key", "ask"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("row_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
