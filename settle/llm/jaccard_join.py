"""Near duplicates: an exact join of shingle sets in the metric space of the Jaccard distance.

Two documents link when their sets of five-word shingles have a Jaccard similarity of 0.8, a distance of
0.2, or more. The distance is a metric, and the join uses it as one:

* Documents with equal sets are one point.
* Every point lists its signature: so many of its shingles, in one order for all, that two linked points
  must share one, and a few more. Frequent shingles come last in that order, so passages that many
  documents quote decide nothing. A point whose signature shares less with all others together than it
  would with a single linked one is done. Points that share a shingle have the least of them as a pivot.
  A pivot and its points are a Voronoi region; a point that may have neighbours with other pivots is
  replicated to each.
* Within a region each point's distance to the pivot is computed. Points within 0.2 link to it. Of two
  points that both do, nothing more need be known: they are in one component. Points further out become
  pivots themselves and are compared with the points whose distance to the first pivot is within 0.2 of
  their own: by the triangle inequality no others can link to them. Large regions are dealt out to
  chunks, each with a copy of the pivot; the points further out are then joined ring by ring, chunk by
  chunk.

No pair is given up and none decided by a sketch. What a task holds is bounded by the size of a chunk.
Bit fields of fixed size keep shingles and texts that nothing shares from being shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.bit_fields import field_of, in_field
from settle.llm.common import Scratch, columns_of, map_batches, slices, utf8
from settle.llm.components import components

#: Words of a shingle, and the least similarity in percent.
SHINGLE = 5
PERCENT = 80
DISTANCE = 1 - PERCENT / 100
SLACK = 1e-9  # for rounding of distances; only ever lets more be compared

#: Bits of the fields of frequent shingles, shared shingles (8 MB each) and documents of regions (2 MB).
FREQUENT_BITS = 26
SHARED_BITS = 26
WANTED_BITS = 24
#: Documents from which on a shingle is frequent.
FREQUENT = 128
#: Shingles a task sorts together when it looks for frequent ones, and how many times one must occur.
COUNTED = 1 << 22
LOCALLY_FREQUENT = 3
#: One in so many shingles of a set is listed beyond the base of its signature.
EXTRA = 10
#: Points of a chunk that is compared with a pivot, and of one that is compared with another chunk.
CHUNK = 64
GRID_CHUNK = 512
#: Points whose overlaps with the others are counted together, and shingles laid out for it at a time.
AT_A_TIME = 64
LAID_OUT = 4096

SEEDS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
     0x27D4EB2F165667C5], np.uint64
)


# --- one document -----------------------------------------------------------------------------


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def shingles(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; of fewer words, one hash of the whole sequence."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    width = min(n, SHINGLE)
    found = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        found += hashes[k : n - width + 1 + k] * SEEDS[k]
    found ^= found >> np.uint64(31)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(29)
    found *= np.uint64(0x94D049BB133111EB)
    return distinct(found ^ (found >> np.uint64(32)))


def least_overlap(n: int) -> int:
    """Shingles that a set of ``n`` shares with any it links to, at least."""
    return -(-PERCENT * n // 100)


def base_length(n: int) -> int:
    """So many first shingles in a common order that linked sets have one of them in common."""
    return n - least_overlap(n) + 1


def least_shared(n: int) -> int:
    """Signature shingles that a set of ``n`` has in common with that of any it links to, at least.

    Each signature is longer than the base by a share of its set. Whatever extra shingles the shorter
    of two signatures has, linked sets have in common beyond the first one.
    """
    return 1 + least_overlap(n) // EXTRA


def signature(values: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The first shingles in the order of the join."""
    n = len(values)
    often = in_field(frequent, values)
    ordered = np.concatenate([values[~often], values[often]])
    return ordered[: base_length(n) + n // EXTRA]


# --- signatures of all documents --------------------------------------------------------------


def frequent_shingles(rows: DataFrame) -> DataFrame:
    """(value) of shingles that are frequent, as far as tasks can tell from their own documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            values = np.sort(np.concatenate([*kept, np.zeros(0, np.uint64)]))
            edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1], [True]]))
            times = np.diff(edges) if len(values) else np.zeros(0, np.int64)
            often = times >= LOCALLY_FREQUENT
            found = values[edges[:-1][often]] if len(values) else values
            return columns_of([found.view(np.int64), times[often]], "value long, n long")

        for batch in batches:
            for part in slices(batch):
                for text in utf8(part.column(0)):
                    kept.append(shingles(text))
                    held += len(kept[-1])
                    if held > COUNTED:
                        yield out()
                        kept, held = [], 0
        yield out()

    counted = rows.select("text").mapInArrow(run, "value long, n long")
    counted = counted.groupBy("value").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= FREQUENT)


SIGNED = "doc_id long, key long, n long, point binary, signature binary"


def signed(rows: DataFrame, frequent: Broadcast) -> DataFrame:
    """Set size, a key of the set (``point``) and the signature of each document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, points, signatures = [], [], []
        for text in utf8(batch.column(2)):
            values = shingles(text)
            sizes.append(len(values))
            points.append(xxhash.xxh3_128_digest(values.tobytes()))
            signatures.append(signature(values, frequent.value).tobytes())
        return columns_of([batch.column(0), batch.column(1), sizes, points, signatures], SIGNED)

    return map_batches(rows.select("doc_id", "key", "text"), run, SIGNED)


def shared_shingles(signatures: DataFrame) -> DataFrame:
    """(values): packed hashes of the shingles that are in signatures of several documents.

    A task sorts its own shingles and sends each once, packed by ranges of the hash, with those it has
    seen twice apart; whoever gets a range merges what the tasks have sent.
    """
    partitions = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4, (16 * partitions).bit_length())

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        held = 0

        def out() -> pa.RecordBatch:
            values = np.sort(np.concatenate([*kept, np.zeros(0, np.uint64)]))
            new = np.concatenate([[True], values[1:] != values[:-1]]) if len(values) else []
            again = distinct(values[~np.array(new, bool)])
            values = values[np.array(new, bool)]
            edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
            cuts = [np.append(np.searchsorted(v, edges), len(v)) for v in (values, again)]
            rows = [
                (i, values[cuts[0][i] : cuts[0][i + 1]].tobytes(),
                 again[cuts[1][i] : cuts[1][i + 1]].tobytes())
                for i in np.flatnonzero(np.diff(cuts[0]))
            ]
            return columns_of(list(zip(*rows, strict=True)) or [[], [], []], RANGE)

        for batch in batches:
            for packed in batch.column(0).to_pylist():
                kept.append(np.frombuffer(packed, np.uint64))
                held += len(kept[-1])
                if held > COUNTED:
                    yield out()
                    kept, held = [], 0
        yield out()

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, 1):
            once = np.sort(np.concatenate([np.frombuffer(own, np.uint64) for own, _ in rows]))
            twice = once[1:][once[1:] == once[:-1]]
            often = [np.frombuffer(again, np.uint64) for _, again in rows]
            values = distinct(np.concatenate([twice, *often]))
            if len(values):
                yield columns_of([[values.tobytes()]], "values binary")

    ranges = signatures.select("signature").mapInArrow(pack, RANGE)
    dealt = ranges.repartition(partitions, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(merge, "values binary")


RANGE = "part int, once binary, often binary"


def unpacked(packed: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.frombuffer(values, np.int64) for values in batch.column(0).to_pylist()]
        return columns_of([np.concatenate([*found, np.zeros(0, np.int64)])], "value long")

    return map_batches(packed.select("values"), run, "value long")


def ordered_signatures(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Signatures in an order that has frequent shingles last, and the shingles they share.

    The order is the same for all documents but need not know every frequent shingle: it saves work.
    """
    frequent = field_of(frequent_shingles(rows), FREQUENT_BITS)
    sent = rows.sparkSession.sparkContext.broadcast(frequent)
    signatures = scratch.save(signed(rows, sent), "signatures")
    sent.destroy()
    return signatures, unpacked(scratch.save(shared_shingles(signatures), "shared"))


# --- regions ----------------------------------------------------------------------------------


def points_of(signatures: DataFrame, scratch: Scratch) -> DataFrame:
    """(point, node, doc_id): a number for each distinct set, and its smallest document."""
    known = signatures.filter("n > 0 AND doc_id IS NOT NULL")
    points = known.groupBy("point").agg(F.min("doc_id").alias("doc_id"))
    return scratch.save(points.withColumn("node", F.monotonically_increasing_id()), "points")



def listed_shingles(
    signatures: DataFrame, shared: DataFrame, points: DataFrame, scratch: Scratch
) -> DataFrame:
    """(value, base, need, node): the shared signature shingles of each point.

    Points that share too few shingles to link with anything are left out.
    """
    sent = signatures.sparkSession.sparkContext.broadcast(field_of(shared, SHARED_BITS))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(5)]
        for point, doc_id, n, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = np.frombuffer(packed, np.uint64)
            hit = in_field(sent.value, values)
            if np.count_nonzero(hit) >= least_shared(n):
                in_base = np.count_nonzero(hit[: base_length(n)])
                cells = (point, doc_id, n, in_base, values[hit].tobytes())
                for column, cell in zip(out, cells, strict=True):
                    column.append(cell)
        return columns_of(out, SHORT)

    known = signatures.filter("n > 0 AND doc_id IS NOT NULL")
    short = map_batches(known.select("point", "doc_id", "n", "signature"), run, SHORT)
    # one document of each set
    mine = short.join(points, ["point", "doc_id"]).select("node", "n", "in_base", "values")

    def spread(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(4)]
        for node, n, in_base, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            values = np.frombuffer(packed, np.int64)
            size = len(values)
            cells = (values, np.arange(size) < in_base, [least_shared(n)] * size, [node] * size)
            for column, more in zip(out, cells, strict=True):
                column.extend(more)
        return columns_of(out, LISTED)

    listed = scratch.save(map_batches(mine, spread, LISTED), "listed")
    sent.destroy()
    return listed


SHORT = "point binary, doc_id long, n long, in_base long, values binary"
LISTED = "value long, base boolean, need long, node long"


def pivoted(listed: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``listed`` with the least point of each shingle as ``pivot``; lists of one point are dropped."""
    heads = listed.groupBy("value").agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
    heads = heads.filter("pivot < last").select("value", "pivot")
    return listed.join(scratch.save(heads, f"{name}-heads"), "value")


def listed_points(listed: DataFrame, scratch: Scratch) -> DataFrame:
    """(value, node, pivot): the base lists of the points that share enough with others."""
    whole = pivoted(listed, scratch, "whole")
    enough = whole.groupBy("node").agg(
        F.count("*").alias("found"), F.max("need").alias("need")
    )
    enough = scratch.save(enough.filter("found >= need").select("node"), "enough")
    base = listed.filter("base").join(enough, "node", "left_semi").select("value", "node")
    return scratch.save(pivoted(scratch.save(base, "base"), scratch, "base"), "lists")


def first_regions(lists: DataFrame) -> DataFrame:
    """(pivot, node, label): one region for each point, that of the pivot of most of its lists."""
    lists = lists.filter("pivot < node").groupBy("node", "pivot").agg(F.count("*").alias("n"))
    most = F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("pivot")
    best = lists.groupBy("node").agg(most)
    heads = best.select("pivot", F.col("pivot").alias("node")).distinct()
    members = best.select("pivot", "node").unionByName(heads)
    return members.withColumn("label", F.col("node"))


def open_regions(lists: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(pivot, node, label): regions by the lists whose points are not all in one component yet."""
    known = lists.join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node")
    )
    known = scratch.save(known, "known")
    undecided = known.groupBy("value").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    )
    undecided = undecided.filter("low < high").select("value")
    found = known.join(scratch.save(undecided, "undecided"), "value", "left_semi")
    return scratch.save(found.select("pivot", "node", "label").distinct(), "members")


def wanted_sets(
    rows: DataFrame, points: DataFrame, lists: DataFrame, scratch: Scratch
) -> DataFrame:
    """(node, shingles) of the points that are in some list, from their texts."""
    context = rows.sparkSession.sparkContext
    wanted = points.join(lists.select("node").distinct(), "node", "left_semi")
    hashed = F.xxhash64("doc_id").alias("value")
    sent = context.broadcast(field_of(wanted.select(hashed), WANTED_BITS))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit = in_field(sent.value, batch.column(0).to_numpy().view(np.uint64))
        batch = batch.filter(pa.array(hit))
        found = [shingles(text) for text in utf8(batch.column(2))]
        return columns_of(
            [
                batch.column(1),
                [xxhash.xxh3_128_digest(values.tobytes()) for values in found],
                [values.tobytes() for values in found],
            ],
            "doc_id long, point binary, shingles binary",
        )

    known = rows.filter("doc_id IS NOT NULL").select(hashed, "doc_id", "text")
    sets = map_batches(known, run, "doc_id long, point binary, shingles binary")
    found = sets.join(wanted, ["doc_id", "point"]).select("node", "shingles")
    found = scratch.save(found, "sets")
    sent.destroy()
    return found


# --- joining a region -------------------------------------------------------------------------

class Point(NamedTuple):
    node: int
    label: int  # of the component it is known to be in
    values: np.ndarray
    distance: float = 0.0  # to the pivot of the region


def overlaps(pivot: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Shingles that each of the other sets has in common with the pivot."""
    if not others:
        return np.zeros(0, np.int64)
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(pivot, every), len(pivot) - 1)
    ends = np.cumsum([len(other) for other in others])
    found = np.concatenate([[0], np.cumsum(pivot[at] == every)])[np.concatenate([[0], ends])]
    return np.diff(found)


def compared(pivot: np.ndarray, others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each other set to the pivot, and whether they link, in whole numbers."""
    both = overlaps(pivot, others)
    either = np.array([len(other) for other in others], np.int64) + len(pivot) - both
    return 1 - both / np.maximum(either, 1), 100 * both >= PERCENT * either


def shared_counts(
    rows: list[np.ndarray], own: np.ndarray, others: list[np.ndarray], places: np.ndarray
) -> np.ndarray:
    """Shingles that each chosen row has in common with each chosen one of the others.

    Rows and others hold numbers of shingles. Only shingles of the chosen rows are laid out, some
    thousands at a time, so what is held does not grow with the sets.
    """
    both = np.zeros((len(own), len(places)), np.float32)
    left = [rows[i] for i in own]
    right = [others[i] for i in places]
    columns = np.unique(np.concatenate([*left, np.zeros(0, np.int64)]))
    row_at = np.repeat(np.arange(len(left)), [len(v) for v in left])
    row_columns = np.searchsorted(columns, np.concatenate([*left, np.zeros(0, np.int64)]))
    every = np.concatenate([*right, np.zeros(0, np.int64)])
    at = np.minimum(np.searchsorted(columns, every), max(0, len(columns) - 1))
    hit = columns[at] == every if len(columns) else np.zeros(len(every), bool)
    other_at = np.repeat(np.arange(len(right)), [len(v) for v in right])[hit]
    other_columns = at[hit]
    for start in range(0, len(columns), LAID_OUT):
        a = np.zeros((len(left), LAID_OUT), np.float32)
        b = np.zeros((len(right), LAID_OUT), np.float32)
        for grid, place, column in ((a, row_at, row_columns), (b, other_at, other_columns)):
            mine = (column >= start) & (column < start + LAID_OUT)
            grid[place[mine], column[mine] - start] = 1
        both += a @ b.T
    return both.astype(np.int64)


def spanning(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> set[tuple[int, int]]:
    """Pairs of labels that join what the links between rows (``left``) and columns (``right``) join.

    Each label is paired with the least of its component, so there are fewer pairs than labels.
    """
    labels, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    rows, columns = at[: len(left)], at[len(left) :]
    least = np.arange(len(labels))
    none = len(labels)
    while True:
        by_row = np.where(linked, least[columns][None, :], none).min(axis=1, initial=none)
        by_column = np.where(linked, least[rows][:, None], none).min(axis=0, initial=none)
        new = least.copy()
        np.minimum.at(new, rows, np.minimum(by_row, least[rows]))
        np.minimum.at(new, columns, np.minimum(by_column, least[columns]))
        # what was known of a label holds for all that have it for their least
        np.minimum.at(new, least, new.copy())
        new = new[new]
        if (new == least).all():
            break
        least = new
    moved = np.flatnonzero(least != np.arange(len(labels)))
    return {(int(labels[i]), int(labels[least[i]])) for i in moved}


def far_links(far: list[Point], points: list[Point]) -> set[tuple[int, int]]:
    """Components joined by points outside the pivot's ball, as few pairs as join them.

    The points further out are pivots themselves, taken a few at a time by their distance, for the points in
    their window. Only shingles that several of the points have are looked at.
    """
    if not far or not points:
        return set()
    far = sorted(far, key=lambda p: p.distance)
    points = sorted(points, key=lambda p: p.distance)
    both_sides = far + points
    sizes = np.array([len(p.values) for p in both_sides], np.int64)
    _, numbers, times = np.unique(
        np.concatenate([p.values for p in both_sides]), return_inverse=True, return_counts=True
    )
    several = times[numbers] > 1
    ends = np.cumsum(sizes)
    shared = [
        numbers[end - size : end][several[end - size : end]]
        for end, size in zip(ends.tolist(), sizes.tolist(), strict=True)
    ]
    far_sizes, sizes = sizes[: len(far)], sizes[len(far) :]
    away = np.array([p.distance for p in points])
    far_away = np.array([p.distance for p in far])
    linked = np.zeros((len(far), len(points)), bool)
    for start in range(0, len(far), AT_A_TIME):
        own = np.arange(start, min(start + AT_A_TIME, len(far)))
        low, high = far_away[own[0]] - DISTANCE - SLACK, far_away[own[-1]] + DISTANCE + SLACK
        places = np.arange(np.searchsorted(away, low), np.searchsorted(away, high, "right"))
        both = shared_counts(shared[: len(far)], own, shared[len(far) :], places)
        either = far_sizes[own][:, None] + sizes[places][None, :] - both
        linked[np.ix_(own, places)] = 100 * both >= PERCENT * either
    return spanning(linked, np.array([p.label for p in far]), np.array([p.label for p in points]))


FOUND = (
    "pivot long, node long, label long, distance double, open boolean, a long, b long"
)


def join_chunks(chunks: DataFrame) -> DataFrame:
    """Distances to the pivot, and in regions of one chunk all links.

    Rows with ``a`` and ``b`` are linked components; the others are the points of regions of several
    chunks.
    """

    def chunk(whole: bool, pivot: int, points: list[Point]) -> list[tuple]:
        first = next(point for point in points if point.node == pivot)
        others = [point for point in points if point.node != pivot]
        away, linked = compared(first.values, [point.values for point in others])
        others = [p._replace(distance=float(d)) for p, d in zip(others, away, strict=True)]
        pairs = {
            (first.label, point.label)
            for point, link in zip(others, linked, strict=True)
            if link and point.label != first.label
        }
        # Of two components that link here, one is not the pivot's, and if its point is in the ball, it
        # is linked to the pivot's. So these are the points whose links are still to be found.
        is_open = [
            bool(not link and point.label != first.label)
            for point, link in zip(others, linked, strict=True)
        ]
        out = []
        if whole:
            pairs |= far_links([p for p, far in zip(others, is_open, strict=True) if far], others)
        else:
            out += [
                (pivot, point.node, point.label, point.distance, far, None, None)
                for point, far in zip(others, is_open, strict=True)
            ]
        return out + [(pivot, None, None, None, None, a, b) for a, b in pairs]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (pivot, _, whole), rows in grouped(batches, 3):
            points = [Point(node, label, np.frombuffer(s, np.uint64)) for node, label, s in rows]
            found = chunk(whole, pivot, points)
            if found:
                yield columns_of(list(zip(*found, strict=True)), FOUND)

    keys = ["pivot", "chunk", "whole"]
    dealt = chunks.select(*keys, "node", "label", "shingles")
    dealt = dealt.repartition("pivot", "chunk").sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, FOUND)


def grouped(
    batches: Iterable[pa.RecordBatch], keys: int
) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal first columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def dealt_out(members: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(pivot, chunk, whole, node, label): points dealt out to chunks, the pivot in each of them."""
    sizes = members.groupBy("pivot").agg(F.count("*").alias("size"))
    sizes = scratch.save(
        sizes.select("pivot", F.expr(f"(size + {CHUNK - 1}) div {CHUNK}").alias("chunks")), name
    )
    of_node = F.pmod(F.xxhash64("node"), F.col("chunks"))
    joined = members.join(sizes, "pivot")
    placed = F.when(
        F.col("node") == F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)
    ).otherwise(F.array(of_node))
    return joined.select(
        "pivot",
        F.explode(placed).alias("chunk"),
        (F.col("chunks") == 1).alias("whole"),
        "node",
        "label",
    )


def join_rings(found: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): components linked by the points outside the balls of large regions.

    A ring is as wide as the distance of a link, so a point outside the ball meets the points of its own
    ring and of the two beside it. Each ring is a grid of chunks of the former by chunks of the latter.
    """
    ring = F.floor(F.col("distance") / (DISTANCE + SLACK)).cast("int")
    points = found.filter("node IS NOT NULL").withColumn("ring", ring).select(
        "pivot", "ring", "node", "label", "distance", "open"
    )
    per_ring = ["pivot", "ring"]
    far = points.filter("open").drop("open")
    near = points.drop("open").withColumn(
        "ring", F.explode(F.array(*(F.col("ring") + k for k in (-1, 0, 1))))
    )

    def counted(rows: DataFrame, name: str) -> DataFrame:
        n = F.expr(f"(count(*) + {GRID_CHUNK - 1}) div {GRID_CHUNK}")
        return rows.groupBy(*per_ring).agg(n.alias(name))

    grid = scratch.save(counted(far, "rows").join(counted(near, "columns"), per_ring), "grid")

    def placed(rows: DataFrame, own: str, other: str, is_far: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("node"), F.col(own)).alias(own[:-1])
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[:-1])
        return rows.join(grid, per_ring).select(
            *per_ring, mine, every, F.lit(is_far).alias("far"), "node", "label", "distance"
        )

    cells = placed(far, "rows", "columns", True).unionByName(
        placed(near, "columns", "rows", False)
    )
    keys = [*per_ring, "row", "column"]
    filled = cells.join(sets, "node").select(
        *keys, "far", "node", "label", "distance", "shingles"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches, 4):
            points = [
                (is_far, Point(node, label, np.frombuffer(values, np.uint64), distance))
                for is_far, node, label, distance, values in rows
            ]
            pairs = far_links(
                [point for is_far, point in points if is_far],
                [point for is_far, point in points if not is_far],
            )
            if pairs:
                yield columns_of(list(zip(*pairs, strict=True)), "a long, b long")

    dealt = filled.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "a long, b long")


def labelled(rows: DataFrame, signatures, shared, points, scratch: Scratch) -> DataFrame:
    """(node, label): the component of every point that links to another.

    First every point meets one pivot only, which settles most groups of near copies. What is left are
    the lists that still join different components; their regions are joined whole, and what links
    them is a graph of components.
    """
    listed = listed_shingles(signatures, shared, points, scratch)
    lists = listed_points(listed, scratch)
    sets = wanted_sets(rows, points, lists, scratch)
    firsts = scratch.save(first_regions(lists), "first-members")
    chunks = dealt_out(firsts, scratch, "first-sizes").withColumn("whole", F.lit(False))
    first = scratch.save(join_chunks(chunks.join(sets, "node")), "first-found")
    first = first.filter("a IS NOT NULL").select("a", "b")
    labels = scratch.save(components(first, scratch, "first"), "first-labels")
    members = open_regions(lists, labels, scratch)
    found = join_chunks(dealt_out(members, scratch, "sizes").join(sets, "node"))
    found = scratch.save(found, "found")
    near = found.filter("a IS NOT NULL").select("a", "b")
    between = near.unionByName(join_rings(found, sets, scratch))
    joined = components(between, scratch, "second").select(
        F.col("node").alias("label"), F.col("label").alias("final")
    )
    joined = scratch.save(joined, "second-labels")
    # points that were alone after the first round are labels of their own
    alone = joined.select(F.col("label").alias("node"), "label").join(labels, "node", "left_anti")
    return (
        labels.unionByName(alone)
        .join(joined, "label", "left")
        .select("node", F.coalesce("final", "label").alias("label"))
    )


def with_components(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, component) of every row of ``documents``.

    ``key`` is ``text_key`` of the row, which tells apart rows that repeat an id. ``component`` is a
    number of the component, null for rows that link with nothing; two components of rows that repeat
    an id may have the same smallest id.
    """
    rows = documents.select("doc_id", text_key().alias("key"), "text")
    signatures, shared = ordered_signatures(rows, scratch)
    points = points_of(signatures, scratch)
    known = scratch.save(labelled(rows, signatures, shared, points, scratch), "labels")
    labels = points.join(known, "node", "left").select(
        "point", "doc_id", F.coalesce("label", "node").alias("label")
    )
    least = labels.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = labels.join(scratch.save(least, "least"), "label").select(
        "point", "component_id", F.col("label").alias("component")
    )
    result = signatures.select("doc_id", "key", F.col("n").alias("n_shingles"), "point").join(
        scratch.save(named, "named"), "point", "left"
    )
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return result.select(
        "doc_id",
        "key",
        "n_shingles",
        F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("component")).alias("component"),
    )


def text_key():
    return F.xxhash64("text")


def near_duplicates(documents: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``documents``.

    ``component_id`` is the smallest id that links lead to. Documents without words, null texts among
    them, have no shingles and link with nothing. Rows without an id link with nothing and have a null
    component. Rows that repeat an id with different texts are different points of that id. An empty
    table gives an empty result. Only ``doc_id`` and ``text`` are read.
    """
    return with_components(documents, scratch).select("doc_id", "n_shingles", "component_id")
