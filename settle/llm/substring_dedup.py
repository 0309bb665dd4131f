"""Repeated passages: windows of words that an earlier document has as well.

Every window of 13 words has a minimiser, the least hash among its runs of six words. Consecutive
windows with the same minimiser are one super-k-mer: their words travel once, as one packed string, to
the bucket of the minimiser. Equal windows have equal minimisers and so meet in one bucket, which sees
its strings by ascending document id and compares the windows' words themselves.

Minimisers are counted before anything is packed: a bit field of fixed size, sent to all tasks, tells
which minimisers more than one document has, and only their super-k-mers travel. A second field marks
those of very many documents. Their windows go by a second minimiser instead, the least hash among runs of
ten words, and are packed by it in the same way, again only if several documents have it. What is very
frequent then as well are long passages that very many documents quote; their buckets are dealt out by a
hash of the document id, to the more parts the more documents there are. Each part sends on the windows
that are new to it, few for a quoted passage, and the smallest document of each of these is found by an
aggregation. A field that is too full only lets more through: no answer depends on it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.bit_fields import field_of, in_field
from settle.llm.common import Scratch, columns_of, map_batches, utf8

#: Words of a window, of the runs whose hashes are compared for its minimiser, and for its second one.
WINDOW = 13
RUN = 6
LONG_RUN = 10
#: Bits of the fields of shared minimisers (8 MB each) and of those of very frequent ones (1 MB each).
SHARED_BITS = 26
HOT_BITS = 23
#: Documents from which on a minimiser is very frequent. Buckets of so many documents are dealt out to
#: ``HOT_PARTS`` parts, those of ``HOT_PARTS`` times as many to ``HOT_PARTS ** 2``, and so on.
HOT_DOCUMENTS = 256
HOT_PARTS = 64
HOT_TIERS = 3

MIX = np.uint64(0xBF58476D1CE4E5B9)
SEEDS = np.uint64(0x9E3779B97F4A7C15) * np.arange(1, 2 * WINDOW, 2, dtype=np.uint64)


# --- one document -----------------------------------------------------------------------------


def minimisers(words: list[bytes], window: int = WINDOW, run: int = RUN) -> np.ndarray:
    """The minimiser of the window that starts at each word; empty for short texts."""
    return least_runs(word_hashes(words), window, run)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def least_runs(hashes: np.ndarray, window: int, run: int) -> np.ndarray:
    """The least hash among the runs of each window."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.uint64)
    runs = np.full(n - run + 1, run, np.uint64)
    for k in range(run):
        runs += hashes[k : n - run + 1 + k] * SEEDS[k]
    runs ^= runs >> np.uint64(29)
    runs *= MIX
    runs ^= runs >> np.uint64(32)
    width, least = 1, runs  # least of ``width`` runs from each on, doubled as far as it fits
    wanted = window - run + 1
    while width < wanted:
        step = min(width, wanted - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return least


def super_kmers(
    values: np.ndarray, level: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """First window of each stretch of windows with the same minimiser, and the window after its last.

    Minimisers of different levels are different ones.
    """
    new = values[1:] != values[:-1]
    if level is not None:
        new |= level[1:] != level[:-1]
    edges = np.flatnonzero(np.concatenate([[True], new, [True]]))
    return edges[:-1], edges[1:]


def covered(starts: Iterable[tuple[int, int]], n_words: int, window: int = WINDOW) -> np.ndarray:
    """Whether each word is in a window that starts within one of the stretches (end exclusive)."""
    edges = np.zeros(n_words + 1, np.int64)
    for first, end in starts:
        edges[first] += 1
        edges[min(end - 1 + window, n_words)] -= 1
    return np.cumsum(edges[:-1]) > 0


# --- which minimisers are shared --------------------------------------------------------------


class Frequency:
    """Which minimisers several documents have, and which very many, tier by tier."""

    def __init__(self, counted: DataFrame, tiers: int) -> None:
        self.shared = field_of(counted, SHARED_BITS)
        least = [HOT_DOCUMENTS * HOT_PARTS**tier for tier in range(tiers)]
        self.hot = [field_of(counted.filter(F.col("n") >= n), HOT_BITS) for n in least]

    def is_shared(self, values: np.ndarray) -> np.ndarray:
        return in_field(self.shared, values)

    def tiers(self, values: np.ndarray) -> np.ndarray:
        """Zero for a minimiser that is not very frequent, then one more for each tier."""
        return sum(in_field(field, values).astype(np.int64) for field in self.hot)


def counted_minimisers(values: DataFrame) -> DataFrame:
    """(value, n) of the values that more than one row has."""
    return values.groupBy("value").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def first_minimisers(rows: DataFrame, window: int) -> DataFrame:
    """The distinct minimisers of each row."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.unique(minimisers(t.split(), window, min(RUN, window))) for t in utf8(batch.column(0))]
        values = np.concatenate([*found, np.zeros(0, np.uint64)])
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["value"])

    return map_batches(rows.select("text"), run, "value long")


def second_minimisers(rows: DataFrame, first: Broadcast, window: int) -> DataFrame:
    """The distinct second minimisers of each row's windows whose first one is very frequent."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text in utf8(batch.column(0)):
            hashes = word_hashes(text.split())
            hot = first.value.tiers(least_runs(hashes, window, min(RUN, window))) > 0
            if hot.any():
                found.append(np.unique(least_runs(hashes, window, min(LONG_RUN, window))[hot]))
        values = np.concatenate([*found, np.zeros(0, np.uint64)])
        return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["value"])

    return map_batches(rows.select("text"), run, "value long")


# --- buckets ----------------------------------------------------------------------------------

#: ``key`` tells apart rows that repeat an id with another text.
PACKED = "value long, part long, doc_id long, key long, first int, packed binary"
STRETCHES = "doc_id long, key long, first int, end int, packed binary"


def pack(rows: DataFrame, first: Broadcast, second: Broadcast, window: int) -> DataFrame:
    """The super-k-mers whose minimiser more than one row has."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(6)]
        ids, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc_id, key, text in zip(ids, keys, utf8(batch.column(2)), strict=True):
            words = text.split()
            hashes = word_hashes(words)
            values = least_runs(hashes, window, min(RUN, window))
            if not len(values):
                continue
            hot = first.value.tiers(values) > 0
            level = hot.astype(np.int64)
            if hot.any():
                values = np.where(hot, least_runs(hashes, window, min(LONG_RUN, window)), values)
            at, end = super_kmers(values, level)
            own, again = values[at], hot[at]
            wanted = np.where(again, second.value.is_shared(own), first.value.is_shared(own))
            if not wanted.any():
                continue
            at, end, own, again = at[wanted], end[wanted], own[wanted], again[wanted]
            # by the hash of the id: ids may share any remainder
            dealt = xxhash.xxh3_64_intdigest(str(doc_id))
            tiers = np.where(again, second.value.tiers(own), 0)
            parts = [1 + dealt % HOT_PARTS**tier if tier else 0 for tier in tiers.tolist()]
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            places = np.concatenate([[0], np.cumsum(lengths)])
            joined = b" ".join(words)
            begins, ends = places[at].tolist(), (places[end - 1 + window] - 1).tolist()
            strings = [joined[b:e] for b, e in zip(begins, ends, strict=True)]
            n = len(own)
            cells = (own.view(np.int64), parts, [doc_id] * n, [key] * n, at, strings)
            for column, more in zip(out, cells, strict=True):
                column.extend(more)
        return columns_of(out, PACKED)

    return map_batches(rows.filter("doc_id IS NOT NULL"), run, PACKED)


def compare(packed: DataFrame, window: int) -> DataFrame:
    """Judge each bucket, and return the stretches of repeated windows.

    A bucket's strings come by ascending document; a window seen in an earlier document is a repeat.
    What a bucket remembers are its distinct windows, not its rows. Buckets that were dealt out also
    return each window that is new to its part (``end`` null) with its words.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = None
        firsts: dict[bytes, int] = {}
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for value, part, doc_id, key, first, text in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if (value, part) != bucket:
                    bucket, firsts = (value, part), {}
                words = text.split(b" ")
                windows = (b" ".join(words[i : i + window]) for i in range(len(words) - window + 1))
                repeat = [firsts.setdefault(w, doc_id) < doc_id for w in windows]
                found = [
                    (doc_id, key, first + at, first + end, None)
                    for at, end in stretches(repeat)
                    if repeat[at]
                ]
                for at, again in enumerate(repeat if part else ()):
                    if not again:
                        own = b" ".join(words[at : at + window])
                        found.append((doc_id, key, first + at, None, own))
                for row in found:
                    for column, cell in zip(out, row, strict=True):
                        column.append(cell)
            yield columns_of(out, STRETCHES)

    bucketed = packed.repartition("value", "part").sortWithinPartitions(
        "value", "part", "doc_id", "first"
    )
    return bucketed.mapInArrow(run, STRETCHES)


def stretches(marks: list[bool]) -> Iterator[tuple[int, int]]:
    """Runs of equal marks, end exclusive."""
    at = 0
    for end in range(1, len(marks) + 1):
        if end == len(marks) or marks[end] != marks[at]:
            yield at, end
            at = end


def repeats(rows: DataFrame, scratch: Scratch, window: int) -> DataFrame:
    """(doc_id, key, first, end): stretches of windows that an earlier document has as well."""
    context = rows.sparkSession.sparkContext
    counted = scratch.save(counted_minimisers(first_minimisers(rows, window)), "minimisers")
    first = context.broadcast(Frequency(counted, tiers=1))
    counted = scratch.save(counted_minimisers(second_minimisers(rows, first, window)), "second")
    second = context.broadcast(Frequency(counted, tiers=HOT_TIERS))
    once = scratch.save(compare(pack(rows, first, second, window), window), "stretches")
    first.destroy()
    second.destroy()
    new = once.filter(F.col("end").isNull()).drop("end")
    least = scratch.save(new.groupBy("packed").agg(F.min("doc_id").alias("least")), "least")
    again = new.join(least, "packed").filter("least < doc_id")
    again = again.withColumn("end", F.col("first") + 1)
    columns = ["doc_id", "key", "first", "end"]
    return once.filter(F.col("end").isNotNull()).select(*columns).unionByName(
        again.select(*columns)
    )


def remove_repeats(
    documents: DataFrame, scratch: Scratch, window: int = WINDOW
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words that repeated windows cover.

    A window of ``window`` consecutive words is repeated if a document with a smaller id has it. The
    words kept are joined by one space. Null and empty texts have no words; texts shorter than a window
    lose none. Rows without an id neither lose words nor take any from others; rows that repeat an id
    are judged each by its own text and take none from each other. An empty table gives an empty
    result. Only ``doc_id`` and ``text`` are read.
    """
    rows = documents.select("doc_id", F.xxhash64("text").alias("key"), "text")
    found = repeats(rows, scratch, window)
    spans = found.groupBy("doc_id", "key").agg(
        F.collect_list(F.struct("first", "end")).alias("spans")
    )  # as many as a document has stretches

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], []]
        for text, spans_ in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            words = text.split()
            n, removed = len(words), 0
            if spans_:
                gone = covered(((s["first"], s["end"]) for s in spans_), n, window)
                words = [word for word, out_ in zip(words, gone.tolist(), strict=True) if not out_]
                removed = n - len(words)
            for column, cell in zip(out, (n, removed, b" ".join(words)), strict=True):
                column.append(cell)
        kinds = (pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *arrays], ["doc_id", "n_words", "n_removed", "kept"]
        )

    joined = rows.join(spans.hint("shuffle_hash"), ["doc_id", "key"], "left")
    kept = map_batches(
        joined.select("doc_id", "text", "spans"),
        run,
        "doc_id long, n_words long, n_removed long, kept binary",
    )
    return kept.withColumn("kept", F.col("kept").cast("string"))
