"""Connected components of a graph given as edges, by turns of large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.common import Scratch

#: Edges up to which one task has them all, and the steps need no shuffle. Beyond, they are spread.
FEW = 100_000

Gather = Callable[[DataFrame], DataFrame]


def _least(edges: DataFrame, gather: Gather, scratch: Scratch, name: str) -> DataFrame:
    """The least neighbour of each ``a``; saved, so that the join with it may split hot nodes."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return gather(scratch.save(least, name))


def _large_star(edges: DataFrame, gather: Gather, scratch: Scratch, name: str) -> DataFrame:
    """Hang every larger neighbour of a node on the least node of its neighbourhood."""
    both = gather(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    joined = both.join(_least(both, gather, scratch, name), "a").filter(F.col("b") > F.col("a"))
    return joined.select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()


def _small_star(edges: DataFrame, gather: Gather, scratch: Scratch, name: str) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    edges = gather(edges)
    joined = edges.join(_least(edges, gather, scratch, name), "a")
    smaller = joined.filter(F.col("b") > F.col("least")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )
    own = joined.select("a", F.col("least").alias("b"))
    return gather(smaller.unionByName(own)).distinct()


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").bitwiseAND(0xFFFFFFFF)).alias("mark"),
    ).first()
    return row.n, row.mark


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label): the least node of its component, for every node that has an edge.

    ``edges`` has long columns ``a`` and ``b``; direction, loops and repeats do not matter. Each turn is
    a partial aggregation and an equality join on saved tables; the edges never grow in number.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = edges.select(a, b).filter(F.col("a") != F.col("b")).distinct()
    edges = scratch.save(edges, f"{name}-edges-0")
    before, turn = _mark(edges), 0
    few = before[0] <= FEW  # their number never grows

    def gather(rows: DataFrame) -> DataFrame:
        return rows.coalesce(1) if few else rows

    while before[0]:
        turn += 1
        large = _large_star(edges, gather, scratch, f"{name}-large-least-{turn}")
        large = scratch.save(large, f"{name}-large-{turn}")
        small = _small_star(large, gather, scratch, f"{name}-small-least-{turn}")
        edges = scratch.save(small, f"{name}-edges-{turn}")
        now = _mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots
    ).distinct()
