"""Exact duplicates by radix partitioning from the first byte on.

Texts are split by their first bytes, then each group by the bytes that follow, until a group has one
member or its texts have ended. Every round reads four times as many bytes as the one before. Only
members of groups go on, so a document that differs early is shuffled in the first round and in no other;
equality is that of the bytes, no digest decides. A round counts each group's parts with partial aggregation, so a
thousand copies leave a task as one row; attaching the part to its members is a plain equality join,
whose hot keys Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settle.llm.common import SPACE, Scratch

FIRST_BYTES = 64
GROWTH = 4


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " ")


def _part(rows: DataFrame, width: int) -> DataFrame:
    """The next bytes of ``rest``, and whether the text ends within them."""
    return rows.withColumns(
        {
            "part": F.substring("rest", 1, width),
            "ended": F.octet_length("rest") <= width,
        }
    )


def _split(rows: DataFrame, width: int, scratch: Scratch, number: int) -> DataFrame:
    """Split each group (``group``) of ``rows`` by the next ``width`` bytes of ``rest``.

    Rows that are alone get no new group. ``rest`` stays with those that have more to compare.
    """
    rows = _part(rows, width)
    keys = ["group", "part", "ended"]
    parts = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("doc_id").alias("keep"))
    parts = parts.filter(F.col("n") > 1).withColumn("next", F.monotonically_increasing_id())
    # saved, so that a group keeps its number whatever is computed again
    parts = scratch.save(parts, f"parts-{number}")
    goes_on = F.col("next").isNotNull() & ~F.col("ended")
    joined = rows.join(parts.hint("shuffle_hash"), keys, "left").select(
        "doc_id",
        "sha",
        F.col("next").alias("group"),
        "n",
        "keep",
        "ended",
        F.when(goes_on, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
    )
    return scratch.save(joined, f"split-{number}")


def deduplicate(
    documents: DataFrame, scratch: Scratch, first_bytes: int = FIRST_BYTES
) -> DataFrame:
    """One row per row of ``documents``: which row of its text stays, how many share it, whether it stays.

    Texts are compared after normalising white space; null counts as empty. The smallest id stays; null
    ids lose to others, and of rows that repeat an id and a text one stays. An empty table gives an
    empty result. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
    """
    text = normalised(F.col("text"))
    active = documents.select(
        "doc_id",
        F.sha2(text, 256).alias("sha"),
        F.lit(0).cast("long").alias("group"),
        text.cast("binary").alias("rest"),
    )
    resolved: list[DataFrame] = []
    width = first_bytes
    while True:
        rows = _split(active, width, scratch, len(resolved))
        resolved.append(rows.filter(F.col("group").isNull() | F.col("ended")).drop("rest"))
        active = rows.filter(F.col("group").isNotNull() & ~F.col("ended")).select(
            "doc_id", "sha", "group", "rest"
        )
        if active.isEmpty():
            break
        width *= GROWTH
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    parts = [_judged(rows).select(*columns) for rows in resolved]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _judged(rows: DataFrame) -> DataFrame:
    alone = F.col("group").isNull()
    rows = rows.select(
        "doc_id",
        "group",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("long").alias("group_size"),
        F.col("sha").alias("text_sha256"),
        alone.alias("alone"),
    )
    first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    sure = rows.filter(F.col("alone") | ~first).withColumn("kept", F.col("alone"))
    # as a rule one row a group
    repeats = Window.partitionBy("group", "doc_id").orderBy("text_sha256")
    tied = rows.filter(~F.col("alone") & first).withColumn("kept", F.row_number().over(repeats) == 1)
    return sure.unionByName(tied)
