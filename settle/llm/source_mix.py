"""Mixing sources to target weights by temperature.

A source's share of the tokens is raised to an exponent between 0 (all sources alike) and 1 (as they
are). Bisection finds the flattest mixture that keeps to a limit of repetition, or the least flat one
that reaches an entropy. The normalised weights become budgets of tokens, and a budget is spent on
passes over the source's blocks: whole passes, and for the rest one pass cut off where the budget ends.
Blocks are dealt by a hash of the document id and permuted anew for every pass by a hash of their
number, so the mixture is the same on every run and every layout of the input.

DataFrame functions only. A source is never one group: sums are partial, running sums go over blocks in
256 buckets of the permutation, and documents are put in order only within the one block a source's
budget ends in.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settle.llm.common import WORD, Scratch
from settle.operators.joins import attach

#: Tokens of a block, halvings of the exponent's interval, and how many of them one job settles.
BLOCK_TOKENS = 16_384
HALVINGS = 20
AT_ONCE = 5

#: Of totals a source: largest, sum of powers, sum of powers times logarithm, most power per token.
Moments = dict[str, float]


def prepared(documents: DataFrame, carried: list[str]) -> DataFrame:
    """Rows to mix: the carried columns as ``row``, and the words of the whole text as tokens.

    A null source is a source of its own. Null texts and texts without words have no tokens.
    """
    named = F.concat(F.lit("s"), F.col("source"))
    return documents.select(
        F.struct(*carried).alias("row"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"),
        F.coalesce(named, F.lit("n")).alias("source"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_tokens"),
    )


def _digest(*parts: Column | int) -> Column:
    columns = [part if isinstance(part, Column) else F.lit(str(part)) for part in parts]
    return F.md5(F.concat_ws(":", *(column.cast("string") for column in columns)).cast("binary"))


def _number(digest: Column) -> Column:
    """The first 60 bits of a digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


# --- the exponent -----------------------------------------------------------------------------


def moments(totals: DataFrame, exponents: list[float]) -> dict[float, Moments]:
    """What the targets need to know of the sources, for several exponents in one job.

    Tokens are measured against the largest source, which keeps powers within reach of a double.
    """
    exponent = F.explode(F.array(*(F.lit(x) for x in exponents))).alias("x")
    share = F.col("tokens") / F.col("largest")
    power = F.pow(share, F.col("x"))
    found = totals.select("tokens", "largest", exponent).groupBy("x").agg(
        F.sum(power).alias("powers"),
        F.sum(power * F.log(share)).alias("logs"),
        F.max(power / share).alias("most"),
    )
    return {row.x: row.asDict() for row in found.collect()}


def bisect(totals: DataFrame, flat_enough: Callable[[float, Moments], bool]) -> float:
    """The least exponent, in steps of 2**-20, that ``flat_enough`` refuses to call too flat.

    ``flat_enough`` is false up to some exponent and true from there on; at 1 it is taken as true.
    A job answers for the 31 exponents that five halvings may ask for.
    """
    scale = 1 << HALVINGS
    low, high = -1, scale  # refused, accepted
    while high - low > 1:
        step = max(1, (high - low) >> AT_ONCE)
        asked = [x for x in range(low + step, high, step) if x >= 0]
        answers = moments(totals, [x / scale for x in asked])
        accepted = [x for x in asked if flat_enough(x / scale, answers[x / scale])]
        refused = [x for x in asked if x not in set(accepted)]
        high = min(accepted, default=high)
        low = max((x for x in refused if x < high), default=low)
    return high / scale


def keeps_repetition(limit: float, budget: int | None, total: int, largest: int):
    """No source is passed over more than ``limit`` times.

    Without a budget the largest source is passed over once, so that no document is left out.
    """

    def accepted(exponent: float, m: Moments) -> bool:
        if budget is None:
            return m["most"] <= limit
        return budget / largest * m["most"] / m["powers"] <= limit

    return accepted


def reaches_entropy(least: float):
    """Refuses exponents whose weights have more entropy (in nats) than ``least``."""

    def accepted(exponent: float, m: Moments) -> bool:
        return math.log(m["powers"]) - exponent * m["logs"] / m["powers"] <= least

    return accepted


# --- the mixture ------------------------------------------------------------------------------


def mix(
    rows: DataFrame,
    scratch: Scratch,
    repetition: float | None = 2.0,
    entropy: float | None = None,
    budget: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 17,
) -> DataFrame:
    """(row, source, n_tokens, pass, block, block_key): one row for each time a row is passed over.

    Give either a limit of ``repetition`` or an ``entropy`` (in nats), and a ``budget`` of tokens or
    none: then the largest source is passed over once and the others at least once. A pass is read by
    ascending ``block_key``. The last pass over a source ends with the document that brings it nearest
    to its budget. Rows without tokens go with their block; a source without any tokens is passed over
    once. Rows that repeat an id share its block. An empty table gives an empty result.
    """
    if (repetition is None) == (entropy is None):
        raise ValueError("give a limit of repetition or an entropy")
    per_source = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    totals = scratch.save(per_source, "totals")
    whole = totals.agg(
        F.sum("tokens").alias("all"), F.max("tokens").alias("largest"), F.count("*").alias("n")
    ).first()
    total, largest = whole["all"] or 0, whole["largest"] or 0
    weighed = totals.filter("tokens > 0").withColumn("largest", F.lit(largest))
    target = (
        reaches_entropy(entropy)
        if entropy is not None
        else keeps_repetition(repetition, budget, total, largest)
    )
    exponent = bisect(weighed, target) if total else 1.0

    power = F.pow(F.col("tokens") / F.lit(largest), F.lit(exponent))
    if budget is None:
        quota = power * F.lit(largest)
    else:
        powers = moments(weighed, [exponent])[exponent]["powers"] if total else 1.0
        quota = power / F.lit(powers) * F.lit(budget)
    quotas = totals.select(
        "source",
        F.when(F.col("tokens") > 0, F.round(quota)).otherwise(0).cast("long").alias("quota"),
        "tokens",
    )
    quotas = scratch.save(
        quotas.select(
            "source",
            F.when(F.col("tokens") > 0, F.expr("quota div tokens")).otherwise(1).alias("passes"),
            F.when(F.col("tokens") > 0, F.expr("quota % tokens")).otherwise(0).alias("rest"),
            F.expr(f"greatest(1, (tokens + {block_tokens - 1}) div {block_tokens})").alias("blocks"),
        ),
        "quotas",
    )
    placed = attach(rows, quotas, ["source"], whole["n"], ["id"]).withColumn(
        "block", F.pmod(_number(_digest(seed, F.col("id"))), F.col("blocks"))
    )
    return _whole_passes(placed).unionByName(_last_pass(placed, scratch, seed)).select(
        "row",
        F.when(F.col("source") == "n", F.lit(None)).otherwise(F.expr("substring(source, 2)")).alias(
            "source"
        ),
        "n_tokens",
        "pass",
        "block",
        _digest(seed, F.col("pass"), F.col("source"), F.col("block")).alias("block_key"),
    )


_OUT = ["row", "source", "n_tokens", "block"]


def _whole_passes(placed: DataFrame) -> DataFrame:
    some = placed.filter("passes > 0")
    return some.select(
        *_OUT, F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))).alias("nth")
    ).select(*_OUT, (F.col("nth") - 1).alias("pass"))


def _last_pass(placed: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """The blocks a source's rest of budget pays for, and the documents it pays for in the next."""
    rest = placed.filter("rest > 0")
    key = _digest(seed, F.col("passes"), F.col("source"), F.col("block"))
    blocks = rest.groupBy("source", "block", "passes", "rest").agg(
        F.sum("n_tokens").alias("tokens")
    )
    blocks = scratch.save(
        blocks.withColumn("key", key).withColumn("bucket", F.substring("key", 1, 2)), "blocks"
    )
    buckets = blocks.groupBy("source", "bucket").agg(F.sum("tokens").alias("in_bucket"))
    by_bucket = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    buckets = scratch.save(
        buckets.withColumn("before", F.coalesce(F.sum("in_bucket").over(by_bucket), F.lit(0))),
        "buckets",
    )
    by_key = Window.partitionBy("source", "bucket").orderBy("key", "block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = F.coalesce(F.sum("tokens").over(by_key), F.lit(0))
    left = blocks.join(buckets, ["source", "bucket"]).select(
        "source", "block", "tokens", (F.col("rest") - F.col("before") - within).alias("left")
    )
    left = scratch.save(
        left.filter("left > 0").select(
            "source", "block", "left", (F.col("tokens") <= F.col("left")).alias("whole")
        ),
        "left",
    )
    chosen = rest.join(left, ["source", "block"])
    by_id = Window.partitionBy("source", "block").orderBy(
        _digest(seed, F.col("passes"), F.col("id")), "id", "n_tokens"
    ).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n_tokens").over(by_id), F.lit(0))
    cut = chosen.filter(~F.col("whole")).withColumn("earlier", before)
    cut = cut.filter(2 * F.col("earlier") + F.col("n_tokens") <= 2 * F.col("left"))
    out = [*_OUT, F.col("passes").alias("pass")]
    return chosen.filter("whole").select(*out).unionByName(cut.select(*out))


def mixed_documents(documents: DataFrame, scratch: Scratch, **targets) -> DataFrame:
    """The documents of the mixture with the columns they came with, repeated as often as passed over."""
    return mix(prepared(documents, documents.columns), scratch, **targets).select("row.*")
