"""URL rules by a cascade of Bloom filters.

The first filter holds the listed keys. It also lets some unlisted keys of the corpus through; since the
corpus is known as a whole, these are found and put into a second filter; the listed keys that this one
wrongly holds go into a third, and so on until none are wrong. A key is listed if the first filter that
does not hold it is an even one. For every key of the corpus the answer is exact, and a lookup is a few
bit tests: the corpus is neither joined nor shuffled.

A rule is a host and the beginning of a path. The keys of a URL are its host cut to as many labels, and
its path cut to as many characters, as some rule has.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from settle.llm.common import Scratch, map_batches

ALLOW, BLOCK = "allow", "block"
#: Bits of one filter at most (256 MB), and shapes of rules (labels, characters) at most.
MOST_BITS = 1 << 31
MOST_SHAPES = 10_000


class Bloom:
    """A Bloom filter whose bits Spark has gathered."""

    def __init__(self, level: int, bits: int, hashes: int, words: np.ndarray) -> None:
        self.level, self.bits, self.hashes, self.words = level, bits, hashes, words

    @staticmethod
    def sized(keys: int, rate: float) -> tuple[int, int]:
        """Bits and hash functions for so many keys and such a share of false positives."""
        hashes = max(1, round(-math.log2(rate)))
        bits = max(64, math.ceil(-hashes * keys / math.log1p(-(rate ** (1 / hashes)))))
        if bits > MOST_BITS:
            raise ValueError(f"a filter of {bits} bits is too large to send around")
        return bits, hashes

    @staticmethod
    def places(keys: Sequence[str], level: int, bits: int, hashes: int) -> np.ndarray:
        """Bit numbers of each key, one row a key. Each level hashes anew."""
        found = (xxhash.xxh3_64_intdigest(key, level) for key in keys)
        whole = np.fromiter(found, np.uint64, len(keys))
        first, second = whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32) | np.uint64(1)
        steps = np.arange(hashes, dtype=np.uint64)
        return (first[:, None] + steps * second[:, None]) % np.uint64(bits)

    def holds(self, keys: Sequence[str]) -> np.ndarray:
        at = self.places(keys, self.level, self.bits, self.hashes)
        bits = self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)
        return bits.all(axis=1)


class Cascade:
    """Membership in a list, exact for the keys it was built over."""

    def __init__(self, levels: list[Bloom]) -> None:
        self.levels = levels

    def listed(self, keys: Sequence[str]) -> np.ndarray:
        answer = np.zeros(len(keys), bool)
        left = np.arange(len(keys))
        for number, level in enumerate(self.levels):
            held = level.holds([keys[i] for i in left]) if len(left) else np.zeros(0, bool)
            answer[left[~held]] = number % 2 == 1
            left = left[held]
        answer[left] = len(self.levels) % 2 == 1
        return answer


def filter_of(keys: DataFrame, n: int, level: int, rate: float) -> Bloom:
    """Set the bits in tasks, merge equal words on the way, and fetch the words that have bits."""
    bits, hashes = Bloom.sized(n, rate)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = Bloom.places(batch.column(0).to_pylist(), level, bits, hashes).ravel()
        values = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
        words = (at >> np.uint64(6)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(words), pa.array(values)], ["word", "bits"])

    found = map_batches(keys.select("key"), run, "word long, bits long")
    found = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros((bits + 63) // 64, np.uint64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bloom(level, bits, hashes, words)


def held_by(keys: DataFrame, bloom: Bloom) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(bloom)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(sent.value.holds(batch.column(0).to_pylist()), pa.bool_()))

    return map_batches(keys.select("key"), run, "key string")


def build(listed: DataFrame, universe: DataFrame, scratch: Scratch, name: str) -> Cascade:
    """A cascade over ``listed`` (distinct keys), exact for every key of ``universe`` (repeats allowed).

    The first filter's rate is chosen so that about 0.7 unlisted keys pass for each listed one, whatever
    the size of the corpus: all later levels, and what is sent around, are bounded by the list alone.
    """
    own = listed.count()
    if not own:
        return Cascade([])
    others = max(1, universe.count())
    rate = min(0.5, math.sqrt(0.5) * own / others)
    levels = [filter_of(listed, own, 0, rate)]
    passed = held_by(universe, levels[0]).distinct().join(listed, "key", "left_anti")
    inside, wrong = listed, scratch.save(passed, f"{name}-1")
    while n := wrong.count():
        level = len(levels)
        levels.append(filter_of(wrong, n, level, 0.5))
        again = scratch.save(held_by(inside, levels[-1]), f"{name}-{level + 1}")
        inside, wrong = wrong, again
    return Cascade(levels)


# --- URLs -------------------------------------------------------------------------------------

#: Fixed value: host and path of a URL.
SHAPE = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for what has no ``://``; only A to Z are lower-cased."""
    known = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(known, SHAPE, 1), UPPER, LOWER)
    return host, F.regexp_extract(known, SHAPE, 2)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(key, labels, characters, verdict) of rules given as verdict, host and path."""
    rows = [(host + path, host.count(".") + 1, len(path), verdict) for verdict, host, path in rules]
    return spark.createDataFrame(rows, "key string, labels int, characters int, verdict string")


def keys_of(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    cut = [
        F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, characters))
        for labels, characters in shapes
    ]
    return F.array_distinct(F.array(*cut)) if cut else F.array().cast("array<string>")


def first_listed(
    keys: list[list[str]], known: dict[str, Callable[[Sequence[str]], np.ndarray]], default: str
) -> Iterator[tuple[str | None, str]]:
    """The longest listed key of each row and its verdict; of equally long ones that with more host."""
    flat = [key for own in keys for key in own]
    verdicts: dict[str, str] = {}
    for verdict, listed in known.items():
        verdicts.update((key, verdict) for key, hit in zip(flat, listed(flat), strict=True) if hit)
    for own in keys:
        hits = [key for key in own if key in verdicts]
        best = max(hits, key=lambda key: (len(key), len(key.partition("/")[0])), default=None)
        yield best, default if best is None else verdicts[best]


def judge(
    pages: DataFrame, rules: DataFrame, scratch: Scratch, default: str = ALLOW
) -> DataFrame:
    """Host, path, rule and verdict of every page's URL.

    The rule is the longest that fits; without one, the cascades have shown that no key of the URL is
    listed, and the verdict is ``default``. Null URLs have an empty host and path and fit no rule that
    names any. Repeated pages are judged alike, an empty table gives an empty result, and only
    ``page_id`` and ``url`` are read. No rules at all leave every URL with the default.
    """
    found = rules.select("labels", "characters").distinct().limit(MOST_SHAPES + 1).collect()
    if len(found) > MOST_SHAPES:
        raise ValueError("rules of too many shapes")
    shapes = sorted((row.labels, row.characters) for row in found)
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    keyed = split.withColumn("keys", keys_of(F.col("host"), F.col("path"), shapes))
    universe = keyed.select(F.explode("keys").alias("key"))
    cascades = {
        verdict: build(
            rules.filter(F.col("verdict") == verdict).select("key").distinct(),
            universe,
            scratch,
            verdict,
        )
        for verdict in (ALLOW, BLOCK)  # a key in both lists is blocked
    }
    sent = pages.sparkSession.sparkContext.broadcast(cascades)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = {verdict: cascade.listed for verdict, cascade in sent.value.items()}
        answers = list(first_listed(batch.column(3).to_pylist(), known, default))
        return pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array([rule for rule, _ in answers], pa.string()),
                pa.array([verdict for _, verdict in answers], pa.string()),
            ],
            ["page_id", "host", "path", "rule", "verdict"],
        )

    return map_batches(
        keyed, run, "page_id long, host string, path string, rule string, verdict string"
    )
