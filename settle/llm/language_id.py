"""Language identification by rank order.

A language's profile is the list of its most frequent n-grams of one to three letters, by rank. A
document is given the language whose profile its own list is least out of place with: for each of the
document's n-grams the difference of the two ranks, or the length of the profile if it is not there.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from settle.llm.common import crc_of_id, map_batches, slices

#: N-grams of a profile, and the length of the longest.
RANKS = 400
LONGEST = 3
BITS = 21  # of a code point
#: Languages whose profiles are sent to the executors at most.
MOST_LANGUAGES = 10_000
#: Counts a task keeps before it hands them on.
KEPT_COUNTS = 1 << 21
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams within the words of a text, a word's edges counting as a sign.

    Words are runs of letters, in lower case. Empty if the text has no letter.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    known = letters()[codes] if len(codes) else np.zeros(0, bool)
    if not known.any():
        return np.zeros(0, np.int64)
    signs = np.where(known, codes.astype(np.int64) + 1, 1)  # 1: an edge
    signs = np.concatenate([[1], signs, [1]])
    keep = np.ones(len(signs), bool)
    keep[1:] = (signs[1:] != 1) | (signs[:-1] != 1)
    signs = signs[keep]
    edge = signs == 1
    pairs = signs[:-1] << BITS | signs[1:]
    triples = pairs[:-1] << BITS | signs[2:]
    return np.concatenate([signs[~edge], pairs, triples[~edge[1:-1]]])


def tally(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    codes = np.sort(codes)
    edges = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1], [True]]))
    return codes[edges[:-1]], np.diff(edges)


def ranked(codes: np.ndarray) -> np.ndarray:
    """The most frequent codes, the smaller code first among equals."""
    distinct, times = tally(codes)
    return distinct[np.lexsort((distinct, -times))[:RANKS]]


def profiles(rows: DataFrame) -> DataFrame:
    """(lang, gram, rank) from the whole texts of the rows that have a language.

    Each task adds up its n-grams before they are shuffled by language and n-gram; a top-k window keeps
    the first ranks of each shuffled part, so that no language is gathered in one place.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (codes, times) in kept.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(times)],
                    ["lang", "gram", "n"],
                )
            kept.clear()

        for batch in batches:
            for part in slices(batch):
                found: dict[str, list[np.ndarray]] = {}
                both = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                for lang, text in both:
                    found.setdefault(lang, []).append(grams(text))
                for lang, parts in found.items():
                    codes, times = tally(np.concatenate(parts))
                    if lang in kept:
                        codes = np.concatenate([kept[lang][0], codes])
                        times = np.concatenate([kept[lang][1], times])
                        codes, at = np.unique(codes, return_inverse=True)
                        times = np.bincount(at, times).astype(np.int64)
                    kept[lang] = codes, times
                if sum(len(codes) for codes, _ in kept.values()) > KEPT_COUNTS:
                    yield from out()
        yield from out()

    usable = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = usable.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.withColumn("rank", F.row_number().over(by_count)).filter(
        F.col("rank") <= RANKS
    ).select("lang", "gram", "rank")


class Profiles:
    """All profiles as one sorted list of n-grams and the rank of each in each language."""

    def __init__(self, langs: list[str], grams_: np.ndarray, ranks: np.ndarray) -> None:
        self.langs = sorted(set(langs))
        column = {lang: i for i, lang in enumerate(self.langs)}
        self.grams, at = np.unique(grams_.astype(np.int64), return_inverse=True)
        # the last line, all out of place, stands for n-grams of no profile
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        self.ranks[at, [column[lang] for lang in langs]] = ranks

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = grams(text or "")
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        own = ranked(codes)
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        at[self.grams[at] != own] = len(self.grams)
        ranks = self.ranks[at]
        place = np.arange(1, len(own) + 1)[:, None]
        apart = np.where(ranks < 0, RANKS, np.abs(ranks - place)).sum(axis=0)
        best = int(apart.argmin())  # of equals the first by name
        return self.langs[best], float(1 - apart[best] / (RANKS * len(own)))


def fit(rows: DataFrame) -> Profiles:
    """Profiles of every language among ``rows``; a few hundred lines a language reach the driver."""
    if rows.select("lang").distinct().count() > MOST_LANGUAGES:
        raise ValueError("more languages than profiles can be sent for")
    lines = profiles(rows).toArrow()
    return Profiles(
        lines.column("lang").to_pylist(),
        lines.column("gram").to_numpy(),
        lines.column("rank").to_numpy(),
    )


def held_out(doc_id: str = "doc_id") -> Column:
    """A third of the documents, never learnt from."""
    return F.coalesce(crc_of_id(doc_id) % 3 == 1, F.lit(False))


def predict(rows: DataFrame, known: Profiles) -> DataFrame:
    """Language and score of each whole text.

    Null texts and texts without a letter get ``und`` and a score of zero, as does every text if
    nothing was learnt. A tie goes to the first language by name. Repeated rows are predicted alike;
    only ``doc_id`` and ``text`` are read.
    """
    sent = rows.sparkSession.sparkContext.broadcast(known)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sent.value.predict(text) for text in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ],
            ["doc_id", "held_out", "lang_pred", "score"],
        )

    return map_batches(
        rows.select("doc_id", held_out().alias("held_out"), "text"),
        run,
        "doc_id long, held_out boolean, lang_pred string, score double",
    )


def identify(rows: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, and predict every one."""
    return predict(rows, fit(rows.filter(~held_out())))
