"""Quality rules: counts of a text, and the perplexity of its characters.

The language model is a modified Kneser-Ney model of three code points, one for each language, exactly as the
texts have them. Spark counts the n-grams of the whole corpus, in how many contexts the shorter ones occur, and
how often each context is followed by something seen once, twice or more. The counts are stored as sorted hash
arrays in the shared folder, a folder for each language and order, and whoever scores texts of a language reads
those of that language: whole where they are small, else piece by piece, so no size of corpus is too large.

A text is scored by the counts of all others: what it has brought itself is taken out of every count, also
of the contexts of shorter n-grams. Documents whose mean surprise is outside the band of their language are
rejected. Copies of a text, which differ in white space at most, weigh as one text in counts and band.
"""

from __future__ import annotations

from collections import Counter, OrderedDict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.bit_fields import field_of, in_field
from settle.llm.common import Scratch, map_batches, slices, texts, utf8
from settle.llm.exact_dedup import normalised
from settle.llm.token_files import opened

#: Fixed values of the rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # in a hundred words

#: Code points of an n-gram, the bits of one, and the probability of any of them where nothing is known.
ORDER = 3
BITS = 21
POINT = (1 << BITS) - 1
FLOOR = 1 / 0x110000
#: Counts a task keeps before it hands them on, and bytes of models that a worker keeps.
KEPT_COUNTS = 1 << 21
KEPT_BYTES = 64 << 20
#: Bits of the field of hashes that several texts have.
COPIED_BITS = 26


# --- counts of a text -------------------------------------------------------------------------


def repeated_words(ids: np.ndarray) -> int:
    """Positions in a window of three words that the text has twice or more."""
    n = len(ids) - 2
    if n < 2:
        return 0
    _, pairs = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)
    _, which, times = np.unique(
        pairs[:-1] * (int(ids.max()) + 1) + ids[2:], return_inverse=True, return_counts=True
    )
    often = times[which] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : shift + n] |= often
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = Counter(text.split(b"\n"))
    return sum(times - 1 for line, times in lines.items() if times > 1 and line.split())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines and repeated words of a UTF-8 text."""
    words = text.split()  # of bytes: at ASCII white space, which is that of the contract
    first: dict[bytes, int] = {}
    ids = np.fromiter(map(first.setdefault, words, count()), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8)
    characters = int(np.count_nonzero((raw & 0xC0) != 0x80))
    symbols = sum(map(text.count, (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS)))))
    return len(words), characters, symbols, repeated_lines(text), repeated_words(ids)


# --- n-grams ------------------------------------------------------------------------------------


def grams(text: str) -> np.ndarray:
    """The n-gram that ends at each character, as one number; white space taken together, as in copies."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    white = (points == 32) | ((points >= 9) & (points <= 13))
    points[white] = 32
    keep = ~white
    keep[:1] = True
    keep[1:] |= ~white[:-1]
    padded = np.concatenate([np.zeros(ORDER - 1, np.int64), points[keep]])
    n = len(padded) - ORDER + 1
    codes = padded[:n]
    for k in range(1, ORDER):
        codes = codes << BITS | padded[k : k + n]
    return codes


def tally(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order, and how often each occurs."""
    codes = np.sort(codes)
    edges = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1], [True]]))
    return codes[edges[:-1]], np.diff(edges)


# --- copies -----------------------------------------------------------------------------------


def text_key():
    """Hash of a text as copies have it; copies have equal n-grams and equal base verdicts."""
    return F.xxhash64(normalised(F.col("text"))).alias("text_key")


def distinct_texts(rows: DataFrame, field: Broadcast | None) -> tuple[DataFrame, DataFrame]:
    """(lang, text, text_key) of all texts, and (lang, text) once of each that ``field`` holds.

    Only texts whose hash occurs twice in a language go through a shuffle, where a digest decides; a task
    sends one row for the copies it has. Of the first table those texts are to be left out.
    """
    keyed = rows.filter(F.length("text") > 0).select("lang", "text", text_key())
    if field is None:
        return keyed, keyed.select("lang", "text").limit(0)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = in_field(field.value, batch.column(2).to_numpy().view(np.uint64))
        return batch.filter(pa.array(found)).select(["lang", "text"])

    suspects = map_batches(keyed, run, "lang string, text string")
    digest = F.sha2(normalised(F.col("text")), 256).alias("digest")
    once = suspects.groupBy("lang", digest).agg(F.first("text").alias("text"))
    return keyed, once.select("lang", "text")


def copied_field(rows: DataFrame) -> np.ndarray:
    """The hashes of texts that several rows of a language have."""
    keyed = rows.filter(F.length("text") > 0).select("lang", text_key())
    often = keyed.groupBy("lang", "text_key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    return field_of(often.select(F.col("text_key").alias("value")), COPIED_BITS)


# --- the model in Spark -----------------------------------------------------------------------


def lang_key():
    """A name for a folder: the hash of the language; rows without one are a language of their own."""
    known = F.concat(F.lit("k"), F.hex(F.xxhash64("lang")))
    return F.coalesce(known, F.lit("none")).alias("lang_key")


def count_grams(rows: DataFrame, copied: Broadcast | None = None) -> DataFrame:
    """(lang_key, gram, n) over every text; each task adds up before anything is shuffled.

    Of rows with a ``text_key`` those that ``copied`` holds are left out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, (codes, times) in kept.items():
                langs = pa.array([lang] * len(codes), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array(codes), pa.array(times)], ["lang_key", "gram", "n"]
                )
            kept.clear()

        for batch in batches:
            if copied is not None:
                found = in_field(copied.value, batch.column(2).to_numpy().view(np.uint64))
                batch = batch.filter(pa.array(~found))
            for part in slices(batch):
                found: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(part.column(0).to_pylist(), texts(part.column(1)), strict=True):
                    if text:
                        found.setdefault(lang, []).append(grams(text))
                for lang, codes in found.items():
                    kept[lang] = added(kept.get(lang), *tally(np.concatenate(codes)))
                if sum(len(codes) for codes, _ in kept.values()) > KEPT_COUNTS:
                    yield from out()
        yield from out()

    wanted = ["text"] if copied is None else ["text", "text_key"]
    counted = rows.select(lang_key(), *wanted).mapInArrow(run, "lang_key string, gram long, n long")
    return counted.groupBy("lang_key", "gram").agg(F.sum("n").alias("n"))


def added(kept, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if kept is None:
        return codes, times
    both, at = np.unique(np.concatenate([kept[0], codes]), return_inverse=True)
    return both, np.bincount(at, np.concatenate([kept[1], times])).astype(np.int64)


def corpus_grams(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The saved counts of all distinct texts of each language."""
    field = copied_field(rows)
    if not field.any():
        keyed, _ = distinct_texts(rows, None)
        return scratch.save(count_grams(keyed.drop("text_key")), "grams")
    copied = rows.sparkSession.sparkContext.broadcast(field)
    keyed, once = distinct_texts(rows, copied)
    both = count_grams(keyed, copied).unionByName(count_grams(scratch.save(once, "copied")))
    counted = scratch.save(
        both.groupBy("lang_key", "gram").agg(F.sum("n").alias("n")), "grams"
    )
    copied.destroy()
    return counted


GRAMS, CONTEXTS, COUNTS = 0, 1, 2
VALUES = ("a", "n1", "n2", "n3")


def store(counted: DataFrame, scratch: Scratch) -> str:
    """Write the model as sorted hash arrays, a folder for each language, order and kind; returns its path.

    Kinds are n-grams (``a`` is the count), contexts (``a`` is the total after them, the others how many
    n-grams are seen there once, twice and more), and one line of counts of counts, of one to four.
    Below the highest order counts are of distinct longer n-grams, as Kneser and Ney have them.
    """
    levels = {ORDER: counted}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (order * BITS)) - 1))
        fewer = levels[order + 1].groupBy("lang_key", shorter.alias("gram"))
        levels[order] = scratch.save(fewer.agg(F.count("*").alias("n")), f"grams-{order}")
    none = F.lit(0).cast("long")
    often = [F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]
    after = [F.sum("n"), *often[:2], F.count_if(F.col("n") >= 3)]
    parts = []
    for order, found in levels.items():
        context = F.shiftright("gram", BITS)
        kinds = (
            (GRAMS, found.select("lang_key", "gram", F.col("n").alias("a"), *(none.alias(c) for c in VALUES[1:]))),
            (CONTEXTS, found.groupBy("lang_key", context.alias("gram")).agg(
                *(c.alias(n) for c, n in zip(after, VALUES, strict=True)))),
            (COUNTS, found.groupBy("lang_key", none.alias("gram")).agg(
                *(c.alias(n) for c, n in zip(often, VALUES, strict=True)))),
        )
        for kind, rows in kinds:
            parts.append(rows.withColumns({"level": F.lit(order), "kind": F.lit(kind)}))
    entries = parts[0]
    for part in parts[1:]:
        entries = entries.unionByName(part)
    folder = ["lang_key", "level", "kind"]
    entries = entries.select(*folder, F.xxhash64("gram").alias("hash"), "gram", *VALUES)
    by_hash = entries.repartitionByRange(*folder, "hash").sortWithinPartitions(*folder, "hash")
    path = f"{scratch.path}/model"
    by_hash.write.partitionBy(*folder).parquet(path)
    return path


# --- the model in a task ------------------------------------------------------------------------


class Stored:
    """Reads the arrays of one language; keeps small ones, reads large ones again piece by piece."""

    kept: OrderedDict[tuple, tuple[np.ndarray, np.ndarray]] = OrderedDict()

    def __init__(self, path: str, lang: str) -> None:
        self.path, self.lang = path, lang

    def pieces(self, level: int, kind: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        system, base = opened(f"{self.path}/lang_key={self.lang}/level={level}/kind={kind}")
        columns = ["gram", *(VALUES[:1] if kind == GRAMS else VALUES)]
        for batch in ds.dataset(base, filesystem=system, format="parquet").to_batches(
            columns=columns, batch_size=1 << 18, batch_readahead=1, fragment_readahead=1
        ):
            if batch.num_rows:
                keys = batch.column(0).to_numpy()
                order = np.argsort(keys)
                values = np.column_stack([c.to_numpy() for c in batch.columns[1:]])
                yield keys[order], values[order]

    def get(self, level: int, kind: int, wanted: np.ndarray) -> np.ndarray:
        """The values of each wanted n-gram, a row each; of unknown ones zeros."""
        key = (self.path, self.lang, level, kind)
        out = np.zeros((len(wanted), 1 if kind == GRAMS else len(VALUES)), np.int64)
        if key in self.kept:
            self.kept.move_to_end(key)
            self._fill(out, wanted, *self.kept[key])
            return out
        held, size = [], 0
        for piece in self.pieces(level, kind):
            self._fill(out, wanted, *piece)
            size += sum(part.nbytes for part in piece)
            if size <= KEPT_BYTES // 2:
                held.append(piece)
        if held and size <= KEPT_BYTES // 2:
            keys = np.concatenate([keys for keys, _ in held])
            order = np.argsort(keys)
            self.kept[key] = keys[order], np.concatenate([values for _, values in held])[order]
            while sum(p.nbytes for parts in self.kept.values() for p in parts) > KEPT_BYTES:
                self.kept.popitem(last=False)
        return out

    @staticmethod
    def _fill(out: np.ndarray, wanted: np.ndarray, keys: np.ndarray, values: np.ndarray) -> None:
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        out[hit] = values[at[hit]]


def discounts(counts_of_counts: Iterable[float]) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of none, one, two, and three or more.

    Where counts of counts are too few to estimate them, as in tiny corpora, one half stands in.
    """
    n = [float(c) for c in counts_of_counts]
    if min(n) == 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found, strict=True))])


def starts_of(*columns: np.ndarray) -> np.ndarray:
    """First places of the stretches of equal rows."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def surprises(model: Stored, whole: list[str]) -> np.ndarray:
    """Mean surprise of each text's characters by the counts of all other texts; zero for empty ones.

    For each order, from the highest down: the text's own share is taken out of the counts, and n-grams
    that are gone then are taken out of the counts of the next order. Probabilities are put together from
    the lowest order up: p = (count - discount + freed * p of the shorter one) / total of the context.
    """
    found = [tally(grams(text)) for text in whole]
    doc = np.repeat(np.arange(len(found)), [len(codes) for codes, _ in found])
    code = np.concatenate([*(codes for codes, _ in found), np.zeros(0, np.int64)])
    times = np.concatenate([*(n for _, n in found), np.zeros(0, np.int64)])
    if not len(code):
        return np.zeros(len(whole))
    steps = []  # from the highest order down: share, freed over total, and places one order below
    own_doc, own_code, taken = doc, code, times
    for order in range(ORDER, 0, -1):
        distinct, at = np.unique(own_code, return_inverse=True)
        before = model.get(order, GRAMS, distinct)[at, 0]
        left = before - taken
        discount = discounts(model.get(order, COUNTS, np.zeros(1, np.int64))[0])
        context = own_code >> BITS
        starts = starts_of(own_doc, context)
        names, name_at = np.unique(context[starts], return_inverse=True)
        after = model.get(order, CONTEXTS, names)[name_at].astype(float)
        after[:, 0] -= np.add.reduceat(taken, starts)
        old, new = np.minimum(before, 3), np.minimum(left, 3)
        for k in (1, 2, 3):
            after[:, k] += np.add.reduceat((new == k).astype(np.int64) - (old == k), starts)
        group = np.repeat(np.arange(len(starts)), np.diff([*starts, len(own_code)]))
        total, freed = after[group, 0], (after[:, 1:] @ discount[1:])[group]
        known = total > 0
        safe = np.where(known, total, 1)
        share = np.where(known, (left - discount[new]) / safe, 0)
        freed = np.where(known, freed / safe, 1)
        if order == 1:
            steps.append((share, freed, None))
            break
        shorter = own_code & ((1 << ((order - 1) * BITS)) - 1)
        order_by = np.lexsort((shorter, own_doc))
        firsts = starts_of(own_doc[order_by], shorter[order_by])
        place = np.empty(len(own_code), np.int64)
        place[order_by] = np.repeat(np.arange(len(firsts)), np.diff([*firsts, len(own_code)]))
        steps.append((share, freed, place))
        taken = np.add.reduceat((left == 0)[order_by].astype(np.int64), firsts)
        own_doc, own_code = own_doc[order_by][firsts], shorter[order_by][firsts]
    p: np.ndarray | None = None
    for share, freed, place in reversed(steps):
        p = share + freed * (FLOOR if p is None else p[place])
    weights = np.bincount(doc, times, len(whole))
    return np.bincount(doc, -np.log(p) * times, len(whole)) / np.maximum(weights, 1)


# --- the rules --------------------------------------------------------------------------------

JUDGED = (
    "doc_id long, lang_key string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, surprise double, text_key long"
)


def judge(rows: DataFrame, model: str) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, whole = utf8(batch.column(2)), texts(batch.column(2))
        counts = [base_counts(data) for data in raw]
        surprise = np.zeros(len(whole))
        langs = batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs):
            own = [i for i, other in enumerate(langs) if other == lang and whole[i]]
            if own:
                surprise[own] = surprises(Stored(model, lang), [whole[i] for i in own])
        columns = list(zip(*counts, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                *(pa.array(column, pa.int64()) for column in columns),
                pa.array(surprise),
                batch.column(3),
            ],
            ["doc_id", "lang_key", "n_words", "word_chars", "n_symbols", "n_dup_lines",
             "n_repeat_words", "surprise", "text_key"],
        )

    return map_batches(rows.select("doc_id", lang_key(), "text", text_key()), run, JUDGED)


def bands(judged: DataFrame, width: float, least: float) -> DataFrame:
    """Lower and upper bound of the surprise for each language.

    The quartiles of the distinct texts that pass the base rules, each moved outwards by ``width`` times
    their distance, by ``least`` at least. Quartiles are read off a histogram of steps of 1/1000, so no
    language is gathered in one task.
    """
    step = F.floor(F.col("surprise") * 1000).alias("step")
    once = judged.filter(~F.col("base_failed")).select("lang_key", "text_key", "surprise").distinct()
    steps = once.groupBy("lang_key", step).agg(F.count("*").alias("n"))
    quartiles = steps.groupBy("lang_key").agg(
        F.expr("percentile(step, array(0.25, 0.75), n)").alias("q")
    )
    low, high = F.col("q")[0] / 1000, F.col("q")[1] / 1000
    margin = F.greatest((high - low) * width, F.lit(least))
    return quartiles.select("lang_key", (low - margin).alias("lower"), (high + margin).alias("upper"))


def quality(
    rows: DataFrame, scratch: Scratch, width: float = 3.0, least: float = 0.05
) -> DataFrame:
    """Counts, surprise, base verdict and verdict of every document.

    Null texts count as empty: no words, so they fail the base rules. Documents without a language are
    a language of their own. Repeated rows are judged alike, an empty table gives an empty result, and
    only ``doc_id``, ``lang`` and ``text`` are read. ``surprise`` is the logarithm of the perplexity.
    """
    rows = rows.select("doc_id", "lang", "text")
    judged = judge(rows, store(corpus_grams(rows, scratch), scratch))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    judged = scratch.save(judged.withColumn("base_failed", failed), "judged")
    found = bands(judged, width, least).withColumnRenamed("lang_key", "band_key")  # one row a language
    inside = F.col("surprise").between(F.col("lower"), F.col("upper"))
    return (
        judged.join(found, F.col("lang_key") == F.col("band_key"), "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
        .drop("band_key", "lang_key", "text_key")
    )
