from __future__ import annotations

import random

import pytest

from settle.llm.common import Scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def scratch(spark):
    own = Scratch(spark)
    yield own
    own.drop()


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (doc_id, text) and (doc_id, text, lang, source)."""

    def build(rows):
        full = []
        for i, row in enumerate(rows):
            row = (i, row) if isinstance(row, str) or row is None else tuple(row)
            doc_id, text, lang, source = (*row, "en", "src")[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, SCHEMA)

    return build


WORDS = "the of and quick brown fox jumps over lazy dogs while seven wizards brew potions daily".split()


@pytest.fixture
def prose():
    def write(seed: int, n: int) -> str:
        own = random.Random(seed)
        return " ".join(own.choice(WORDS) + str(own.randrange(20)) for _ in range(n))

    return write


#: Texts that every operator must survive.
ODD = [None, "", " \t\n", "x", "é" * 300, "long " * 30_000, "a" * 100_000, "\x00\x1c\x85 ",
       "same text here", "same text here", "😀 emoji 中文 text", "ſ K İ"]


def odd_rows():
    rows = [(i, text, "en" if i % 3 else None, None if i % 4 == 0 else "src") for i, text in enumerate(ODD)]
    return [*rows, rows[8], (None, "same text here", "en", "src"), (None, None, None, None)]


def clashing(frame):
    """The same rows with further columns named like those the operators make."""
    from pyspark.sql import functions as F

    extra = ("ids key value n point node kept pass block part rest group sha tokens row id lang_pred "
             "spans first end words host path rule page label component_id").split()  # fmt: skip
    return frame.withColumns({name: F.lit("clash") for name in extra if name not in frame.columns})
