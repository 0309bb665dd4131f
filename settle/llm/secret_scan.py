"""Secrets: fixed shapes, and random strings that a tokenizer can hardly compress.

Ordinary words take few tokens, as the vocabulary was made from text; a random string falls apart into
pieces of one or two characters. A run of key characters whose characters per token stay below a bound
is reported as ``random``, unless it is a digest of a known length, a UUID or a number, or overlaps what
the fixed shapes have found. Letters joined by signs are tested without the signs and numbers between
them, and in lower case too, so that identifiers pass by the words they are made of, not by their shape.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from settle.llm.byte_bpe import Vocabulary, ship
from settle.llm.common import map_batches, texts

Span = tuple[int, int, str]

#: The shapes, their names in the order of reporting, and the least lengths.
KINDS = ("assign", "access", "hex", "random")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: A run of key characters, and what in such runs is known not to be a secret.
LEAST_RUN = 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})
DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
SIGNS = re.compile(r"[+/_=-]+")
PLAIN = re.compile(r"[A-Z]?[a-z]*|[A-Z]*|[0-9]*")
#: Letters that a run of letters and numbers needs to be judged by them where each part is one token.
LEAST_LETTERS = 8


def fixed_shapes(text: str, long_word: bool) -> list[Span]:
    """Spans of the fixed shapes. ``long_word``: some word of the text has ``LEAST_RUN`` characters."""
    spans: list[Span] = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_VALUE:
                spans.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST_ACCESS:
                spans.append((m.start(), m.end(), "access"))
    if long_word:
        spans.extend((m.start(), m.end(), "hex") for m in HEX.finditer(text))
    return spans


def known(run: str) -> bool:
    """Digests of a known length, UUIDs, and numbers joined by signs, as dates are."""
    if len(run) in DIGEST_LENGTHS and DIGEST.fullmatch(run):
        return True
    return bool(UUID.fullmatch(run)) or not any(map(str.isalpha, run))


def falls_apart(run: str, tokens_of: Callable[[str], int], ratio: float) -> bool:
    """Whether a run has fewer than ``ratio`` characters a token.

    Where its parts are all letters or all digits, the letters decide, in the case that takes fewer
    tokens; in several parts, as many as ``ratio`` are too few. Parts of one letter repeated pass.
    """
    every = SIGNS.split(run)
    if not all(map(PLAIN.fullmatch, every)):
        return len(run) < ratio * tokens_of(run)
    parts = [part for part in every if part.isalpha()]
    letters = sum(map(len, parts))
    needed = [tokens_of(part) for part in parts]
    tokens = min(sum(needed), sum(tokens_of(part.lower()) for part in parts))
    if all(len(set(part)) == 1 for part in parts) or (letters < LEAST_LETTERS and max(needed) == 1):
        return False
    several = sum(map(bool, every)) > 1
    return letters < ratio * tokens or (several and letters == ratio * tokens)


def random_strings(
    text: str, taken: list[Span], tokens_of: Callable[[str], int], ratio: float
) -> list[Span]:
    found: list[Span] = []
    for m in RUN.finditer(text):
        start, end, run = m.start(), m.end(), m.group()
        if known(run) or any(start < e and s < end for s, e, _ in taken):
            continue
        if falls_apart(run, tokens_of, ratio):
            found.append((start, end, "random"))
    return found


def scan(text: str, tokens_of: Callable[[str], int], ratio: float) -> tuple[list[Span], list[Span]]:
    """The spans of the fixed shapes and those of random strings, each by start, then kind."""
    long_word = max(map(len, text.split()), default=0) >= LEAST_RUN
    base = fixed_shapes(text, long_word)
    added = random_strings(text, base, tokens_of, ratio) if long_word else []
    order = {kind: i for i, kind in enumerate(KINDS)}
    base.sort(key=lambda s: (s[0], order[s[2]]))
    return base, sorted([*base, *added], key=lambda s: (s[0], order[s[2]]))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> Callable[[str], int]:
    """Number of tokens of a string; one encoder per worker process."""
    encoder = tiktoken.Encoding(
        "secrets",
        pat_str=pattern,
        mergeable_ranks=Vocabulary.read(path),
        special_tokens={},
    )
    return lambda run: len(encoder.encode_ordinary(run))


def find_secrets(
    rows: DataFrame, vocabulary: str, pattern: str, ratio: float = 2.0, text: str = "text"
) -> DataFrame:
    """Spans of each whole text (code points, end exclusive) with counts and a digest of the base ones.

    Null and empty texts have no spans: counts of zero, the digest of nothing, an empty string. Rows
    are independent, so repeated rows give repeated rows and an empty table an empty one; only
    ``doc_id`` and the text are read, so other columns cannot clash.
    """
    name = ship(rows, vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens_of = counter(SparkFiles.get(name), pattern)
        counts: dict[str, list[int]] = {kind: [] for kind in KINDS[:3]}
        digests, spans = [], []
        for t in texts(batch.column(1)):
            base, every = scan(t, tokens_of, ratio)
            for kind, column in counts.items():
                column.append(sum(s[2] == kind for s in base))
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            spans.append(listed(every))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                *(pa.array(column, pa.int64()) for column in counts.values()),
                pa.array(digests, pa.string()),
                pa.array(spans, pa.string()),
            ],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )

    return map_batches(
        rows.select("doc_id", text),
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
