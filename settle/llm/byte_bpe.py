"""Byte-level BPE by backtracking over longest matches.

The vocabulary's bytes are mapped to Latin-1 so that an Aho-Corasick automaton finds, in one scan of a
piece, the longest token starting at each byte. The encoder takes longest matches from the left and
steps back to shorter ones where two neighbours would have merged otherwise. Whether two tokens may
stand side by side depends on them alone, so the answers are memoised; no position is left twice, so a
piece takes time in proportion to its length, also where it is one word of a megabyte.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from settle.llm.common import map_batches, texts

#: Pieces whose ids a worker remembers (some 50 MB at most), the longest such piece, and pairs of tokens it
#: remembers before it starts afresh (some 30 MB).
REMEMBERED = 1 << 18
REMEMBERED_LENGTH = 64
REMEMBERED_PAIRS = 1 << 18


class Vocabulary:
    """Tokens by rank; the rank is the id. Single bytes must all be present."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.halves: dict[int, tuple[int, int]] = {}
        self.shorter: dict[int, int | None] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()

    @staticmethod
    def read(path: str) -> dict[bytes, int]:
        """The ranks in a file of base64 tokens and their ranks."""
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return {base64.b64decode(token): int(rank) for token, rank in pairs}

    def split(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge made ``token``; of a single byte, the token itself twice."""
        if token not in self.halves:
            self.halves[token] = self._split(token)
        return self.halves[token]

    def _split(self, token: int) -> tuple[int, int]:
        word = self.tokens[token]
        if len(word) == 1:
            return token, token
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 2:
            merged = [self.ranks.get(a + b, token) for a, b in zip(parts, parts[1:], strict=False)]
            at = min(range(len(merged)), key=merged.__getitem__)
            if merged[at] >= token:
                raise ValueError(f"token {token} cannot be reached by merges of lower rank")
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def prefix(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self.shorter:
            word = self.tokens[token]
            found = (self.ranks.get(word[:n]) for n in range(len(word) - 1, 0, -1))
            self.shorter[token] = next((rank for rank in found if rank is not None), None)
        return self.shorter[token]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves ``left`` and ``right`` side by side."""
        known = self.memo.get((left, right))
        if known is None:
            if len(self.memo) >= REMEMBERED_PAIRS:
                self.memo.clear()
            known = self.memo[left, right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo merges from the latest to the earliest at the seam of the two tokens.

        A merge across the seam that comes before the merges undone so far would have been made, and
        the two tokens would not exist.
        """
        ranks, tokens = self.ranks, self.tokens
        before = len(tokens)
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < before and self.split(across) == (left, right):
                return False
            single_left, single_right = len(tokens[left]) == 1, len(tokens[right]) == 1
            if single_left and single_right:
                return True
            # of equal ranks the left one is merged first, so the right one is undone first
            if not single_left and (single_right or left > right):
                before, left = left, self.split(left)[1]
            else:
                before, right = right + 1, self.split(right)[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest: list[int] = [0] * len(piece)
        for end, (length, rank) in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - length] = rank  # ends ascend, so the last one is the longest
        lengths, compatible = self.tokens, self.compatible
        reachable = bytearray(b"\1") * (len(piece) + 1)
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < len(piece):
            last = ids[-1] if ids else None
            while True:
                end = at + len(lengths[token])
                if reachable[end] and (last is None or compatible(last, token)):
                    ids.append(token)
                    at = end
                    token = longest[at] if at < len(piece) else 0
                    break
                shorter = self.prefix(token)
                if shorter is not None:
                    token = shorter
                    continue
                if last is None:
                    raise ValueError("the vocabulary lacks a single byte")
                reachable[at] = 0
                token = ids.pop()
                at -= len(lengths[token])
                shorter = self.prefix(token)
                if shorter is None:
                    reachable[at] = 0
                break
        return ids


class Pieces(dict):
    """Remembers the packed ids of short pieces; the older half is forgotten when the newer one is full."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.older.get(piece)
        if packed is None:
            packed = np.array(self.vocabulary.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary = vocabulary
        self.find = regex.compile(pattern).findall
        self.pieces = Pieces(vocabulary)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; each match of the pattern on its own."""
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4").tolist()
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    """One per worker process."""
    return Codec(Vocabulary(Vocabulary.read(path)), pattern)


def ship(rows: DataFrame, path: str) -> str:
    """Send the vocabulary file with the job, so that executors need no copy of their own."""
    rows.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(rows: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """Each row's id columns with ``ids``, the packed ids of its whole text.

    Null and empty texts have no ids. Rows are independent: repeated rows and ids give repeated rows,
    and an empty table gives an empty one. Of the input only ``doc_id`` is carried along, so further
    columns, also one called ``ids``, cannot clash.
    """
    name = ship(rows, vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode_one = codec(SparkFiles.get(name), pattern).encode
        packed = [encode_one(t) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(packed, pa.binary())], ["doc_id", "ids"]
        )

    return map_batches(rows.select("doc_id", text), run, "doc_id long, ids binary")


def decode(rows: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """The bytes that packed ``ids`` stand for; null ids stand for no bytes."""
    name = ship(rows, vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        decode_one = codec(SparkFiles.get(name), pattern).decode
        decoded = [decode_one(packed or b"") for packed in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(decoded, pa.binary())], ["doc_id", "decoded"]
        )

    return map_batches(rows.select("doc_id", "ids"), run, "doc_id long, decoded binary")


def round_trip(rows: DataFrame, vocabulary: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode each whole text, decode its ids, and return counts and digests of both.

    One pass: ids and bytes of a document exist only while it is worked on.
    """
    name = ship(rows, vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(SparkFiles.get(name), pattern)
        counts, ids, decoded = [], [], []
        for t in texts(batch.column(1)):
            packed = own.encode(t)
            counts.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(own.decode(packed)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(ids, pa.string()),
                pa.array(decoded, pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_batches(
        rows.select("doc_id", text),
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
