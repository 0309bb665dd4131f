"""Token ids in files that can be read one document at a time.

A file is a row of independent zstandard frames, one a document, in ascending order of document id. The
last frame but the seek table is the directory: the ids of the documents. The file ends with a seek
table in the public seekable format: for each frame its compressed size, its size, and the low 32 bits
of the xxHash64 of its content. A reader fetches the table, then only the frames it was asked for.

Every task writes files of its own under names of its own, and names them in a manifest that Spark
commits: files of a lost or repeated attempt are in no manifest and are never read.
"""

from __future__ import annotations

import struct
import uuid
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import BinaryIO

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from settle.llm.byte_bpe import ship
from settle.llm.common import Scratch, slices, texts

#: Fixed values of the seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
WITH_CHECKSUMS = 0x80
ENTRY, FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
LARGEST = (1 << 32) - 1

#: Bytes of ids after which a task starts another file, and the level of compression.
FILE_BYTES = 256 << 20
LEVEL = 3


# --- one file ---------------------------------------------------------------------------------


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI, also of Hadoop's short form ``file:/path``."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class TokenFile:
    """Writes one file; documents come in ascending order, their ids packed as ``<u4``."""

    def __init__(self, out: BinaryIO, level: int = LEVEL) -> None:
        self.out = out
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.table = bytearray()
        self.documents: list[int | None] = []
        self.bytes = 0

    def add(self, doc_id: int | None, packed: bytes) -> None:
        self.documents.append(doc_id)
        self.bytes += len(packed)
        self._frame(packed)

    def _frame(self, content: bytes) -> None:
        if len(content) > LARGEST:
            raise ValueError("a frame holds 4 GB at most")
        frame = self.compress(content)
        checksum = xxhash.xxh64_intdigest(content) & LARGEST
        self.table += ENTRY.pack(len(frame), len(content), checksum)
        self.out.write(frame)

    def close(self) -> None:
        known = bytes(doc_id is not None for doc_id in self.documents)
        self._frame(array("q", [doc_id or 0 for doc_id in self.documents]).tobytes() + known)
        footer = FOOTER.pack(len(self.table) // ENTRY.size, WITH_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(self.table) + len(footer)))
        self.out.write(bytes(self.table) + footer)


class TokenReader:
    """Random access to the documents of one file."""

    def __init__(self, source: BinaryIO, size: int) -> None:
        self.source = source
        source.seek(size - FOOTER.size)
        frames, flags, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != SEEKABLE or flags != WITH_CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        source.seek(size - FOOTER.size - frames * ENTRY.size)
        self.entries = list(ENTRY.iter_unpack(source.read(frames * ENTRY.size)))
        self.starts = [0]
        for compressed, _, _ in self.entries:
            self.starts.append(self.starts[-1] + compressed)
        self.decompress = zstandard.ZstdDecompressor().decompress
        directory = self.frame(frames - 1)
        n = frames - 1
        ids, known = array("q", directory[: 8 * n]), directory[8 * n :]
        self.documents = [doc_id if there else None for doc_id, there in zip(ids, known, strict=True)]

    def frame(self, number: int) -> bytes:
        compressed, size, checksum = self.entries[number]
        self.source.seek(self.starts[number])
        content = self.decompress(self.source.read(compressed), max_output_size=size)
        if len(content) != size or xxhash.xxh64_intdigest(content) & LARGEST != checksum:
            raise ValueError(f"frame {number} is damaged")
        return content

    def lengths(self) -> list[int]:
        """Ids of each document, without reading any."""
        return [size // 4 for _, size, _ in self.entries[:-1]]


# --- encoding ---------------------------------------------------------------------------------

#: Words whose ids a worker remembers before it starts afresh, and the longest such word.
REMEMBERED = 1 << 20
REMEMBERED_LENGTH = 64
#: Signs after which, at the end of a word, the tokenizer surely cuts.
TRAILING = ".,;:!?|"
LAST_LATIN = "ſ"


@lru_cache(maxsize=1)
def byte_signs() -> dict[int, str]:
    """The sign that byte-level vocabularies write each byte as: itself if it prints."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Words(dict):
    """Packed ids of words. The tokenizer drops white space and lower-cases, so a text is its words."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.tokenizer.model

    def __missing__(self, word: str) -> bytes:
        body = word.rstrip(TRAILING)
        if body and len(body) < len(word) and body[-1].lower().isalpha():
            packed = self[body] + self[word[len(body) :]]
        elif self.plain(word):  # one piece, and case is all there is to normalise
            lower = word.lower()
            packed = self[lower] if lower != word else self.piece(word)
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            packed = array("I", ids).tobytes()
        if len(word) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = packed
        return packed

    @staticmethod
    def plain(word: str) -> bool:
        """Only letters of Latin alphabets, also in lower case."""
        return word.isalpha() and (
            word.isascii() or (max(word) <= LAST_LATIN and word.lower().isalpha())
        )

    def piece(self, word: str) -> bytes:
        signs = word if word.isascii() else "".join(map(byte_signs().__getitem__, word.encode()))
        return array("I", [token.id for token in self.model.tokenize(signs)]).tobytes()

    def encode(self, text: str) -> bytes:
        """As the tokenizer encodes the whole text. Cut only at white space, where it cuts as well."""
        return b"".join(map(self.__getitem__, text.split(" ")))


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """One per worker process."""
    return Words(path)


# --- the corpus -------------------------------------------------------------------------------

MANIFEST = "partition int, number int, path string, n_docs long, n_ids long"


def write(
    rows: DataFrame,
    scratch: Scratch,
    folder: str,
    tokenizer: str,
    end_id: int,
    text: str = "text",
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write every whole text as token files below ``folder``, a URI all executors reach.

    Returns the manifest: one row a file, in the order of the corpus by partition and number. Null
    texts are empty and hold just the end id. Null document ids come first and stay null, repeated ids
    stay next to each other, and an empty table has an empty manifest. Only ``doc_id`` and the text are
    read.
    """
    name = ship(rows, tokenizer)
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = words(SparkFiles.get(name)).encode
        system, base = opened(folder)
        partition, number = TaskContext.get().partitionId(), 0
        documents = (
            pair
            for batch in batches
            for part in slices(batch)
            for pair in zip(part.column(0).to_pylist(), texts(part.column(1)), strict=True)
        )
        pair = next(documents, None)
        while pair is not None:
            path = f"{partition:06d}-{number:04d}-{uuid.uuid4().hex}.zst"
            with system.open_output_stream(f"{base}/{path}", compression=None) as out:
                own = TokenFile(out)
                while pair is not None and own.bytes < file_bytes:
                    own.add(pair[0], encode(pair[1]) + end)
                    pair = next(documents, None)
                own.close()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "partition": partition,
                        "number": number,
                        "path": f"{folder}/{path}",
                        "n_docs": len(own.documents),
                        "n_ids": own.bytes // 4,
                    }
                ],
                schema=pa.schema(
                    [
                        ("partition", pa.int32()),
                        ("number", pa.int32()),
                        ("path", pa.string()),
                        ("n_docs", pa.int64()),
                        ("n_ids", pa.int64()),
                    ]
                ),
            )
            number += 1

    system, base = opened(folder)
    system.create_dir(base, recursive=True)
    ordered = rows.select("doc_id", text).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return scratch.save(ordered.mapInArrow(run, MANIFEST), "manifest")


def placed(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the number of ids in all files before.

    Totals of partitions, one number each, are added up on the driver; files within their partition.
    """
    totals = manifest.groupBy("partition").agg(F.sum("n_ids").alias("n")).orderBy("partition")
    before, base = [], 0
    for row in totals.collect():
        before.append((row.partition, base))
        base += row.n
    spark = manifest.sparkSession
    bases = spark.createDataFrame(before, "partition int, base long")
    earlier = Window.partitionBy("partition").orderBy("number").rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))
    return manifest.join(bases, "partition").select(
        "path", (F.col("base") + within).alias("start"), "n_docs", "n_ids"
    )


def read(files: DataFrame, wanted: frozenset[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) of the documents in placed files, or of the ``wanted`` ids only.

    ``start`` counts the ids of all documents before. Of documents that are not wanted, only the
    directory and the seek table are read. Each file is read by one task, one frame at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True):
                system, name = opened(path)
                with system.open_input_file(name) as source:
                    yield from documents(TokenReader(source, source.size()), start)

    def documents(reader: TokenReader, start: int) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int | None, int, bytes]] = []
        held = 0
        for number, n in enumerate(reader.lengths()):
            doc_id = reader.documents[number]
            if wanted is None or doc_id in wanted:
                found.append((doc_id, start, reader.frame(number)))
                held += 4 * n
            start += n
            if held > 4 << 20:
                yield batch_of(found)
                found, held = [], 0
        yield batch_of(found)

    def batch_of(found: list[tuple[int | None, int, bytes]]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
            ["doc_id", "start", "ids"],
        )

    # as many partitions as files, by number: a manifest is too small for Spark to split by itself
    spread = files.select("path", "start").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def counted(documents: DataFrame) -> DataFrame:
    """Length and checksum of the ids that were read back."""
    return documents.select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
