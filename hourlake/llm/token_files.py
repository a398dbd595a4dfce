"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds stretches of documents in ascending order of their ids:

    frame … frame | document index (skippable) | seek table (skippable)

Each frame is a zstandard frame of the ids of whole documents as little-endian unsigned 32-bit
integers; a long document has a frame of its own. The document index lists id, number of ids and
frame of each document. The seek table is that of the seekable zstandard format: compressed and
plain size of each frame and the low 32 bits of the xxHash64 of its plain bytes, then the number
of frames, a flag byte and a magic number. A plain zstandard reader skips both and decodes all ids.
A reader that wants some documents reads the two tables and only the frames with them.

Files are written by tasks to the shared folder through ``pyarrow.fs``, under names of their own
for each attempt; those that the stored list of files names are the table, so what a lost executor
left half done is never read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import BinaryIO

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.tables import as_bytes, bounded, new_folder, stored, text_bytes
from hourlake.llm.tokens import encoder_of

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Plain bytes of a frame and of a file; one document more may be in either.
FRAME_BYTES = 1 << 18
FILE_BYTES = 1 << 27
#: Bytes of text for one task.
TASK_BYTES = 1 << 25

# Fixed values of the zstandard formats: frames to skip, seek table frame, its footer.
INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

FILES = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("part", T.LongType(), False),
        T.StructField("number", T.LongType(), False),
        T.StructField("n_tokens", T.LongType(), False),
    ]
)
TOKENS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder's address."""
    uri = re.sub(r"^file:/+", "/", uri)
    if uri.startswith("/"):
        return pyarrow.fs.LocalFileSystem(), uri
    return pyarrow.fs.FileSystem.from_uri(uri)


@dataclass
class Writer:
    """Writes one file."""

    out: BinaryIO
    level: int = 3
    held: list[bytes] = field(default_factory=list)
    held_bytes: int = 0
    written: int = 0
    seeks: list[tuple[int, int, int]] = field(default_factory=list)
    index: list[tuple[int | None, int, int]] = field(default_factory=list)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        if self.held and self.held_bytes + len(ids) > FRAME_BYTES:
            self.flush()
        self.index.append((doc_id, len(ids) // 4, len(self.seeks)))
        self.held.append(ids)
        self.held_bytes += len(ids)
        self.written += len(ids)

    def flush(self) -> None:
        plain = b"".join(self.held)
        frame = zstandard.ZstdCompressor(level=self.level).compress(plain)
        self.out.write(frame)
        self.seeks.append((len(frame), len(plain), checksum(plain)))
        self.held, self.held_bytes = [], 0

    def close(self) -> None:
        if self.held:
            self.flush()
        ids = np.array([0 if d is None else d for d, _, _ in self.index], "<i8")
        known = np.array([d is not None for d, _, _ in self.index], np.uint8)
        sizes = np.array([[n, f] for _, n, f in self.index], "<u8").reshape(-1, 2)
        plain = b"".join(x.tobytes() for x in (ids, known, sizes[:, 0].copy(), sizes[:, 1].copy()))
        index = struct.pack("<Q", len(ids)) + zstandard.ZstdCompressor(level=self.level).compress(plain)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *s) for s in self.seeks)
        table += struct.pack("<IBI", len(self.seeks), CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class Reader:
    """Reads documents of one file, frame by frame."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source = source
        size = source.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a file with a seek table")
        table = self._at(size - 9 - 12 * count - 8, 12 * count + 8)
        if struct.unpack("<II", table[:8]) != (SEEK_MAGIC, 12 * count + 9):
            raise ValueError("broken seek table")
        self.seeks = np.frombuffer(table[8:], "<u4").reshape(-1, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.seeks[:, 0])])
        end = size - 9 - 12 * count - 8
        begin = int(self.places[-1])
        index = self._at(begin, end - begin)
        magic, length, n = struct.unpack("<IIQ", index[:16])
        if magic != INDEX_MAGIC or length != len(index) - 8:
            raise ValueError("broken document index")
        plain = zstandard.ZstdDecompressor().decompress(index[16:], max_output_size=25 * n)
        self.ids = np.frombuffer(plain, "<i8", n)
        self.known = np.frombuffer(plain, np.uint8, n, 8 * n).astype(bool)
        self.sizes = np.frombuffer(plain, "<u8", n, 9 * n).astype(np.int64)
        self.frames = np.frombuffer(plain, "<u8", n, 17 * n).astype(np.int64)
        #: Frames that were decompressed, for tests.
        self.opened: list[int] = []

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def frame(self, number: int) -> bytes:
        packed, plain_size, check = (int(x) for x in self.seeks[number])
        data = self._at(int(self.places[number]), packed)
        plain = zstandard.ZstdDecompressor().decompress(data, max_output_size=plain_size)
        if checksum(plain) != check:
            raise ValueError(f"wrong checksum of frame {number}")
        self.opened.append(number)
        return plain

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc_id, start in the file, ids) of all documents, or of those with a wanted id."""
        starts = np.concatenate([[0], np.cumsum(self.sizes)])
        chosen = np.ones(len(self.ids), bool)
        if wanted is not None:
            chosen = self.known & np.isin(self.ids, list(wanted))
        firsts = np.searchsorted(self.frames, np.arange(len(self.seeks)))
        last, plain = -1, b""
        for i in np.flatnonzero(chosen):
            number = int(self.frames[i])
            if number != last:
                last, plain = number, self.frame(number)
            at = 4 * int(starts[i] - starts[firsts[number]])
            doc_id = int(self.ids[i]) if self.known[i] else None
            yield doc_id, int(starts[i]), plain[at : at + 4 * int(self.sizes[i])]


def _write_task(folder: str, path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, spaced=False)
        end = np.array([END_ID], "<u4").tobytes()
        files, place = open_folder(folder)
        files.create_dir(place, recursive=True)
        part, number = TaskContext.get().partitionId(), 0
        writer: Writer | None = None
        name = ""

        def finished() -> pa.RecordBatch:
            writer.close()
            writer.out.close()
            row = [name], [part], [number], [writer.written // 4]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in row], names=FILES.names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    name = f"{part:08d}-{number:04d}-{uuid.uuid4().hex}.zst"
                    writer = Writer(files.open_output_stream(f"{place}/{name}", compression=None))
                writer.add(doc_id, encoder.ids(text.as_py()) + end)
                if writer.written >= FILE_BYTES:
                    yield finished()
                    writer, number = None, number + 1
        if writer is not None:
            yield finished()

    return run


def write_tokens(documents: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Encode every text, append the end id, write files to ``folder``; the list of them.

    Documents are in ascending order of their ids over all files, null first; rows of one id are in
    the order of a hash of their text. A null text counts as empty: the end id alone.
    """
    tasks = max(1, -(-text_bytes(documents) // TASK_BYTES))
    rows = documents.select(F.col("doc_id").cast("bigint"), as_bytes("text").alias("data"))
    # The hash splits rows that share an id.
    keyed = rows.withColumn("mark", F.xxhash64("data"))
    ordered = keyed.repartitionByRange(tasks, "doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    listed = bounded(ordered.select("doc_id", "data")).mapInArrow(
        _write_task(folder, path or public_tokenizers.path(TOKENIZER)), FILES
    )
    return stored(listed, "token-files")


def _read_task(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{place}/{row['path']}") as source:
                    rows = [
                        (doc_id, row["before"] + start, len(ids) // 4, zlib.crc32(ids))
                        for doc_id, start, ids in Reader(source).documents()
                    ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=TOKENS.names
                )

    return run


def read_tokens(listed: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, ids before it, number and CRC-32 of its ids.

    Only the list of files, a row for each 128 MB of ids or task, is numbered in one place.
    """
    order = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = listed.select("path", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before"))
    spread = placed.repartition(max(1, listed.count()), "path")
    return spread.mapInArrow(_read_task(folder), TOKENS)


def token_roundtrip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Write the documents' ids to files in the shared folder and report what these hold."""
    folder = new_folder(documents.sparkSession, "tokens")
    return read_tokens(write_tokens(documents, folder, path), folder)
