"""Removal of repeated byte strings by prefix-free parsing.

A rolling hash of 16 bytes triggers phrase borders: within every stretch of 50 bytes the position
of the least hash is a trigger, so that equal stretches have equal triggers wherever they occur. A
phrase is what the stretches of one trigger cover together; neighbouring phrases overlap, and each
50-byte string starts in exactly one. The distinct phrases are the dictionary, the sequence of
phrases in a document is its parse. Repetitive text has few distinct phrases, so the work after
parsing follows the dictionary and not the corpus:

1. Dictionary entries are sorted by hashes of trigger and phrase and by first document. All
   occurrences but those in the first document of a phrase are repeats as a whole; nothing more is
   done with them. A trigger with one phrase only is settled thereby.
2. Of phrases that share a trigger with another phrase, the suffixes of at least 50 bytes are sorted
   by their first 50 bytes, and by the first document of their phrase. No other suffix of the
   dictionary is sorted; beyond 50 bytes order doesn't matter, which is why a suffix never needs the
   parse to break ties. Each run of equal suffixes belongs to its first document.
3. The parse carries both answers back to corpus order: each document learns which of its phrases,
   and which suffixes of its other phrases, start in an earlier document.

Texts are packed into blocks of some megabytes, stored once in a table bucketed by block; each step
joins what was found to the blocks without moving them. Blocks send one entry per distinct phrase
as packed columns, so a passage in a third of all documents costs one entry per block. Suffixes of a
trigger with very many phrases are dealt out by their own hash instead of the trigger's.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.features import RangeHash, mix
from hourlake.llm.tables import as_bytes, new_folder, stored, text_bytes

LENGTH = 50
TRIGGER = 16
#: Bytes of text in one block, and for one bucket of blocks or of dictionary entries.
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20
#: Phrases of one trigger beyond which its suffixes are dealt out one by one.
MANY = 20_000
#: Bytes that are parsed at once.
SEGMENT = 1 << 19

_STARTS = LENGTH - TRIGGER + 1
_POSITION = np.uint64((1 << 21) - 1)
_LATE = np.iinfo(np.int64).max

BLOCKS = T.StructType(
    [T.StructField("block", T.LongType(), False), T.StructField("payload", T.BinaryType(), False)]
)
ENTRIES = T.StructType(
    [
        T.StructField("bucket", T.LongType(), False),
        T.StructField("block", T.LongType(), False),
        T.StructField("data", T.BinaryType(), False),
    ]
)

# What the dictionary says of an entry: alone, repeats an earlier document, first of several
# phrases of its trigger, and the same with very many phrases.
ALONE, REPEAT, OPEN, OPEN_MANY = range(4)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of integers, the bytes of each by significance, compressed."""
    parts = []
    for c in columns:
        planes = np.frombuffer(c.tobytes(), np.uint8).reshape(len(c), c.dtype.itemsize).T
        parts.append(f"{c.dtype.str},{len(c)};".encode() + b"\0" + planes.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(plain):
        end = plain.index(b"\0", at)
        kind, n = plain[at : end - 1].decode().split(",")
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(plain, np.uint8, int(n) * size, end + 1).reshape(size, int(n))
        out.append(np.frombuffer(planes.T.tobytes(), kind))
        at = end + 1 + int(n) * size
    return out


def slide_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    out, w = values, 1
    while 2 * w <= width:
        out = np.minimum(out[:-w], out[w:])
        w *= 2
    return np.minimum(out[: len(out) - (width - w)], out[width - w :]) if w < width else out


@dataclass
class Parse:
    """Phrases of a buffer of documents: trigger and phrase hash, first and last start of a 50-byte
    string, number of the document."""

    trigger: np.ndarray
    phrase: np.ndarray
    first: np.ndarray
    last: np.ndarray
    owner: np.ndarray


def parse(data: np.ndarray, ends: np.ndarray) -> Parse:
    """``ends``: where each document ends in ``data``."""
    parts = []
    for begin in range(0, max(1, len(data) - LENGTH + 1), SEGMENT):
        parts.append(_parse_segment(data[begin : begin + SEGMENT + LENGTH - 1], begin, ends))
    return Parse(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _parse_segment(data: np.ndarray, begin: int, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    n = len(data) - LENGTH + 1
    if n < 1:
        none, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return none, none, at, at, at
    hashes = RangeHash(data)
    grams = len(data) - TRIGGER + 1
    rolled = hashes(slice(0, grams), slice(TRIGGER, TRIGGER + grams))
    least = slide_least((rolled & ~_POSITION) | np.arange(grams, dtype=np.uint64), _STARTS)
    # Strings that would cross the end of a document aren't any.
    inside = np.zeros(n + 1, np.int32)
    local = ends - begin
    local = local[(local > 0) & (local - LENGTH + 1 < n)]
    np.add.at(inside, np.maximum(local - LENGTH + 1, 0), 1)
    np.add.at(inside, np.minimum(local, n), -1)
    at = np.flatnonzero(np.cumsum(inside[:n]) == 0)
    if not len(at):
        none, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return none, none, at, at, at
    least = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)
    starts = np.flatnonzero(new)
    first, last = at[starts], at[np.append(starts[1:], len(at)) - 1]
    # Least hashes are small; mixed once more they spread over all buckets.
    trigger = mix(rolled[(least[starts] & _POSITION).astype(np.int64)] + np.uint64(1))
    owner = np.searchsorted(ends, first + begin, side="right")
    return trigger, hashes(first, last + LENGTH), first + begin, last + begin, owner


class Block:
    """The documents of one block, parsed."""

    def __init__(self, payload: bytes) -> None:
        self.batch = pa.ipc.open_stream(payload).read_next_batch()
        self.texts = self.batch.column("_data").to_pylist()
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        self.ends = np.cumsum([len(x) for x in self.texts])
        ids = self.batch.column("doc_id").cast(pa.int64())
        # A document without an id comes after all others.
        self.ids = ids.fill_null(_LATE).to_numpy(zero_copy_only=False)
        self.parse = parse(self.data, self.ends)
        documents = self.ids[self.parse.owner]
        order = np.lexsort((documents, self.parse.phrase, self.parse.trigger))
        t, p = self.parse.trigger[order], self.parse.phrase[order]
        new = np.ones(len(order), bool)
        new[1:] = (t[1:] != t[:-1]) | (p[1:] != p[:-1])
        #: Distinct phrases by trigger and hash: their first occurrence, and of each phrase its entry.
        self.entries = order[new]
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.documents = documents

    def bucket_bounds(self, buckets: int) -> np.ndarray:
        """Where the entries of each bucket begin: buckets are ranges of trigger hashes."""
        return np.searchsorted(_bucket(self.parse.trigger[self.entries], buckets), np.arange(buckets + 1))


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Even ranges of 64-bit hashes, in their order."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _blocks_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        sink = io.BytesIO()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, table.schema, options=options) as out:
            out.write_table(table)
        payload = sink.getvalue()
        # Blocks of the same name hold the same documents.
        name = xxhash.xxh64_intdigest(payload) - (1 << 63)
        columns = pa.array([name], pa.int64()), pa.array([payload], pa.binary())
        return pa.RecordBatch.from_arrays(list(columns), names=BLOCKS.names)

    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        sizes = [len(x) for x in batch.column("_data").to_pylist()]
        start = 0
        for i, size in enumerate(sizes):
            total += size + 64
            if total >= BLOCK_BYTES:
                held.append(batch.slice(start, i + 1 - start))
                yield rows(held)
                held, total, start = [], 0, i + 1
        if start < len(sizes):
            held.append(batch.slice(start))
    if held:
        yield rows(held)


def _entries_task(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, payload in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                block = Block(payload)
                bounds = block.bucket_bounds(buckets)
                at = block.entries
                trigger, phrase = block.parse.trigger[at], block.parse.phrase[at]
                ids, document = np.unique(block.documents[at], return_inverse=True)
                document = document.astype(np.uint32)
                rows = []
                for b in np.flatnonzero(np.diff(bounds)):
                    part = slice(bounds[b], bounds[b + 1])
                    steps = np.diff(trigger[part], prepend=np.uint64(0))
                    mine, short = np.unique(document[part], return_inverse=True)
                    data = _pack(steps, phrase[part], short.astype(np.uint32), ids[mine])
                    rows.append((int(b), name, data))
                yield _entry_batch(rows)

    return run


def _entry_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary())
    columns = zip(*rows, strict=True) if rows else [[]] * 3
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=ENTRIES.names
    )


def _dictionary(key: tuple, table: pa.Table) -> pa.Table:
    """One bucket of the dictionary: what becomes of each entry."""
    blobs = [_unpack(x) for x in table.column("data").to_pylist()]
    trigger = np.concatenate([np.cumsum(b[0], dtype=np.uint64) for b in blobs])
    phrase = np.concatenate([b[1] for b in blobs])
    document = np.concatenate([b[3][b[2]] for b in blobs])
    order = np.lexsort((document, phrase, trigger))
    t, p, d = trigger[order], phrase[order], document[order]
    new_t = np.ones(len(t), bool)
    new_t[1:] = t[1:] != t[:-1]
    new_p = new_t.copy()
    new_p[1:] |= p[1:] != p[:-1]
    group = np.cumsum(new_t) - 1
    phrases = np.bincount(group, new_p).astype(np.int64)[group]
    first = d[np.flatnonzero(new_p)][np.cumsum(new_p) - 1]
    said = np.where(phrases > MANY, OPEN_MANY, np.where(phrases > 1, OPEN, ALONE)).astype(np.uint8)
    said[d > first] = REPEAT
    verdict = np.empty(len(said), np.uint8)
    verdict[order] = said
    ends = np.cumsum([len(b[0]) for b in blobs])
    parts = np.split(verdict, ends[:-1])
    blocks = table.column("block").to_pylist()
    rows = [(key[0].as_py(), n, _pack(v)) for n, v in zip(blocks, parts, strict=True)]
    return pa.Table.from_batches([_entry_batch(rows)])


def _verdicts(block: Block, buckets: int, answers: list[dict] | None) -> np.ndarray:
    """What the dictionary said, entry by entry."""
    said = np.zeros(len(block.entries), np.uint8)
    bounds = block.bucket_bounds(buckets)
    for a in answers or []:
        said[bounds[a["bucket"]] : bounds[a["bucket"] + 1]] = _unpack(a["data"])[0]
    return said


@dataclass
class OpenStrings:
    """Stretches of a block whose 50-byte strings are still open: first and last start, document,
    bucket; sorted by bucket."""

    first: np.ndarray
    last: np.ndarray
    document: np.ndarray
    bucket: np.ndarray

    @classmethod
    def of(cls, block: Block, said: np.ndarray, buckets: int) -> OpenStrings:
        whole = block.entries[said == OPEN]
        many = block.entries[said == OPEN_MANY]
        p = block.parse
        sizes = p.last[many] - p.first[many] + 1
        starts = np.repeat(p.first[many], sizes) + _counting(sizes)
        first = np.concatenate([p.first[whole], starts])
        last = np.concatenate([p.last[whole], starts])
        document = np.concatenate([block.documents[whole], np.repeat(block.documents[many], sizes)])
        bucket = np.concatenate(
            [_bucket(p.trigger[whole], buckets), _bucket(_string_hashes(block.data, starts), buckets)]
        )
        order = np.argsort(bucket, kind="stable")
        return cls(first[order], last[order], document[order], bucket[order])


def _counting(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … for each size, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _string_hashes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the 50 bytes from each start on; segments keep the arrays small."""
    out = np.empty(len(starts), np.uint64)
    for begin in range(0, len(data), SEGMENT):
        mine = np.flatnonzero((starts >= begin) & (starts < begin + SEGMENT))
        if len(mine):
            at = starts[mine] - begin
            out[mine] = RangeHash(data[begin : begin + SEGMENT + LENGTH])(at, at + LENGTH)
    return out


def _sorted_strings(data: np.ndarray, starts: np.ndarray, document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the 50-byte strings from each start on, by their bytes and then by document, and
    which of them differ from the one before."""
    # Eight bytes from any place on, as a number; nothing is copied.
    words = np.ndarray(len(data) - 7, ">u8", np.ascontiguousarray(data), 0, (1,))
    places = (0, 8, 16, 24, 32, 40, LENGTH - 8)
    order = np.argsort(document, kind="stable")
    for k in reversed(places):
        order = order[np.argsort(words[starts[order] + k].astype(np.uint64), kind="stable")]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in places:
        word = words[starts[order] + k]
        new[1:] |= word[1:] != word[:-1]
    return order, new


def _strings_task(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, payload, answers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = Block(payload)
                found = OpenStrings.of(block, _verdicts(block, buckets, answers), buckets)
                bounds = np.searchsorted(found.bucket, np.arange(buckets + 1))
                rows = []
                for b in np.flatnonzero(np.diff(bounds)):
                    part = slice(bounds[b], bounds[b + 1])
                    first, sizes = found.first[part], found.last[part] - found.first[part] + LENGTH
                    places = np.repeat(first, sizes) + _counting(sizes)
                    ids, document = np.unique(found.document[part], return_inverse=True)
                    columns = block.data[places], sizes.astype(np.uint32), document.astype(np.uint32), ids
                    rows.append((int(b), name, _pack(*columns)))
                yield _entry_batch(rows)

    return run


def _suffixes(key: tuple, table: pa.Table) -> pa.Table:
    """One bucket of the dictionary's open suffixes: which of them an earlier document has."""
    blobs = [_unpack(x) for x in table.column("data").to_pylist()]
    data = np.concatenate([b[0] for b in blobs])
    sizes = np.concatenate([b[1] for b in blobs]).astype(np.int64)
    document = np.concatenate([b[3][b[2]] for b in blobs])
    strings = sizes - LENGTH + 1
    starts = np.repeat(np.cumsum(sizes) - sizes, strings) + _counting(strings)
    d = np.repeat(document, strings)
    order, new = _sorted_strings(data, starts, d)
    least = d[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    earlier = np.empty(len(order), np.uint8)
    earlier[order] = d[order] > least
    of_blob = np.cumsum([int((b[1].astype(np.int64) - LENGTH + 1).sum()) for b in blobs])
    parts = np.split(earlier, of_blob[:-1])
    blocks = table.column("block").to_pylist()
    rows = [(key[0].as_py(), n, _pack(np.packbits(v))) for n, v in zip(blocks, parts, strict=True)]
    return pa.Table.from_batches([_entry_batch(rows)])


def _covered(block: Block, said: np.ndarray, buckets: int, answers: list[dict] | None) -> np.ndarray:
    """For each byte of the block: whether it goes."""
    p = block.parse
    step = np.zeros(len(block.data) + 1, np.int32)
    # A later document of the block repeats an earlier one as well.
    own = block.documents[block.entries]
    whole = (said[block.entry] == REPEAT) | (block.documents > own[block.entry])
    np.add.at(step, p.first[whole], 1)
    np.add.at(step, p.last[whole] + LENGTH, -1)
    found = OpenStrings.of(block, said, buckets)
    bounds = np.searchsorted(found.bucket, np.arange(buckets + 1))
    goes = np.zeros(len(block.data), bool)
    for a in answers or []:
        part = slice(bounds[a["bucket"]], bounds[a["bucket"] + 1])
        sizes = found.last[part] - found.first[part] + 1
        starts = np.repeat(found.first[part], sizes) + _counting(sizes)
        goes[starts] = np.unpackbits(_unpack(a["data"])[0], count=len(starts)).astype(bool)
    # An entry is asked about once; its document has the phrase at other places as well.
    at = block.entries[block.entry]
    again = np.flatnonzero(~whole & (said[block.entry] >= OPEN) & (at != np.arange(len(at))))
    sizes = p.last[again] - p.first[again] + 1
    count = _counting(sizes)
    goes[np.repeat(p.first[again], sizes) + count] = goes[np.repeat(p.first[at[again]], sizes) + count]
    starts = np.flatnonzero(goes)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _apply_task(buckets: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, payload, entries, strings in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = Block(payload)
                said = _verdicts(block, buckets, entries)
                goes = _covered(block, said, buckets, strings)
                out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "text": []}
                begin = 0
                for text, end in zip(block.texts, block.ends, strict=True):
                    mask = goes[begin:end]
                    removed = int(mask.sum())
                    kept = text
                    spans = 0
                    if removed:
                        kept = block.data[begin:end][~mask].tobytes()
                        spans = int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1]))
                    kept_as = hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")
                    for key, value in zip(out, (len(text), removed, spans, *kept_as), strict=True):
                        out[key].append(value)
                    begin = end
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                columns = [block.batch.column(n) for n in names]
                columns += [pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *(f"_{k}" for k in out)])

    return run


def _answers(frame: DataFrame, name: str) -> DataFrame:
    """The answers of all buckets to each block."""
    kept = stored(frame, name)
    grouped = kept.groupBy("block").agg(F.collect_list(F.struct("bucket", "data")).alias(name))
    # The blocks stay where they are and needn't be sorted.
    return grouped.hint("shuffle_hash")


def with_removals(documents: DataFrame) -> DataFrame:
    """``documents`` with ``_n_bytes``, ``_n_removed``, ``_n_spans``, ``_kept`` (SHA-256 of the
    bytes that stay) and ``_text`` (what of them is whole characters), in place of ``text``.

    A byte goes if a 50-byte string over it also starts in a document with a smaller doc_id; strings
    never cross documents and are judged on the input. A null text counts as empty; texts of fewer
    than 50 bytes stay. Rows with one id don't repeat each other; a row without an id comes after
    all others. Phrases are compared by hashes of them and of their trigger, strings by their bytes.
    """
    spark = documents.sparkSession
    buckets = max(1, -(-text_bytes(documents) // BUCKET_BYTES))
    columns = documents.columns
    rows = documents.withColumn("_data", as_bytes("text"))
    if "text" in columns:
        rows = rows.drop("text")
        columns = [c for c in columns if c != "text"]
    packed = rows.mapInArrow(_blocks_task, BLOCKS)
    name = f"text_blocks_{uuid.uuid4().hex}"
    # With fewer buckets than a shuffle has partitions, joins would move the blocks after all.
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (
        packed.repartition(parts, "block")
        .write.bucketBy(parts, "block")
        .option("path", new_folder(spark, "text-blocks"))
        .saveAsTable(name)
    )
    blocks = spark.table(name)
    sent = blocks.mapInArrow(_entries_task(buckets), ENTRIES)
    entries = _answers(sent.groupBy("bucket").applyInArrow(_dictionary, ENTRIES), "entries")
    known = blocks.join(entries, "block", "left").select("block", "payload", "entries")
    open_strings = known.mapInArrow(_strings_task(buckets), ENTRIES)
    strings = _answers(open_strings.groupBy("bucket").applyInArrow(_suffixes, ENTRIES), "strings")
    full = known.join(strings, "block", "left").select("block", "payload", "entries", "strings")
    schema = T.StructType(
        [
            *(documents.schema[c] for c in columns),
            *(T.StructField(f"_{c}", T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
            *(T.StructField(f"_{c}", T.StringType()) for c in ("kept", "text")),
        ]
    )
    return full.mapInArrow(_apply_task(buckets, columns), schema)


def removal_report(documents: DataFrame) -> DataFrame:
    """doc_id, bytes, removed bytes and runs, digest of what is kept."""
    found = with_removals(documents.select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("_n_bytes").alias("n_bytes"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_n_spans").alias("n_spans"),
        F.col("_kept").alias("kept_sha256"),
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """The documents with their repeated strings cut out, and ``n_chars``, if there, of what is left.

    Where a cut splits a character, its other bytes go as well. A null text stays null; no document
    goes, also if nothing of its text is left.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns if c != "text"), F.col("text").isNull().alias("_null"))
    found = with_removals(documents.select("doc_id", "text", row.alias("_row")))
    text = F.when(~F.col("_row._null"), F.col("_text"))
    changed = F.col("_n_removed") > 0

    def column(name: str) -> Column:
        if name == "text":
            return text.alias(name)
        value = F.col(f"_row.`{name}`")
        if name == "n_chars":
            length = F.char_length(text).cast(documents.schema[name].dataType)
            return F.when(changed, length).otherwise(value).alias(name)
        return value

    return found.select(*map(column, documents.columns))
