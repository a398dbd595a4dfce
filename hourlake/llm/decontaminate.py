"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark.

Texts are normalised by lower-casing A-Z and taking the runs of other word bytes; words are joined
by single spaces. Every window of ten consecutive item words is a pattern; an item of fewer words,
but not none, is one pattern. Each document is scanned once, and what is found is mapped back to
word numbers and to character offsets of the original text.

The benchmark is the stated query set. It is measured first; one automaton is built for up to
``block_bytes`` of its text, and a larger benchmark is scanned for in blocks, one automaton in
memory at a time. Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.tables import as_bytes, bounded, text_bytes

WINDOW = 10
BLOCK_BYTES = 1 << 20

# A-Z become a-z; bytes outside 0-9, a-z and 80-FF separate words.
_WORD_BYTES = bytes(b for b in range(256) if b >= 0x80 or chr(b).isdigit() or chr(b).isalpha())
NORMAL = bytes((b + 32 if 65 <= b <= 90 else b) if b in _WORD_BYTES else 32 for b in range(256))

LEAKS = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("n_hit", T.LongType(), False),
        T.StructField("item_ids", T.ArrayType(T.StringType(), False), False),
        T.StructField("word_runs", T.ArrayType(T.LongType(), False), False),
        T.StructField("spans", T.ArrayType(T.LongType(), False), False),
    ]
)

Patterns = dict[str, tuple[int, list[str]]]


def patterns_of(items: list[tuple[str, bytes]], window: int = WINDOW) -> Patterns:
    """Pattern text → (words in it, ids of the items with it)."""
    found: Patterns = {}
    for item_id, text in items:
        words = text.translate(NORMAL).split()
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            pattern = (b" " + b" ".join(words[i : i + n]) + b" ").decode("latin-1")
            ids = found.setdefault(pattern, (n, []))[1]
            if not ids or ids[-1] != item_id:
                ids.append(item_id)
    return found


class Scanner:
    """The automaton of one block of patterns."""

    def __init__(self, patterns: Patterns) -> None:
        self.entries = list(patterns.values())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.lengths = [len(p) for p in patterns]
        for i, pattern in enumerate(patterns):
            self.automaton.add_word(pattern, i)
        if patterns:
            self.automaton.make_automaton()

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, word runs from first to before last, item ids."""
        words = text.translate(NORMAL).split()
        if not words or not self.entries:
            return len(words), [], set()
        normal = b" " + b" ".join(words) + b" "
        hits = list(self.automaton.iter(normal.decode("latin-1")))
        if not hits:
            return len(words), [], set()
        spaces = np.flatnonzero(np.frombuffer(normal, np.uint8) == 32)
        starts = [end - self.lengths[i] + 1 for end, i in hits]
        firsts = np.searchsorted(spaces, starts)
        runs = [(int(w), int(w) + self.entries[i][0]) for w, (_, i) in zip(firsts, hits, strict=True)]
        return len(words), runs, {x for _, i in hits for x in self.entries[i][1]}


def merged(runs: list[tuple[int, int]]) -> list[int]:
    """Disjoint runs, as first, last, first, last …"""
    out: list[int] = []
    for first, last in sorted(runs):
        if out and first <= out[-1]:
            out[-1] = max(out[-1], last)
        else:
            out += [first, last]
    return out


def character_spans(text: bytes, runs: list[int]) -> list[int]:
    """Character offsets in ``text`` of runs of words, as first, last, first, last …"""
    if not runs:
        return []
    word = np.zeros(len(text) + 2, np.int8)
    word[1:-1] = np.frombuffer(text.translate(NORMAL), np.uint8) != 32
    step = np.diff(word)
    firsts, lasts = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    characters = np.concatenate([[0], np.cumsum(begins)])
    out = []
    for first, last in zip(runs[::2], runs[1::2], strict=True):
        out += [int(characters[firsts[first]]), int(characters[lasts[last - 1]])]
    return out


def _blocks(items: DataFrame, window: int, block_bytes: int) -> Iterator[Patterns]:
    """Patterns of the benchmark, so many bytes of its text at a time."""
    rows = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        as_bytes("text").alias("data"),
    )
    blocks = max(1, -(-text_bytes(items) // block_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "data"), F.lit(blocks)))
    for block in range(blocks):
        held = rows.where(F.col("block") == block).collect()
        yield patterns_of(sorted((r.item_id, bytes(r.data)) for r in held), window)


def scanner_of(patterns) -> Scanner:
    """The automaton of broadcast patterns, built once in each worker process and dropped with them."""
    if "scanner" not in vars(patterns):
        patterns.scanner = Scanner(patterns.value)
    return patterns.scanner


def _scan_task(patterns) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(patterns)
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in LEAKS}
            texts = batch.column("_data")
            before = batch.column("leaks").to_pylist()
            for text, old in zip(texts, before, strict=True):
                data = text.as_py()
                n, runs, ids = scanner.scan(data)
                pairs = list(zip(old["word_runs"][::2], old["word_runs"][1::2], strict=True))
                flat = merged(runs + pairs)
                out["n_words"].append(n)
                out["n_hit"].append(sum(flat[1::2]) - sum(flat[::2]))
                out["item_ids"].append(sorted(ids | set(old["item_ids"])))
                out["word_runs"].append(flat)
                out["spans"].append(character_spans(data, flat))
            kinds = batch.schema.field("leaks").type
            leaks = pa.StructArray.from_arrays(
                [pa.array(out[f.name], f.type) for f in kinds], fields=list(kinds)
            )
            columns = [leaks if n == "leaks" else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return scan


def find_leaks(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``documents`` with a struct ``leaks``: words, words inside occurring windows, ids of the
    items they are of (as texts, sorted), runs of hit words and their character spans in the
    original text.

    A null or empty text has no words and no hits. Repeated rows are judged alike. An item without
    words matches nothing; an item without an id goes by ``null``. A column ``leaks`` or ``_data``
    of the input is replaced.
    """
    empty = F.struct(
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(0).cast("bigint").alias("n_hit"),
        F.array().cast("array<string>").alias("item_ids"),
        F.array().cast("array<bigint>").alias("word_runs"),
        F.array().cast("array<bigint>").alias("spans"),
    )
    found = documents.withColumn("_data", as_bytes("text")).withColumn("leaks", empty)
    for patterns in _blocks(items, window, block_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(patterns)
        found = bounded(found).mapInArrow(_scan_task(shared), found.schema)
    return found.drop("_data")


def leak_report(documents: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: counts, digest of the item ids, and verdict."""
    found = find_leaks(documents.select("doc_id", "text"), items)
    leaks = F.col("leaks")
    return found.select(
        "doc_id",
        leaks["n_words"].alias("n_words"),
        leaks["n_hit"].alias("n_hit"),
        F.size(leaks["item_ids"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(leaks["item_ids"], ","), 256).alias("items_sha256"),
        (leaks["n_hit"] > 0).alias("contaminated"),
    )


def _clean_task(patterns, column: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(patterns)
        for batch in batches:
            texts = batch.column(column).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([not scanner.scan(x or b"")[1] for x in texts], pa.bool_()))

    return clean


def decontaminate(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents without any hit, with the columns they came with, whatever their names.

    A null or empty text has no hit and stays; repeated rows stay or go together; an empty table stays one.
    """
    found = documents
    for patterns in _blocks(items, window, block_bytes):
        shared = documents.sparkSession.sparkContext.broadcast(patterns)
        column = documents.columns.index("text")
        found = bounded(found).mapInArrow(_clean_task(shared, column), documents.schema)
    return found
