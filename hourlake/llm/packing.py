"""Best-fit packing of documents into sequences by the linear grouping scheme.

Only lengths matter for packing, and there are at most as many as a sequence has tokens: the
planning needs the number of pieces of each length, a table of at most 1024 rows, whatever the
corpus. Large lengths are rounded up to the largest of their group, in groups of equal cardinality;
configurations of these few sizes are chosen one after the other, each as full as can be, until all
are used up. Then the actual pieces take the places of the rounded ones, in runs of equal length,
and small ones fill what is left, each going where it leaves least. The plan says which ranks
within a length go where; pieces are ranked and looked up in parallel.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.tables import as_bytes, bounded, stored
from hourlake.llm.tokens import encoder_of

CAPACITY = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
#: Lengths above this are large; groups that these are dealt into.
SMALL = 160
GROUPS = 1024
#: Pieces that one task ranks.
RANKED_TOGETHER = 200_000

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def cut(ids: bytes, capacity: int = CAPACITY) -> Iterator[tuple[int, int, int]]:
    """(start, length, crc32) of the pieces: whole sequences, the first one may be shorter."""
    n = len(ids) // 4
    start = 0
    while start < n:
        length = (n - start) % capacity or capacity
        yield start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])
        start += length


def _cut_task(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, spaced=True)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py()) + end
                rows += [(doc_id, i, *piece) for i, piece in enumerate(cut(ids))]
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=PIECES.names
            )

    return run


def pieces_of(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32.

    A null text counts as empty and is a piece of the end id alone. Null and repeated ids are cut
    like any other.
    """
    rows = documents.select(F.col("doc_id").cast("bigint"), as_bytes("text").alias("data"))
    return bounded(rows).mapInArrow(_cut_task(path or public_tokenizers.path(TOKENIZER)), PIECES)


@dataclass
class Plan:
    """Where the pieces of each length go: those ranked from ``first`` to before ``last`` fill
    sequences from ``sequence`` on, ``each`` of them in one, from ``offset`` on."""

    capacity: int
    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0
    used: dict[int, int] = field(default_factory=dict)
    #: Room left → stretches of sequences (first, number); and the rooms there are, in order.
    room: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    rooms: list[int] = field(default_factory=list)

    def place(self, length: int, count: int, sequence: int, each: int, offset: int) -> None:
        first = self.used.get(length, 0)
        self.used[length] = first + count
        self.runs.append((length, first, first + count, sequence, each, offset))

    def leave(self, room: int, sequence: int, number: int) -> None:
        if number and room:
            if not self.room.get(room):
                insort(self.rooms, room)
            self.room.setdefault(room, []).append((sequence, number))

    def open(self, number: int) -> int:
        self.sequences += number
        return self.sequences - number

    def best_fit(self, length: int, count: int) -> None:
        """Pieces of one length, each where it leaves the least room."""
        while count:
            at = bisect_left(self.rooms, length)
            if at == len(self.rooms):
                number = math.ceil(count / (self.capacity // length))
                self.leave(self.capacity, self.open(number), number)
                continue
            room = self.rooms[at]
            sequence, number = self.room[room].pop()
            if not self.room[room]:
                del self.rooms[at]
            each = room // length
            whole, rest = divmod(min(count, each * number), each)
            offset = self.capacity - room
            if whole:
                self.place(length, whole * each, sequence, each, offset)
                self.leave(room - each * length, sequence, whole)
            if rest:
                self.place(length, rest, sequence + whole, rest, offset)
                self.leave(room - rest * length, sequence + whole, 1)
            held = whole + (rest > 0)
            self.leave(room, sequence + held, number - held)
            count -= whole * each + rest


def groups_of(large: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) in falling order, dealt into groups of equal cardinality."""
    size = math.ceil(sum(n for _, n in large) / groups)
    out: list[list[tuple[int, int]]] = [[]]
    free = size
    for length, count in large:
        while count:
            if not free:
                out.append([])
                free = size
            taken = min(count, free)
            out[-1].append((length, taken))
            count -= taken
            free -= taken
    return out


def configuration(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """Groups in one sequence: the largest left, then what fills it most, larger ones first."""
    first = next(g for g, n in enumerate(left) if n)
    room = capacity - sizes[first]
    # How each sum is reached: (group, sum before), by groups in falling order of size.
    reached: list[tuple[int, int] | None] = [None] * (room + 1)
    known = [0]
    seen = bytearray(room + 1)
    seen[0] = 1
    for g in range(first, len(sizes)):
        size, times = sizes[g], min(left[g] - (g == first), room // sizes[g])
        fresh = known
        for _ in range(times):
            further = []
            for total in fresh:
                after = total + size
                if after <= room and not seen[after]:
                    seen[after] = 1
                    reached[after] = (g, total)
                    further.append(after)
            if not further:
                break
            known = known + further
            fresh = further
        if seen[room]:
            break
    total = max(known)
    out = [first]
    while total:
        g, total = reached[total]
        out.append(g)
    return out


def plan_of(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """A plan for so many pieces of each length."""
    plan = Plan(capacity)
    lengths = sorted(((x, n) for x, n in counts.items() if n), reverse=True)
    for length, count in lengths:
        if length == capacity:
            plan.place(length, count, plan.open(count), 1, 0)
    large = [(x, n) for x, n in lengths if SMALL < x < capacity]
    if large:
        queues = groups_of(large, groups)
        sizes = [q[0][0] for q in queues]
        left = [sum(n for _, n in q) for q in queues]
        while any(left):
            chosen = configuration(sizes, left, capacity)
            uses = {g: chosen.count(g) for g in chosen}
            times = min(left[g] // k for g, k in uses.items())
            for g, k in uses.items():
                left[g] -= times * k
            _substitute(plan, queues, chosen, times)
    for length, count in lengths:
        if length <= SMALL:
            plan.best_fit(length, count)
    return plan


def _substitute(plan: Plan, queues: list[list[tuple[int, int]]], chosen: list[int], times: int) -> None:
    """Fill ``times`` sequences of one configuration with actual pieces, in runs in which each
    place holds one length."""
    places = []
    for g in chosen:
        need, runs = times, []
        while need:
            length, count = queues[g][0]
            taken = min(need, count)
            runs.append([length, taken])
            need -= taken
            if taken == count:
                queues[g].pop(0)
            else:
                queues[g][0] = (length, count - taken)
        places.append(runs)
    while places[0]:
        number = min(runs[0][1] for runs in places)
        sequence, offset = plan.open(number), 0
        for runs in places:
            plan.place(runs[0][0], number, sequence, 1, offset)
            offset += runs[0][0]
            runs[0][1] -= number
            if not runs[0][1]:
                runs.pop(0)
        plan.leave(plan.capacity - offset, sequence, number)


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with the sequence they go to and their offset there.

    The plan has at most a few runs for each of ``capacity`` lengths, so it is broadcast; the
    histogram it is made from has ``capacity`` rows at most. A length that a third of all pieces
    have is ranked in many tasks.
    """
    spark = pieces.sparkSession
    histogram = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    plan = plan_of({r.length: r.n for r in histogram}, capacity)
    schema = "length bigint, first bigint, last bigint, sequence bigint, each bigint, at bigint"
    runs = spark.createDataFrame(plan.runs, schema)
    salts = 1 + sum(r.n for r in histogram) // RANKED_TOGETHER
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("inside", F.row_number().over(inside) - 1)
        .join(sizes, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("inside"))
    )
    placed = ranked.join(F.broadcast(runs), "length").where(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    )
    step = F.col("rank") - F.col("first")
    return placed.select(
        *PIECES.names,
        (F.col("sequence") + F.floor(step / F.col("each"))).alias("sequence_id"),
        (F.col("at") + step % F.col("each") * F.col("length")).alias("offset"),
    )


def pack_documents(documents: DataFrame, path: str | None = None) -> DataFrame:
    """One row per piece of every document, with its place."""
    return packed(stored(pieces_of(documents, path), "pieces"))
