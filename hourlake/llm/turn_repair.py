"""Conversation structure repair: the cheapest edits that make the roles alternate.

A repaired conversation has the roles ``(system? (user assistant)+)?``. Rows may be kept, get another
role, be deleted, and empty turns may be inserted, each at its cost. Least costs follow from a Viterbi
recursion over four states: what the last turn of the repaired conversation so far is (nothing,
system, user, assistant). Costs are worked out backwards, as costs still to come.

Conversations are cut into chunks, which are worked on in parallel. All but the last chunk of a
conversation start from a speculative cost vector. Fix-up passes then hand each chunk the vector that
its right neighbour found; where that differs from the one it started from by more than a constant, the
chunk is run again, up to the row from which on the vectors are parallel to the old ones. Vectors are
kept less their least entry, so parallel ones are equal. Then the chunks' maps from the state on their
left to that on their right, as the least audit walks them, are composed by doubling until each is
constant, and every chunk traces its own edits.

Rows with no choice (blank ones and repeats must go) cost the same in every state, so chunks hold only
the others. Equal rows of one turn are one entry with a number of copies. No step holds a conversation's
rows together: neither a hot conversation nor a hot text in it meets in one task. Each pass is a stored
table. The number of passes is the longest row of chunks that parallel vectors don't interrupt, mostly
one; in a conversation of nothing but system turns it would be all its chunks.

Cases: null conv_ids are a conversation of their own; nulls elsewhere count as one space. Rows are ordered
by turn (null first), role, the first 64 characters of the text, and a hash of it; repeated rows stand one
after the other. A role without one of the initials s, u, a can't be kept. An empty table gives an
empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.tables import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Entries of the global order from which a chunk is cut: 2 ** 12.
CHUNK_BITS = 12

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after an insertion, or after a row that gets a role.
_NEXT = (USER, USER, ASSISTANT, USER)
#: State after a kept row, by its initial and the state before it.
_KEPT = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
_INITIALS = "-sua"
_NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Costs still to come behind the last row.
_END = (0, 2 * INSERT, INSERT, 0)
_SPECULATIVE = (0, 0, 0, 0)

_BLANKS = " \t\n\x0b\f\r"
MARKS = ".!?"

Vector = tuple[int, ...]


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text,
    2 removes its end marks, 3 repeats it, 4 makes it the user's. Returns conv_id, turn, role, text, with
    nulls of the last two as one space."""

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    role, text = known("role").alias("role"), known("text").alias("text")
    rows = turns.select("conv_id", "turn", role, text, fault.alias("fault"))
    text = (
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    kept = rows.where(F.col("fault") != 0).withColumn("time", F.explode(times))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def entries(turns: DataFrame) -> DataFrame:
    """Distinct rows in order, with faults: conv_id, ``at`` (rising along each conversation), turn, role,
    text, ``copies``, ``fault`` (of the first copy; the others are duplicates) and ``initial``.

    The order comes from a range partitioning, which cuts a hot conversation where its rows differ.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    distinct = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 64), F.xxhash64("text")]
    end = F.rtrim(F.col("text"), F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    ordered = (
        distinct.repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
        .select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            "turn",
            "role",
            "text",
            "copies",
            F.when(initial.isin("s", "u", "a"), initial).otherwise("-").alias("initial"),
            (end == "").alias("blank"),
            (~F.substring(end, -1, 1).isin(*MARKS)).alias("truncated"),
            F.xxhash64("role", "text").alias("h1"),
            F.xxhash64(F.lit("second"), "text", "role").alias("h2"),
        )
    )
    at = stored(ordered, "turns")
    said = (
        at.where(~F.col("blank"))
        .groupBy("conv_id", "h1", "h2")
        .agg(F.min("at").alias("first"), F.count("*").alias("times"))
        .where("times > 1")
    )
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("first") < F.col("at"), "duplicate")
        .when(F.col("truncated"), "truncated")
    )
    found = _joined(at, said, ["conv_id", "h1", "h2"], "left").select(
        "conv_id", "at", "turn", "role", "text", "copies", fault.alias("fault"), "initial"
    )
    return stored(found, "turn-faults")


# The recursion, on plain numbers. A code is 2 * place of the initial in ``_INITIALS`` + truncated.


@cache
def _choices(code: int, after: Vector) -> tuple[tuple[dict[str, tuple[int, int]], ...], Vector]:
    """For each state before a row: edit → (cost to the end, state after it), of the row's own edits; and the
    costs to come before it, with insertions."""
    extra, initial = code % 2, _INITIALS[code // 2]
    own = []
    for state in range(4):
        edits = {"D": (DELETE + after[state], state)}
        kept = _KEPT.get(initial, {}).get(state)
        if kept is not None:
            edits["K"] = (KEEP + extra * TRUNCATED + after[kept], kept)
        edits["R"] = (REROLE + extra * TRUNCATED + after[_NEXT[state]], _NEXT[state])
        own.append(edits)
    least = [min(cost for cost, _ in edits.values()) for edits in own]
    costs = []
    for state in range(4):
        one, two = _NEXT[state], _NEXT[_NEXT[state]]
        costs.append(min(least[state], INSERT + least[one], 2 * INSERT + least[two]))
    return tuple(own), tuple(costs)


@cache
def _before(code: int, after: Vector) -> Vector:
    """Costs to come before a row, less their least."""
    costs = _choices(code, after)[1]
    return tuple(c - min(costs) for c in costs)


@cache
def _walk(code: int, after: Vector, state: int) -> tuple[str, str, int]:
    """The least edits of a row: initials of turns inserted before it, its own edit with the initial of its new
    role, and the state after it."""
    own, costs = _choices(code, after)
    inserted = ""
    while own[state]["D"][0] != costs[state] and INSERT + costs[_NEXT[state]] == costs[state]:
        state = _NEXT[state]
        inserted += _INITIALS[state]
    edit = next(e for e in "DKR" if e in own[state] and own[state][e][0] == costs[state])
    state = own[state][edit][1]
    return inserted, edit + _INITIALS[state] * (edit == "R"), state


def solve(codes: bytes, right: Vector, old: bytes = b"") -> bytes:
    """Cost vectors before each row, four bytes each, from the vector behind the last row. With the vectors of
    an earlier run, stops where they are the same."""
    vectors, now = bytearray(old or 4 * len(codes)), right
    for i in range(len(codes) - 1, -1, -1):
        now = _before(codes[i], now)
        if old and bytes(now) == old[4 * i : 4 * i + 4]:
            break
        vectors[4 * i : 4 * i + 4] = bytes(now)
    return bytes(vectors)


def trace(codes: bytes, vectors: bytes, right: Vector, state: int) -> tuple[list[str], int]:
    """For each row the initials inserted before it and its edit, and the state behind the last row."""
    edits = []
    for i, code in enumerate(codes):
        after = tuple(vectors[4 * i + 4 : 4 * i + 8]) if i + 1 < len(codes) else right
        inserted, edit, state = _walk(code, after, state)
        edits.append(inserted + edit)
    return edits, state


def _rows(batch: pa.RecordBatch) -> list[dict]:
    rows = batch.to_pylist()
    for r in rows:
        r["codes"], r["behind"] = bytes(r["codes"]), tuple(r["behind"])
    return rows


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [solve(r["codes"], r["behind"], r["vectors"] or b"") for r in _rows(batch)]
        at = batch.schema.get_field_index("vectors")
        yield batch.set_column(at, "vectors", pa.array(found, pa.binary()))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            "".join(
                str(trace(r["codes"], r["vectors"], r["behind"], s)[1])
                for s in ([START] * 4 if r["k"] == 1 else range(4))
            )
            for r in _rows(batch)
        ]
        columns = [batch["conv_id"], batch["k"], pa.array(found, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "k", "exits"])


def _traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        edits, trailing = [], []
        for r in _rows(batch):
            found, state = trace(r["codes"], r["vectors"], r["behind"], int(r["entered"]))
            more = ""
            while r["last"] and _END[state]:
                state = _NEXT[state]
                more += _INITIALS[state]
            edits.append(found)
            trailing.append(more)
        columns = [batch["conv_id"], batch["ats"], pa.array(edits, pa.list_(pa.string())), pa.array(trailing)]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "ats", "edits", "trailing"])


def _vector(vector: Vector) -> Column:
    return F.unhex(F.lit(bytes(vector).hex()))


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A null-safe join on ``keys``, which the result has once."""
    renamed = right.withColumnsRenamed({k: f"other_{k}" for k in keys})
    on = [left[k].eqNullSafe(renamed[f"other_{k}"]) for k in keys]
    return left.join(renamed, on, how).drop(*(f"other_{k}" for k in keys))


_CHUNK = ["conv_id", "k"]


def chunks(found: DataFrame) -> DataFrame:
    """Rows with a choice, in chunks: conv_id, ``k`` (from 1 on along the conversation), ``last``, ``ats`` and
    ``codes`` of at most 2 ** CHUNK_BITS entries, and the vector ``behind`` them to start from."""
    live = found.where("fault IS NULL OR fault = 'truncated'").select(
        "conv_id",
        "at",
        F.shiftright("at", CHUNK_BITS).alias("block"),
        F.expr(f"2 * (instr('{_INITIALS}', initial) - 1) + int(fault <=> 'truncated')").alias("code"),
    )
    along = Window.partitionBy("conv_id").orderBy("block")
    numbers = live.groupBy("conv_id", "block").agg(F.lit(None).alias("_")).select(
        "conv_id",
        "block",
        F.row_number().over(along).cast("bigint").alias("k"),
        F.lead("block").over(along).isNull().alias("last"),
    )
    inside = F.array_sort(F.collect_list(F.struct("at", "code")))
    cut = live.groupBy("conv_id", "block").agg(inside.alias("rows"))
    return _joined(cut, numbers, ["conv_id", "block"]).select(
        "conv_id",
        "k",
        "last",
        F.col("rows.at").alias("ats"),
        F.col("rows.code").alias("codes"),
        F.when(F.col("last"), _vector(_END)).otherwise(_vector(_SPECULATIVE)).alias("behind"),
        F.lit(None).cast("binary").alias("vectors"),
    )


def settled(state: DataFrame) -> DataFrame:
    """Solved chunks after fix-up passes: each starts from a vector parallel to its right neighbour's first."""
    while True:
        fronts = state.where("k > 1").select(
            "conv_id", (F.col("k") - 1).alias("k"), F.substring("vectors", 1, 4).alias("front")
        )
        wrong = _joined(state, fronts, _CHUNK).where("front != behind")
        wrong = wrong.select(*(F.col("front").alias(c) if c == "behind" else c for c in state.columns))
        again = stored(wrong.mapInArrow(_solved, state.schema), "turn-fixed")
        if again.isEmpty():
            return state
        rest = _joined(state, again.select(*_CHUNK), _CHUNK, "left_anti")
        state = stored(rest.union(again), "turn-state")


def entered(state: DataFrame) -> DataFrame:
    """The state on the left of each chunk but the first: conv_id, k, ``entered``.

    Maps from the state on the left to that on the right, four digits each, are composed over ever longer
    rows of chunks until all are constant.
    """
    kind = state.schema["conv_id"].dataType.simpleString()
    found = state.mapInArrow(_exits, f"conv_id {kind}, k bigint, exits string")
    maps = stored(found, "turn-exits")
    reach = 1
    while not maps.where("translate(exits, left(exits, 1), '') != ''").isEmpty():
        before = maps.select("conv_id", (F.col("k") + reach).alias("k"), F.col("exits").alias("before"))
        both = _joined(maps, before, _CHUNK, "left").select(
            "conv_id", "k", F.expr("coalesce(translate(before, '0123', exits), exits)").alias("exits")
        )
        maps, reach = stored(both, "turn-exits"), 2 * reach
    return maps.select("conv_id", (F.col("k") + 1).alias("k"), F.left("exits", F.lit(1)).alias("entered"))


def repairs(turns: DataFrame) -> DataFrame:
    """The cheapest edits, the ASCII-least in order (D, I, K, R) among equal ones.

    One row per distinct row of a conversation, ordered by ``at``: conv_id, at, turn, role, text, ``copies``,
    ``fault`` (of the first copy; the others are duplicates, and deleted), ``inserted`` (initials of turns
    inserted before it), ``edit`` (K, R or D) and ``new_role``. Turns inserted at a conversation's end are
    a row of no copies.
    """
    found = entries(turns)
    kind = found.schema["conv_id"].dataType.simpleString()
    cut = chunks(found)
    state = stored(cut.mapInArrow(_solved, cut.schema), "turn-state")
    several = state.where("k > 1 OR NOT last")
    single = state.where("k = 1 AND last").withColumn("entered", F.lit(str(START)))
    if not several.isEmpty():
        several = settled(several)
        starts = entered(several)
        joined = _joined(several, starts, _CHUNK, "left")
        single = single.union(joined.select(*several.columns, F.coalesce("entered", F.lit(str(START)))))
    traced = stored(
        single.mapInArrow(_traced, f"conv_id {kind}, ats array<bigint>, edits array<string>, trailing string"),
        "turn-edits",
    )
    edits = traced.select(F.inline(F.arrays_zip("ats", "edits"))).select(
        F.col("ats").alias("at"),
        F.regexp_extract("edits", "^[ua]*", 0).alias("inserted"),
        F.regexp_extract("edits", "[DKR]", 0).alias("edit"),
        F.regexp_extract("edits", "[ua]?$", 0).alias("new"),
    )
    new_role = F.when(F.col("new") == "u", _NAMES[USER]).when(F.col("new") == "a", _NAMES[ASSISTANT])
    edited = found.join(edits, "at", "left").select(
        "conv_id",
        "at",
        "turn",
        "role",
        "text",
        "copies",
        "fault",
        F.coalesce("inserted", F.lit("")).alias("inserted"),
        F.coalesce("edit", F.lit("D")).alias("edit"),
        new_role.alias("new_role"),
    )
    ends = traced.where("trailing != ''").selectExpr(
        "conv_id", f"{2**63 - 1} AS at", "cast(NULL AS bigint) AS turn", "'' AS role", "'' AS text",
        "0L AS copies", "cast(NULL AS string) AS fault", "trailing", "'' AS edit", "cast(NULL AS string)",
    )
    return edited.union(ends)


def repaired(edits: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, ``at``, ``place`` (order them by both), role, text."""
    inserted = F.transform(
        F.split("inserted", ""),
        lambda c: F.when(c == "u", F.struct(F.lit(_NAMES[USER]).alias("role"), F.lit("").alias("text"))).when(
            c == "a", F.struct(F.lit(_NAMES[ASSISTANT]).alias("role"), F.lit("").alias("text"))
        ),
    )
    own = F.when(
        F.col("edit").isin("K", "R"),
        F.array(F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text").alias("text"))),
    ).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    made = F.concat(F.array_compact(inserted), own)
    rows = edits.select("conv_id", "at", F.posexplode(made).alias("place", "row"))
    return rows.select("conv_id", "at", "place", "row.role", "row.text")


_REPORT = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Digest:
    """What the report says of one conversation, row by row."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.turns, self.low, self.high, self.last = 0, None, None, None
        self.audit: list[str] = []
        self.sha, self.empty = hashlib.sha256(), True

    def line(self, role: str, text: str) -> None:
        self.sha.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode())
        self.empty = False

    def add(self, turn, role, text, copies, fault, inserted, edit, new_role) -> None:
        for initial in inserted:
            self.line(_NAMES[_INITIALS.index(initial)], "")
        self.audit.append("I" * len(inserted) + edit + (edit and "D") * (copies - 1))
        self.cost += INSERT * len(inserted)
        if not copies:
            return
        if turn is not None and turn != self.high:
            self.turns, self.high = self.turns + 1, turn
            self.low = turn if self.low is None else self.low
        again = role[:1], role[:1]
        self.illegal += (copies - 1) * (again not in _LEGAL)
        self.illegal += self.last is not None and (self.last, role[:1]) not in _LEGAL
        self.last = role[:1]
        self.blank += copies * (fault == "blank")
        self.duplicate += copies * (fault == "duplicate") + (copies - 1) * (fault not in ("blank", "duplicate"))
        self.truncated += fault == "truncated"
        self.cost += DELETE * (copies - (edit != "D")) + (edit != "D") * (fault == "truncated") * TRUNCATED
        self.cost += REROLE * (edit == "R")
        if edit != "D":
            self.line(new_role or role, text)

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        counts = (self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return gaps, *counts, "".join(self.audit), self.sha.hexdigest()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation; one conversation's counters are held at a time."""
    names = [x.split()[0] for x in _REPORT.split(", ")]
    types = [pa.string() if x.endswith("string") else pa.int64() for x in _REPORT.split(", ")]
    open_, conv_id, digest, kind = False, None, _Digest(), None

    def out(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        arrays = [pa.array(c, t) for c, t in zip(columns, [kind, *types], strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", *names])

    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for r in batch.to_pylist():
            if not open_ or r["conv_id"] != conv_id:
                if open_:
                    done.append((conv_id, *digest.row()))
                open_, conv_id, digest = True, r["conv_id"], _Digest()
            if r["at"] >= 0:
                digest.add(*(r[c] for c in _ADDED))
        if done:
            yield out(done)
    if open_:
        yield out([(conv_id, *digest.row())])


_ADDED = ("turn", "role", "text", "copies", "fault", "inserted", "edit", "new_role")


def repair_report(conversations: DataFrame) -> DataFrame:
    """The contract's row for each conv_id of ``conversations``, whose rows are damaged first.

    A digest is a running hash over a conversation, so one task reads a conversation's repaired rows, one by
    one and in order; it holds counters and the audit.
    """
    edits = repairs(damaged(conversations))
    named = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(-1).cast("bigint").alias("at"), *(F.lit(None).alias(c) for c in _ADDED)
    )
    rows = edits.select("conv_id", "at", *_ADDED).union(named)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "at")
        .mapInArrow(_digests, f"conv_id {kind}, {_REPORT}")
    )
