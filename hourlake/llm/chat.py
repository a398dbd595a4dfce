"""Chat formatting: logged snapshots of growing conversations are collapsed, then rendered.

Many logs hold a conversation once per turn, each time with all turns so far. The hash of the first
k turns is a running combination of the hashes of the turns; a conversation whose whole hash is the
hash of the first k turns of a longer one is a snapshot of it. An anti-join drops the snapshots,
and what is left is rendered. Built-in functions only.

One id may hold a third of all rows. Turns are ordered by a range partitioning, which cuts such a
conversation where its rows differ, and numbered by their place in a partition; no window holds more than
``CHUNK`` rows of a conversation, whatever their turn numbers are: hashes run within chunks of counted rows,
and the chunks' totals, one row for each, are combined.

Cases: turns are ordered by number; equal numbers by role, then text; null first. Repeated rows stay, one
after the other. Rows without a conv_id belong to no conversation and are left out. A null role is rendered
as ``unknown``, a null text as nothing; a text that holds an end mark is rendered as it is. An empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake.llm.tables import stored

#: Rows of a chunk, a power of two.
CHUNK = 4096
#: Bits of a row's number in its partition, as Spark makes such ids.
ROW_BITS = 33
#: Turns in one row of rendered text.
PART = 1024


def _hashes(*columns: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: 128 bits together."""
    return F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns, F.lit(7))


def ordered(turns: DataFrame) -> DataFrame:
    """conv_id, ``at`` (rising along each conversation, without gaps in a partition), role, text."""
    rows = turns.where(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text")
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64)]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select(
        "conv_id", F.monotonically_increasing_id().alias("at"), "role", "text"
    )


def _onto(rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    renamed = found.withColumnsRenamed({k: f"other_{k}" for k in keys})
    on = [rows[k] == renamed[f"other_{k}"] for k in keys]
    return rows.join(renamed, on).drop(*(f"other_{k}" for k in keys))


def numbered(rows: DataFrame) -> DataFrame:
    """Ordered rows with ``place``, their place in the conversation from 1 on, its ``n_turns``, and ``chunk``."""
    part = F.shiftright("at", ROW_BITS)
    rows = rows.withColumn("part", part).withColumn("chunk", F.floor(F.col("at") / CHUNK))
    sizes = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # A row for each partition that a conversation has rows in.
    along = Window.partitionBy("conv_id").orderBy("part")
    before = F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(
        "conv_id",
        "part",
        (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    return _onto(rows, sizes, ["conv_id", "part"]).select(
        "conv_id", "chunk", (F.col("at") + F.col("shift")).alias("place"), "n_turns", "role", "text"
    )


def prefixes(places: DataFrame) -> DataFrame:
    """Per turn: conv_id, ``place``, ``n_turns``, and the hashes ``a``, ``b`` of all turns up to it.

    A turn's hash covers its place, so that exclusive or combines them in order; running values
    start from those of the chunks before.
    """
    a, b = _hashes("place", "role", F.col("role").isNull(), "text", F.col("text").isNull())
    turns = places.select("conv_id", "chunk", "place", "n_turns", a.alias("a"), b.alias("b"))
    chunk = Window.partitionBy("conv_id", "chunk")
    so_far = chunk.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = turns.select(
        "conv_id", "chunk", "place", "n_turns", *(F.bit_xor(x).over(so_far).alias(x) for x in "ab")
    )
    totals = turns.groupBy("conv_id", "chunk").agg(F.bit_xor("a").alias("a0"), F.bit_xor("b").alias("b0"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "conv_id", "chunk", *(F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(x) for x in ("a0", "b0"))
    )
    return _onto(inside, totals, ["conv_id", "chunk"]).select(
        "conv_id", "place", "n_turns", *(F.col(x).bitwiseXOR(F.col(f"{x}0")).alias(x) for x in "ab")
    )


def maximal(rows: DataFrame) -> DataFrame:
    """conv_id, ``n_turns`` and ``n_logged`` of the conversations that no longer one begins with.

    ``n_logged`` counts how often the very same conversation was logged; the smallest id stays.
    """
    whole = rows.where(F.col("place") == F.col("n_turns")).groupBy("place", "a", "b").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logged")
    )
    # Each proper beginning once, however many conversations share it.
    begun = rows.where(F.col("place") < F.col("n_turns")).select("place", "a", "b").distinct()
    return whole.join(begun, ["place", "a", "b"], "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "n_logged"
    )


def rendered(places: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen conversations as text, ``PART`` turns in a row: role marks, turns, end marks."""
    line = F.concat(
        F.lit("<|"),
        F.coalesce("role", F.lit("unknown")),
        F.lit("|>\n"),
        F.coalesce("text", F.lit("")),
        F.lit("<|end|>\n"),
    )
    part = F.floor((F.col("place") - 1) / PART).alias("part")
    turns = places.drop("n_turns").join(chosen, "conv_id").select(
        "conv_id", "n_turns", "n_logged", part, "place", line.alias("line")
    )
    lines = F.array_sort(F.collect_list(F.struct("place", "line")))
    return turns.groupBy("conv_id", "n_turns", "n_logged", "part").agg(
        F.array_join(F.transform(lines, lambda x: x["line"]), "").alias("rendered")
    )


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """One row per part of a maximal conversation: conv_id, part, n_turns, n_logged, rendered."""
    places = stored(numbered(stored(ordered(turns), "chat-order")), "chat-turns")
    chosen = maximal(stored(prefixes(places), "chat-hashes"))
    return rendered(places, chosen).select("conv_id", "part", "n_turns", "n_logged", "rendered")
