"""Joining a dimension to a table that grows without bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_ROW_BYTES = 64


def dimension_bytes(dimension: DataFrame) -> int:
    """About how much memory a flat dimension takes: its texts, and a flat rate per row."""
    texts = [name for name, kind in dimension.dtypes if kind == "string"]
    widths = (F.coalesce(F.octet_length(F.col(t)), F.lit(0)) for t in texts)
    row_bytes = sum(widths, F.lit(FIXED_ROW_BYTES))
    return dimension.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0]


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    limit: int = BROADCAST_BYTES,
    how: str = "inner",
) -> DataFrame:
    """Inner or left join that measures the dimension before broadcasting it.

    The planner must not choose freely: after arrays are built or unnested its size estimate
    for the facts can be far too low, and it would then broadcast those. Up to ``limit`` bytes
    the dimension is broadcast and the facts stay where they are. Beyond it both sides are
    shuffled for a merge join, where adaptive execution splits the partition of a hot key.
    """
    if dimension_bytes(dimension) <= limit:
        return facts.join(F.broadcast(dimension), key, how)
    return facts.hint("merge").join(dimension, key, how)
