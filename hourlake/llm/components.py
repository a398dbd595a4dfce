"""Connected components by alternating large-star and small-star steps over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.llm.tables import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its larger neighbours the smallest one it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    handed = both.join(least, "a").where(F.col("b") > F.col("a"))
    return handed.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex hands its smaller neighbours, and takes itself, the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    handed = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), "m")
    return handed.union(least).select("a", F.col("m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``vertex``, ``component``) of every vertex with an edge that is not the smallest of its
    component; ``edges`` has vertices ``a`` and ``b``. Loops are ignored.

    Only a count and a sum of hashes reach the driver. Edges of a vertex that a third of all edges
    share are combined before their shuffle, and their join can be split.
    """
    ordered = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current, before = stored(ordered.distinct(), "edges"), None
    while True:
        sign = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if sign == before or not sign[0]:
            return current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        before = sign
        current = stored(_small_star(_large_star(current)), "edges")
