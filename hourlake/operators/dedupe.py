"""Latest record per measurement key.

All forms combine on the map side before the shuffle, so one key with a huge number of
copies sends at most one row per map task to the task that owns it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake import schemas
from hourlake.operators.quality import invalid_timestamp_rows, valid_timestamp_rows
from hourlake.schemas import MEASUREMENT_KEY
from hourlake.spec import DEFAULT_SPEC, HourlySpec


def rank_by_recency(checked: DataFrame, depth: int) -> DataFrame:
    """The ``depth`` newest valid rows of every key, numbered; ``run_id`` settles equal times.

    Rank and filter sit together so that the planner limits each key's rows before as well as
    after the shuffle. A ranking without a depth would sort all of a key's copies in one task.
    """
    newest_first = Window.partitionBy(*MEASUREMENT_KEY).orderBy(
        F.desc("ingested_at_utc"), F.desc("run_id")
    )
    ranked = valid_timestamp_rows(checked).withColumn(
        "recency_rank", F.row_number().over(newest_first)
    )
    return ranked.filter(F.col("recency_rank") <= depth)


def latest_valid_rows(checked: DataFrame) -> DataFrame:
    """The newest row of every key."""
    return rank_by_recency(checked, depth=1).drop("recency_rank")


def latest_valid_rows_with_counts(checked: DataFrame) -> DataFrame:
    """``latest_valid_rows`` plus ``record_count``, the rows each key had, in one pass."""
    carried = [c for c in checked.columns if c not in MEASUREMENT_KEY]
    recency = F.struct("ingested_at_utc", "run_id")
    return (
        valid_timestamp_rows(checked)
        .groupBy(*MEASUREMENT_KEY)
        .agg(
            F.max_by(F.struct(*carried), recency).alias("latest"),
            F.count("*").alias("record_count"),
        )
        .select(
            *(c if c in MEASUREMENT_KEY else F.col(f"latest.{c}") for c in checked.columns),
            "record_count",
        )
    )


def deduplicate(checked: DataFrame) -> DataFrame:
    """Newest valid row per key, and every row whose timestamp is invalid.

    Invalid rows stay out of the ranking: they share a NULL timestamp, so ranking would
    gather all of a city's bad rows in one task.
    """
    return latest_valid_rows(checked).unionByName(invalid_timestamp_rows(checked))


def latest_and_set_aside(checked: DataFrame) -> DataFrame:
    """The rows of ``deduplicate`` from one scan and one shuffle, with ``record_count``.

    ``checked`` has the ``position`` of each row in its document. A row without a valid timestamp has all its
    columns and its position as a further part of the key, so that it stands alone; where whole documents
    are repeated its equals are counted and told apart again after the shuffle. Valid rows have no such
    part, and one of each key is left, with the number there was.
    """
    valid, extra = "is_valid_measurement_timestamp", ("position", "is_valid_measurement_timestamp")
    carried = [c for c in checked.columns if c not in (*MEASUREMENT_KEY, *extra)]
    recency = F.struct("ingested_at_utc", "run_id")
    alone = F.when(~F.col(valid), F.struct(*carried, "position"))
    is_valid = F.col("set_aside").isNull()
    rows = (
        checked.withColumn("set_aside", alone)
        .groupBy(*MEASUREMENT_KEY, "set_aside")
        .agg(
            F.max_by(F.struct(*carried), F.when(is_valid, recency)).alias("latest"),
            F.count("*").alias("record_count"),
        )
    )

    def column(name: str) -> Column:
        return F.coalesce(f"latest.{name}", f"set_aside.{name}").alias(name) if name in carried else F.col(name)

    copies = F.when(is_valid, 1).otherwise(F.col("record_count"))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies))).select(
        *(column(c) for c in checked.columns if c not in extra),
        is_valid.alias(valid),
        F.when(is_valid, F.col("record_count")).alias("record_count"),
    )


def latest_and_set_aside_by_city(checked: DataFrame) -> DataFrame:
    """The rows of ``latest_and_set_aside`` where a city's rows are in one task already: sorted once, and neither
    combined nor shuffled.

    Of a key the last row in order of recency is left, and its number is how many there were. Positions part the
    rows without a valid timestamp, of which all are left.
    """
    valid = F.col("is_valid_measurement_timestamp")
    oldest_first = Window.partitionBy(*MEASUREMENT_KEY, "set_aside").orderBy("ingested_at_utc", "run_id")
    numbered = checked.withColumn("set_aside", F.when(~valid, F.col("position"))).withColumns(
        {
            "record_count": F.row_number().over(oldest_first),
            "has_newer": F.lead(F.lit(True)).over(oldest_first),
        }
    )
    carried = [c for c in checked.columns if c not in ("position", "is_valid_measurement_timestamp")]
    return numbered.filter(F.col("has_newer").isNull() | ~valid).select(
        *carried, valid, F.when(valid, F.col("record_count")).cast("bigint").alias("record_count")
    )


def silver_rows(deduplicated: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """The persisted columns in their fixed order."""
    return deduplicated.select(*schemas.silver(spec))
