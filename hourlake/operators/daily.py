"""Daily statistics, completeness and peak time per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourlake import schemas
from hourlake.functions.validity import all_true
from hourlake.operators.quality import valid_timestamp_rows
from hourlake.schemas import DAILY_KEY
from hourlake.spec import DEFAULT_SPEC, HourlySpec, flag


#: Bits for 25.6 hours of minutes, 64 in a number.
MINUTE_WORDS = 24


def add_date(silver: DataFrame) -> DataFrame:
    return silver.withColumn("measurement_date", F.to_date("measurement_timestamp"))


def valid_reading(metric: str) -> Column:
    """The reading, or NULL where its flag is not set."""
    return F.when(F.col(flag(metric)), F.col(metric))


def peak_column(spec: HourlySpec = DEFAULT_SPEC) -> str:
    return f"maximum_{spec.peak_metric}_timestamp"


def _observed_hours(method: str) -> Column:
    """Number of distinct timestamps in a day.

    ``distinct`` holds for any input, at the price of a second shuffle. ``unique_rows`` is for
    rows that are unique per city and timestamp, such as deduplicated ones. ``minutes`` is for
    timestamps on the full minute, which is all that a format without seconds can say: a day's minutes
    are the bits of ``MINUTE_WORDS`` numbers, so one shuffle does. ``whole_hours`` is for timestamps on
    the full hour in UTC, whose hours fit in the bits of one number.
    """
    timestamp = F.col("measurement_timestamp")
    if method == "distinct":
        return F.count_distinct(timestamp)
    if method == "unique_rows":
        return F.count(timestamp)
    if method == "minutes":
        # The day's first moment in the session's zone, so that a day of 25 hours has 1,500 minutes.
        midnight = F.unix_micros(F.col("measurement_date").cast("timestamp"))
        minute = F.floor((F.unix_micros(timestamp) - midnight) / 60_000_000)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (minute % 64).cast("int"))
        word = F.floor(minute / 64)
        seen = (F.bit_count(F.bit_or(F.when(word == i, bit))) for i in range(MINUTE_WORDS))
        return sum((F.coalesce(n, F.lit(0)) for n in seen), F.lit(0)).cast("bigint")
    if method == "whole_hours":
        seen = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.hour(timestamp)))
        return F.bit_count(seen).cast("bigint")
    raise ValueError(f"unknown method {method!r}")


def counting_method(spec: HourlySpec = DEFAULT_SPEC) -> str:
    """How to count the observed timestamps of a feed: by minutes, unless its format has seconds."""
    return "distinct" if set("sSAnN") & set(_pattern_letters(spec.timestamp_format)) else "minutes"


def _pattern_letters(pattern: str) -> str:
    """A datetime pattern without its quoted texts."""
    return "".join(pattern.split("'")[::2])


def _statistics(spec: HourlySpec, observed: str) -> list[Column]:
    return [
        # A city id with several names would make "first" depend on row order; min does not.
        F.min("city").alias("city"),
        *(
            statistic(valid_reading(m)).alias(f"{name}_{m}")
            for m in spec.metrics
            for name, statistic in (("average", F.avg), ("maximum", F.max))
        ),
        _observed_hours(observed).alias("observed_hour_count"),
        *(F.count_if(F.col(flag(m))).alias(f"valid_daily_{m}_count") for m in spec.metrics),
    ]


def _peak_timestamp(spec: HourlySpec) -> Column:
    """Timestamp of the largest valid reading, the earliest one on a tie.

    The order is NULL for rows without a valid reading, and ``max_by`` skips those; an
    unconditional struct would never be NULL.
    """
    earliness = -F.unix_micros("measurement_timestamp")
    order = F.when(F.col(flag(spec.peak_metric)), F.struct(F.col(spec.peak_metric), earliness))
    return F.max_by("measurement_timestamp", order).alias(peak_column(spec))


def add_completeness(daily: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Expected hours, percentage observed and the two whole-day flags."""
    expected = F.lit(spec.hours_per_day)
    observed = F.col("observed_hour_count")
    counts = [observed, *(F.col(f"valid_daily_{m}_count") for m in spec.metrics)]
    return daily.withColumns(
        {
            "expected_hour_count": expected,
            "completeness_percentage": observed / expected * 100,
            "is_complete_day": observed == expected,
            "is_fully_valid_day": all_true(n == expected for n in counts),
        }
    )


def daily_rollup(
    dated: DataFrame, spec: HourlySpec = DEFAULT_SPEC, observed: str = "distinct"
) -> DataFrame:
    """One row per city and day with statistics over valid readings.

    Observed hours are distinct timestamps, counted by the method in ``observed``.
    """
    return (
        valid_timestamp_rows(dated)
        .groupBy(*DAILY_KEY)
        .agg(*_statistics(spec, observed))
        .transform(add_completeness, spec)
    )


def daily_peak(dated: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Time of the day's largest valid reading; days without one have no row."""
    largest_first = Window.partitionBy(*DAILY_KEY).orderBy(
        F.desc(spec.peak_metric), F.asc("measurement_timestamp")
    )
    return (
        valid_timestamp_rows(dated)
        .filter(flag(spec.peak_metric))
        .withColumn("peak_rank", F.row_number().over(largest_first))
        .filter("peak_rank = 1")
        .select(*DAILY_KEY, F.col("measurement_timestamp").alias(peak_column(spec)))
    )


def join_peak(rollup: DataFrame, peak: DataFrame) -> DataFrame:
    """Every rollup row, with its peak time where there is one."""
    return rollup.join(peak, list(DAILY_KEY), "left")


def daily_report(
    dated: DataFrame, spec: HourlySpec = DEFAULT_SPEC, observed: str = "distinct"
) -> DataFrame:
    """``join_peak(daily_rollup, daily_peak)`` from one scan and one aggregate, no join.

    Only a day whose city is NULL differs: joining on a NULL key finds no match, so the peak
    is cleared there to give the same rows.
    """
    peak = F.when(F.col("city_id").isNotNull(), F.col(peak_column(spec)))
    return (
        valid_timestamp_rows(dated)
        .groupBy(*DAILY_KEY)
        .agg(*_statistics(spec, observed), _peak_timestamp(spec))
        .transform(add_completeness, spec)
        .withColumn(peak_column(spec), peak)
        .select(*schemas.gold(spec))
    )
