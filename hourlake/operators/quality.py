"""Validity columns and the reports drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.functions.validity import parsed_timestamp, reading_is_valid, timestamp_is_valid
from hourlake.schemas import MEASUREMENT_KEY
from hourlake.spec import DEFAULT_SPEC, HourlySpec, flag

# The columns of the duplicate reports.
RECORD_COUNT = "record_count"
DUPLICATE_KEY_GROUPS, REDUNDANT_ROWS = "duplicate_key_groups", "redundant_rows"
MAX_RECORDS_PER_KEY = "max_records_per_key"
# End of fixed values.


def add_timestamp(measurements: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    return measurements.withColumn(
        "measurement_timestamp", parsed_timestamp(F.col("measurement_timestamp_raw"), spec)
    )


def add_timestamp_flag(measurements: DataFrame) -> DataFrame:
    return measurements.withColumn(
        "is_valid_measurement_timestamp",
        timestamp_is_valid(F.col("measurement_timestamp_raw"), F.col("measurement_timestamp")),
    )


def add_metric_flags(measurements: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    return measurements.withColumns(
        {flag(m): reading_is_valid(F.col(m), spec) for m in spec.metrics}
    )


def add_validity(measurements: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Parsed timestamp plus every validity flag."""
    return (
        measurements.transform(add_timestamp, spec)
        .transform(add_timestamp_flag)
        .transform(add_metric_flags, spec)
    )


def valid_timestamp_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("is_valid_measurement_timestamp")


def invalid_timestamp_rows(checked: DataFrame) -> DataFrame:
    """Rows set aside for inspection: never deduplicated, never aggregated."""
    return checked.filter("NOT is_valid_measurement_timestamp")


def validity_census(checked: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Row count per combination of flags: at most 2 ** (metrics + 1) rows."""
    return checked.groupBy(*spec.flags).count()


def duplicate_keys(checked: DataFrame) -> DataFrame:
    """Measurement keys held by more than one valid-timestamp row."""
    return (
        valid_timestamp_rows(checked)
        .groupBy(*MEASUREMENT_KEY)
        .agg(F.count("*").alias(RECORD_COUNT))
        .filter(F.col(RECORD_COUNT) > 1)
    )


def duplicate_summary(duplicates: DataFrame) -> DataFrame:
    """One row: duplicated keys, rows beyond one per key, largest group (NULLs if none)."""
    return duplicates.agg(
        F.count("*").alias(DUPLICATE_KEY_GROUPS),
        F.sum(F.col(RECORD_COUNT) - 1).alias(REDUNDANT_ROWS),
        F.max(RECORD_COUNT).alias(MAX_RECORDS_PER_KEY),
    )
