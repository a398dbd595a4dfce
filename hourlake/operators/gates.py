"""Data-quality gates.

Each rule comes as a DataFrame of what breaks it and as a check that raises. The checks fetch
counts only; ``check_keyed_table`` answers row count, NULL keys and duplicate keys together
from one aggregate over one scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.functions.validity import any_null, has_length_issue
from hourlake.operators.quality import duplicate_keys
from hourlake.spec import DEFAULT_SPEC, HourlySpec

# What the gates say, compared by callers.
LENGTH_ISSUES = "Issues found in {count} source array-length records."
ROW_COUNTS_DIFFER = "{label} row-count validation failed: expected {expected}, found {actual}"
SCHEMAS_DIFFER = "{label} schema does not match the written DataFrame"
NO_KEY_COLUMNS = "key_columns cannot be empty"
NULL_KEYS = "{label} contains {count} rows with null business keys"
DUPLICATE_KEYS = "{label} contains {count} duplicate key groups"
# End of fixed values.


def length_issues(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Flattened documents whose arrays are absent, uneven or of the wrong length."""
    return flat.filter(has_length_issue(spec))


def require_no_length_issues(issue_count: int) -> None:
    if issue_count > 0:
        raise RuntimeError(LENGTH_ISSUES.format(count=issue_count))


def check_lengths(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> None:
    require_no_length_issues(length_issues(flat, spec).count())


def null_key_rows(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    _require_keys(keys)
    return frame.filter(any_null(keys))


def check_no_null_keys(frame: DataFrame, keys: Sequence[str], label: str) -> None:
    _require_no_null_keys(null_key_rows(frame, keys).count(), label)


def duplicate_business_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows; NULLs count as equal."""
    _require_keys(keys)
    return frame.groupBy(*keys).count().filter("count > 1")


def check_no_duplicate_keys(frame: DataFrame, keys: Sequence[str], label: str) -> None:
    _require_no_duplicates(duplicate_business_keys(frame, keys).count(), label)


def check_no_duplicate_measurements(checked: DataFrame, label: str) -> None:
    """No two valid-timestamp rows share a city and timestamp."""
    _require_no_duplicates(duplicate_keys(checked).count(), label)


def check_row_counts(expected: int, actual: int, label: str) -> None:
    if expected != actual:
        raise RuntimeError(ROW_COUNTS_DIFFER.format(label=label, expected=expected, actual=actual))


def check_schema(expected: DataFrame, actual: DataFrame, label: str) -> None:
    """Same column names and types in the same order; nullability is ignored."""

    def columns(frame: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in frame.schema.fields]

    if columns(expected) != columns(actual):
        raise RuntimeError(SCHEMAS_DIFFER.format(label=label))


def check_keyed_table(
    frame: DataFrame,
    keys: Sequence[str],
    label: str,
    expected_rows: int,
    unique_where: Column | None = None,
) -> None:
    """Row count, NULL keys and duplicate keys of a written table, in one job.

    With ``unique_where``, which may use further columns, keys need to be unique only among
    the rows it holds for, and NULL keys are let through. Rows are counted per key before the
    shuffle, so neither a hot key nor a mass of NULL keys ends up in one task.
    """
    _require_keys(keys)
    held = F.lit(True) if unique_where is None else unique_where
    per_key = frame.groupBy(*keys, held.alias("held")).agg(F.count("*").alias("n"))
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(any_null(keys), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("held") & (F.col("n") > 1)).alias("duplicates"),
    ).first()
    check_row_counts(expected_rows, found["rows"], label)
    if unique_where is None:
        _require_no_null_keys(found["null_keys"], label)
    _require_no_duplicates(found["duplicates"], label)


def _require_keys(keys: Sequence[str]) -> None:
    if not keys:
        raise ValueError(NO_KEY_COLUMNS)


def _require_no_null_keys(count: int, label: str) -> None:
    if count > 0:
        raise RuntimeError(NULL_KEYS.format(label=label, count=count))


def _require_no_duplicates(count: int, label: str) -> None:
    if count > 0:
        raise RuntimeError(DUPLICATE_KEYS.format(label=label, count=count))


def attempt_limit_violations(attempts: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Attempts whose number is missing, or not between one and the limit."""
    number = F.col("attempt")
    allowed = number.between(1, spec.max_attempts)
    return attempts.filter(~F.coalesce(allowed, F.lit(False))).select("run_id", "city_id", "attempt")


def check_attempt_limit(attempts: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> None:
    count = attempt_limit_violations(attempts, spec).count()
    if count:
        raise RuntimeError(f"{count} logged attempts are beyond the limit of {spec.max_attempts}.")


def check_listed_cities(documents: DataFrame) -> None:
    count = documents.filter(F.col("city.city").isNull()).count()
    if count:
        raise RuntimeError(f"{count} documents are of cities that are not listed.")
