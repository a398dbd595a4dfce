"""Column expressions for timestamps, readings, keys and array lengths."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourlake.spec import DEFAULT_SPEC, TIMESTAMP_FORMAT, HourlySpec, array_column

# Texts in the default format with a plain four-digit year, and every text that its parser
# could accept: it also takes a lower-case separator and signed, longer years.
PLAIN_TIMESTAMP = r"^[1-9]\d{3}-\d\d-\d\dT\d\d:\d\d\z"
POSSIBLE_TIMESTAMP = r"^[+-]?\d{4,19}-\d\d-\d\d[Tt]\d\d:\d\d\z"


def parsed_timestamp(raw: Column, spec: HourlySpec = DEFAULT_SPEC) -> Column:
    """Text to timestamp; anything that does not fit the format is NULL, never an error.

    Parsing by pattern is the costliest expression per row, and each text it refuses costs an
    exception inside. Plain texts are therefore cast, and hopeless ones never reach the parser;
    the result is the parser's in every case.
    """
    by_pattern = F.try_to_timestamp(raw, F.lit(spec.timestamp_format))
    if spec.timestamp_format != TIMESTAMP_FORMAT:
        return by_pattern
    return F.when(raw.rlike(PLAIN_TIMESTAMP), raw.try_cast("timestamp")).when(
        raw.rlike(POSSIBLE_TIMESTAMP), by_pattern
    )


def timestamp_is_valid(raw: Column, parsed: Column) -> Column:
    return raw.isNotNull() & parsed.isNotNull()


def reading_is_valid(reading: Column, spec: HourlySpec = DEFAULT_SPEC) -> Column:
    """TRUE for a present, non-negative reading, else FALSE; never NULL."""
    valid = F.coalesce(reading >= 0, F.lit(False))
    return valid & ~F.isnan(reading) if spec.reject_nan else valid


def any_null(columns: Iterable[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns))


def all_true(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions)


def has_length_issue(spec: HourlySpec = DEFAULT_SPEC) -> Column:
    """TRUE where a flattened document's arrays are absent, uneven or of the wrong length.

    An array that is NULL has no length, which null-safe comparison counts as a mismatch, so
    comparing every array with the expected length covers all the rules at once.
    """
    expected = F.lit(spec.expected_length)
    arrays = ("time_array", *map(array_column, spec.metrics))
    return ~all_true(F.size(a).eqNullSafe(expected) for a in arrays)
