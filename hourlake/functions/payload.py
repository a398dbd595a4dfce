"""Structure check of raw JSON payloads, as one column expression."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.sources.session import setting
from hourlake.spec import DEFAULT_SPEC, HourlySpec

# One text per rule, compared by callers.
NOT_AN_OBJECT = "API response must be a dictionary"
API_ERROR = "API returned an error: "
UNKNOWN_API_ERROR = "Unknown API error"
NO_HOURLY_SECTION = "API response does not contain a valid hourly section"
NO_TIME_LIST = "hourly.time must be a non-empty list"
MISSING_VARIABLES = "Missing hourly variables: "
# End of fixed values.


def _object(parsed: Column, path: str) -> Column:
    """The JSON object at the path as a map, NULL where there is something else."""
    return F.try_variant_get(parsed, path, "map<string,variant>")


def _length(parsed: Column, path: str) -> Column:
    """Length of the JSON list at the path, NULL where there is something else."""
    return F.array_size(F.try_variant_get(parsed, path, "array<variant>"))


def _texts(parsed: Column, path: str) -> Column:
    """The JSON list at the path with its elements as texts."""
    return F.try_variant_get(parsed, path, "array<string>")


def _path(metric: str) -> str:
    quote = '"' if '"' not in metric else "'"
    if quote in metric:
        raise ValueError(f"metric {metric!r} has both kinds of quotes")
    return f"$.hourly[{quote}{metric}{quote}]"


def _is_true(parsed: Column, path: str) -> Column:
    """Whether the value is JSON ``true``; the text "true" is not."""
    value = F.try_variant_get(parsed, path, "variant")
    return (F.schema_of_variant(value) == "BOOLEAN") & F.try_variant_get(parsed, path, "boolean")


def _error_text(parsed: Column) -> Column:
    value = F.try_variant_get(parsed, "$.reason", "variant")
    given = (
        F.when(value.isNull(), F.lit(UNKNOWN_API_ERROR))
        .when(F.is_variant_null(value), F.lit("None"))
        .when(F.schema_of_variant(value) == "BOOLEAN", F.initcap(value.cast("string")))
        .otherwise(F.coalesce(F.try_variant_get(parsed, "$.reason", "string"), F.to_json(value)))
    )
    return F.concat(F.lit(API_ERROR), given)


def with_parsed_payload(
    payloads: DataFrame, payload: str = "payload", spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    """Add ``reject_reason``, the first rule the JSON text breaks, NULL when it is accepted; and
    ``raw_payload``, the part that is read, NULL where the text is refused.

    The text is parsed once per row. Text that is not JSON at all counts as "not an object"; of a
    repeated key the last value counts. What isn't a number is a missing reading.

    The rules go by the lists' lengths, so that no list is copied for them. A list found below
    ``hourly`` shows that there are objects above it, so those are looked at only where a list is missing.
    """
    parsed, times = F.col("parsed_payload"), F.col("time_length")
    lengths = {m: F.col(f"length_{i}") for i, m in enumerate(spec.metrics)}

    def missing(metric: str) -> Column:
        there = F.try_variant_get(parsed, _path(metric), "variant").isNotNull()
        return lengths[metric].isNull() & ~there

    names = F.concat_ws("', '", *(F.when(missing(m), F.lit(m)) for m in sorted(spec.metrics)))
    reason = (
        F.when(times.isNull() & _object(parsed, "$").isNull(), F.lit(NOT_AN_OBJECT))
        .when(_is_true(parsed, "$.error"), _error_text(parsed))
        .when(times.isNull() & _object(parsed, "$.hourly").isNull(), F.lit(NO_HOURLY_SECTION))
        .when(times.isNull() | (times == 0), F.lit(NO_TIME_LIST))
        .when(
            reduce(or_, (missing(m) for m in spec.metrics)),
            F.concat(F.lit(MISSING_VARIABLES), F.lit("['"), names, F.lit("']")),
        )
    )

    def variable_rules(chain: Column, metric: str) -> Column:
        length = lengths[metric]
        uneven = F.concat(
            F.lit(f"Hourly variable '{metric}' has "),
            length.cast("string"),
            F.lit(" values; expected "),
            times.cast("string"),
        )
        return chain.when(length.isNull(), F.lit(f"Hourly variable '{metric}' must be a list")).when(
            length != times, uneven
        )

    readings = (
        F.transform(_texts(parsed, _path(m)), lambda x: x.try_cast("double")).alias(m) for m in spec.metrics
    )
    typed = F.struct(F.struct(_texts(parsed, "$.hourly.time").alias("time"), *readings).alias("hourly"))
    # The setting is read when the expression is resolved, which is at once.
    with setting(payloads.sparkSession, "spark.sql.variant.allowDuplicateKeys", "true"):
        with_parsed = payloads.withColumn("parsed_payload", F.try_parse_json(payload))
    return (
        with_parsed.withColumns(
            {"time_length": _length(parsed, "$.hourly.time")}
            | {f"length_{i}": _length(parsed, _path(m)) for i, m in enumerate(spec.metrics)}
        )
        .withColumn("reject_reason", reduce(variable_rules, spec.metrics, reason))
        .withColumn("raw_payload", F.when(F.col("reject_reason").isNull(), typed))
        .drop("parsed_payload", "time_length", *(f"length_{i}" for i in range(len(lengths))))
    )


def with_reject_reason(
    payloads: DataFrame, payload: str = "payload", spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    """``with_parsed_payload`` without what the parse found."""
    return with_parsed_payload(payloads, payload, spec).drop("raw_payload")
