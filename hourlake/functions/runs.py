"""Column expressions for ingestion runs and requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hourlake.spec import DEFAULT_SPEC, HourlySpec


def failure_class(ok: Column, error_kind: Column, http_code: Column) -> Column:
    """``success``, ``retryable`` or ``final`` for one attempt.

    Worth retrying are network errors and HTTP 429 and 5xx. Every other HTTP status, and
    validation, storage and unexpected errors, end the attempts.
    """
    busy_or_broken = (http_code == 429) | http_code.between(500, 599)
    retryable = (error_kind == "network") | ((error_kind == "http") & busy_or_broken)
    return (
        F.when(ok, "success").when(F.coalesce(retryable, F.lit(False)), "retryable")
    ).otherwise("final")


def run_status(successful: Column, intended: Column) -> Column:
    """All cities (also none of none), some, or none."""
    return (
        F.when(successful == intended, "completed")
        .when(successful > 0, "partial_failure")
        .otherwise("failed")
    )


def coordinate_text(value: Column) -> Column:
    """Decimal text of a coordinate; casting alone gives tiny values an exponent."""
    plain = F.rtrim(value.cast("decimal(38,18)").cast("string"), F.lit("0"))
    tiny = (F.abs(value) < 0.001) & (value != 0)
    return F.when(tiny, plain).otherwise(value.cast("string"))


def request_url(
    endpoint: str, latitude: Column, longitude: Column, spec: HourlySpec = DEFAULT_SPEC
) -> Column:
    """Request URL of one city, with every value percent-encoded."""
    parameters = {
        "latitude": coordinate_text(latitude),
        "longitude": coordinate_text(longitude),
        "hourly": F.lit(",".join(spec.metrics)),
        "timezone": F.lit(spec.timezone),
        "forecast_days": F.lit(str(spec.forecast_days)),
        "past_days": F.lit(str(spec.past_days)),
    }
    pairs = (F.concat(F.lit(f"{k}="), F.url_encode(v)) for k, v in parameters.items())
    return F.concat(F.lit(f"{endpoint}?"), F.concat_ws("&", *pairs))
