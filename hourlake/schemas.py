"""Explicit column types and orders, as DDL. Nothing is inferred from the data."""

from __future__ import annotations

from hourlake.spec import DEFAULT_SPEC, HourlySpec

MEASUREMENT_KEY = ("city_id", "measurement_timestamp")
DAILY_KEY = ("city_id", "measurement_date")

CITY = "city_id INT, city STRING, country STRING, latitude DOUBLE, longitude DOUBLE"

RUN_SUMMARY = """
    run_id STRING, run_started_at_utc TIMESTAMP, run_completed_at_utc TIMESTAMP,
    status STRING,
    counts STRUCT<cities_intended: BIGINT, successful_ingestions: BIGINT,
                  failed_ingestions: BIGINT>,
    request_config STRUCT<hourly_variables: ARRAY<STRING>, past_days: INT,
                          forecast_days: INT, timezone: STRING>
"""

RUN_CITIES = """
    run_id STRING, block BIGINT,
    successful_cities ARRAY<STRUCT<city_id: INT, city: STRING, attempts_made: INT>>,
    failed_cities ARRAY<STRUCT<city_id: INT, city: STRING, error_message: STRING,
                               attempts_made: INT>>
"""


def payload(spec: HourlySpec = DEFAULT_SPEC) -> str:
    """The part of a payload that is read; metrics are doubles even where JSON has ints."""
    arrays = ", ".join(f"`{m}`: ARRAY<DOUBLE>" for m in spec.metrics)
    return f"STRUCT<hourly: STRUCT<time: ARRAY<STRING>, {arrays}>>"


def payload_texts(spec: HourlySpec = DEFAULT_SPEC) -> str:
    """The same part with its readings as texts, to be cast one by one."""
    return payload(spec).replace("ARRAY<DOUBLE>", "ARRAY<STRING>")


def raw_document(spec: HourlySpec = DEFAULT_SPEC) -> str:
    """One nested document per city and run."""
    return f"""
        run_id STRING,
        city STRUCT<city_id: INT, city: STRING, country: STRING,
                    requested_latitude: DOUBLE, requested_longitude: DOUBLE>,
        request STRUCT<endpoint: STRING, hourly_variables: ARRAY<STRING>, timezone: STRING,
                       forecast_days: INT, past_days: INT>,
        ingestion_metadata STRUCT<run_started_at_utc: TIMESTAMP, ingested_at_utc: TIMESTAMP,
                                  source: STRING, status: STRING>,
        raw_payload {payload(spec)},
        payload_text STRING
    """


def silver(spec: HourlySpec = DEFAULT_SPEC) -> dict[str, str]:
    """Columns and types of measurement rows, in on-disk order."""
    return {
        "run_id": "STRING",
        "ingested_at_utc": "TIMESTAMP",
        "city_id": "INT",
        "city": "STRING",
        "country": "STRING",
        "requested_latitude": "DOUBLE",
        "requested_longitude": "DOUBLE",
        "measurement_timestamp": "TIMESTAMP",
        "measurement_timestamp_raw": "STRING",
        **dict.fromkeys(spec.metrics, "DOUBLE"),
        **dict.fromkeys(spec.flags, "BOOLEAN"),
    }


def gold(spec: HourlySpec = DEFAULT_SPEC) -> dict[str, str]:
    """Columns and types of daily rows, in on-disk order."""
    return {
        "city_id": "INT",
        "measurement_date": "DATE",
        "city": "STRING",
        **{f"{name}_{m}": "DOUBLE" for m in spec.metrics for name in ("average", "maximum")},
        "observed_hour_count": "BIGINT",
        **{f"valid_daily_{m}_count": "BIGINT" for m in spec.metrics},
        "expected_hour_count": "INT",
        "completeness_percentage": "DOUBLE",
        "is_complete_day": "BOOLEAN",
        "is_fully_valid_day": "BOOLEAN",
        f"maximum_{spec.peak_metric}_timestamp": "TIMESTAMP",
    }


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
