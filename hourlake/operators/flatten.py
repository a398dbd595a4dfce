"""Nested documents with parallel arrays to one row per city and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourlake.spec import DEFAULT_SPEC, HourlySpec, array_column

# Where each document-level column sits in the nested document.
DOCUMENT_PATHS = {
    "run_id": "run_id",
    "city_id": "city.city_id",
    "city": "city.city",
    "country": "city.country",
    "requested_latitude": "city.requested_latitude",
    "requested_longitude": "city.requested_longitude",
    "ingested_at_utc": "ingestion_metadata.ingested_at_utc",
}
# End of fixed values.


def flatten_documents(documents: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """One flat row per document: its scalars, the time array and one array per metric.

    Only the nested fields named here are read from a columnar source.
    """
    paths = dict(DOCUMENT_PATHS, time_array="raw_payload.hourly.time")
    paths |= {array_column(m): f"raw_payload.hourly.{m}" for m in spec.metrics}
    return documents.select(*(F.col(path).alias(name) for name, path in paths.items()))


def zip_arrays(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Add ``measurement_array``: the arrays' elements paired by position.

    Short arrays are padded with NULL; if any array is NULL the result is NULL. The length
    gate exists because neither is an error here.
    """
    arrays = ("time_array", *map(array_column, spec.metrics))
    return flat.withColumn("measurement_array", F.arrays_zip(*arrays))


def explode_measurements(zipped: DataFrame) -> DataFrame:
    """One row per array position, in ``measurement``; documents without any give no rows."""
    return zipped.withColumn("measurement", F.explode("measurement_array"))


def project_measurements(exploded: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Scalar columns out of the exploded struct."""
    return exploded.select(
        *DOCUMENT_PATHS,
        F.col("measurement.time_array").alias("measurement_timestamp_raw"),
        *(F.col(f"measurement.{array_column(m)}").alias(m) for m in spec.metrics),
    )


def unnest_equal_arrays(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Zip, explode and project in one step, for documents that passed the length gate.

    Exploding only the time array and picking every reading by position gives the same rows
    when all arrays are present and equally long, and lets the optimizer drop the arrays of
    readings that nothing downstream asks for, which it cannot do inside a zipped struct.
    """
    return unnest_with_positions(flat, spec).drop("position")


def unnest_with_positions(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """``unnest_equal_arrays`` with the ``position`` of each row in its document."""
    positions = flat.select(
        "*", F.posexplode("time_array").alias("position", "measurement_timestamp_raw")
    )
    return positions.select(
        *DOCUMENT_PATHS,
        "measurement_timestamp_raw",
        *(F.get(array_column(m), F.col("position")).alias(m) for m in spec.metrics),
        "position",
    )
