"""Silver job: raw documents to validated, deduplicated measurement rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from hourlake.functions.validity import has_length_issue
from hourlake.operators import gates
from hourlake.operators.dedupe import latest_and_set_aside, latest_and_set_aside_by_city, silver_rows
from hourlake.operators.flatten import flatten_documents, unnest_equal_arrays, unnest_with_positions
from hourlake.operators.quality import (
    add_metric_flags,
    add_timestamp,
    add_timestamp_flag,
    add_validity,
)
from hourlake.schemas import MEASUREMENT_KEY
from hourlake.sources.publish import live_folders, publish
from hourlake.sources.readers import (
    DAY_COLUMN,
    NO_DAY,
    partition_values,
    read_silver,
    read_silver_days,
    silver_days,
)
from hourlake.sources.session import utc_session
from hourlake.sources.writers import WHOLE, Batch, replace_table, work_folder
from hourlake.spec import DEFAULT_SPEC, HourlySpec, array_column

#: Documents whose rows are deduplicated by one task; a city with several times as many is not dealt out whole.
DOCUMENTS_PER_TASK = 10_000
DOCUMENTS_PER_CITY = 4 * DOCUMENTS_PER_TASK


@dataclass(frozen=True)
class SilverReport:
    row_count: int
    #: Rows per combination of flags, as a table.
    validity_census: DataFrame
    duplicate_key_groups: int
    redundant_rows: int | None
    max_records_per_key: int | None


def timed_measurements(documents: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Measurement rows with parsed timestamps, from documents that passed the length gate."""
    return (
        documents.transform(flatten_documents, spec)
        .transform(unnest_equal_arrays, spec)
        .transform(add_timestamp, spec)
        .transform(add_timestamp_flag)
    )


def positioned_measurements(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Measurement rows of flattened documents, with parsed timestamps and the place of each row in its document."""
    return (
        flat.transform(unnest_with_positions, spec)
        .transform(add_timestamp, spec)
        .transform(add_timestamp_flag)
    )


def city_tasks(flat: DataFrame, stored_rows: int, spec: HourlySpec = DEFAULT_SPEC) -> int | None:
    """How many tasks to deal flattened documents out to by city, or None where a city has too many for one.

    Reads the city ids only.
    """
    per_city = flat.groupBy("city_id").count()
    total, largest = per_city.agg(F.coalesce(F.sum("count"), F.lit(0)), F.max("count")).first()
    if (largest or 0) > DOCUMENTS_PER_CITY:
        return None
    documents = total + stored_rows // spec.expected_length
    return max(flat.sparkSession.sparkContext.defaultParallelism, -(-documents // DOCUMENTS_PER_TASK))


def deduplicated_measurements(
    documents: DataFrame,
    spec: HourlySpec = DEFAULT_SPEC,
    stored: DataFrame | None = None,
    stored_rows: int = 0,
) -> DataFrame:
    """Silver rows with ``record_count``, out of documents that passed the length gate: one scan of the
    documents and one shuffle, and one of the ``stored`` Silver rows that they are merged with.

    Documents are dealt out by city before they become rows: they are a fraction of the size of their rows, no
    task gets more as the tables grow, and the rows are sorted once. Where one city has a large part
    of the documents, rows are shuffled in place of documents, after a combination on the map side.

    Flags of readings follow from the readings, so they need not go through the shuffle.
    """
    flat = flatten_documents(documents, spec)
    tasks = city_tasks(flat, stored_rows, spec)

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition(tasks, "city_id") if tasks else frame

    rows = flat.transform(dealt).transform(positioned_measurements, spec)
    if stored is not None:
        # Rows of a table have no place in a document; there are no two of one key.
        kept = stored.withColumn("position", F.lit(-1)).select(*rows.columns)
        rows = rows.unionByName(dealt(kept))
    latest = latest_and_set_aside_by_city if tasks else latest_and_set_aside
    return rows.transform(latest).transform(add_metric_flags, spec)


def checked_measurements(documents: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Measurement rows with all validity columns."""
    return documents.transform(timed_measurements, spec).transform(add_metric_flags, spec)


def profile_documents(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Validity census and length gate in one scan.

    One row per combination of flags: ``count`` measurements have it, and ``length_issues``
    documents, which are left unexploded, are counted with it.
    """
    return _census(flat, spec.flags, spec)


def profile_documents_by_day(flat: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """``profile_documents`` with a row for each day of the measurements, ``measurement_day``, and flags."""
    return _census(flat, (DAY_COLUMN, *spec.flags), spec)


def _census(flat: DataFrame, keys: Sequence[str], spec: HourlySpec) -> DataFrame:
    issue = F.col("has_issue")
    slots = flat.withColumn("has_issue", has_length_issue(spec)).select(
        "has_issue",
        *map(array_column, spec.metrics),
        F.posexplode_outer(F.when(~issue, F.col("time_array"))).alias(
            "position", "measurement_timestamp_raw"
        ),
    )
    readings = (F.get(array_column(m), F.col("position")).alias(m) for m in spec.metrics)
    return (
        slots.select("has_issue", "measurement_timestamp_raw", *readings)
        .transform(add_validity, spec)
        .withColumn(DAY_COLUMN, F.to_date("measurement_timestamp"))
        .groupBy(*keys)
        .agg(
            F.count_if(~issue).alias("count"),
            F.count_if(issue).alias("length_issues"),
        )
    )


def build_silver(
    spark: SparkSession, documents: DataFrame, path: str, spec: HourlySpec = DEFAULT_SPEC
) -> SilverReport:
    """Replace the Silver table at ``path`` with what ``documents`` hold; the session's own time
    zone is restored afterwards."""
    with utc_session(spark, spec.timezone):
        return _build_silver(spark, documents, path, spec)


def _build_silver(
    spark: SparkSession, documents: DataFrame, path: str, spec: HourlySpec
) -> SilverReport:
    """Replace the Silver table at ``path`` with what ``documents`` hold.

    Pass one scans the arrays only and settles the length gate and the census. Pass two
    deduplicates and sets rows without a valid timestamp aside, counting rows and duplicates on the way
    to the new files. Then the keys are read back, and row count and uniqueness checked, before the
    table is replaced. The counts of pass two are taken after the last shuffle, where a lost executor
    cannot make Spark count a row twice. They also have to add up to the census: a source that
    changed in between would have got past the length gate.
    """
    profile, sums = _gated_profile(spark, profile_documents(flatten_documents(documents, spec), spec), spec)
    rows, written = _observed(deduplicated_measurements(documents, spec))

    def check(staging: str) -> None:
        for kind in ("valid", "set_aside"):
            gates.check_row_counts(sums[kind], written.get[kind], "Silver source")
        gates.check_keyed_table(
            read_silver(spark, staging, spec),
            MEASUREMENT_KEY,
            "Written Silver",
            written.get["row_count"],
            unique_where=F.col("is_valid_measurement_timestamp"),
        )

    replace_table(silver_rows(rows, spec), path, check)
    return _report(profile, written)


def _gated_profile(spark: SparkSession, profiled: DataFrame, spec: HourlySpec) -> tuple[DataFrame, Row]:
    """A profile of documents as a stored table, and how many rows are valid and set aside; raises where documents
    fail the length gate."""
    census = f"{work_folder(spark)}/census"
    profiled.write.parquet(census)
    profile = spark.read.parquet(census)
    is_valid, count = F.col("is_valid_measurement_timestamp"), F.col("count")
    sums = profile.agg(
        F.coalesce(F.sum("length_issues"), F.lit(0)).alias("issues"),
        F.coalesce(F.sum(F.when(is_valid, count)), F.lit(0)).alias("valid"),
        F.coalesce(F.sum(F.when(~is_valid, count)), F.lit(0)).alias("set_aside"),
    ).first()
    gates.require_no_length_issues(sums["issues"])
    return profile.filter("count > 0").drop("length_issues"), sums


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows``, counted on the way to their files."""
    copies = F.col("record_count")
    duplicated = F.when(copies > 1, copies)
    written = Observation()
    observed = rows.observe(
        written,
        F.count("*").alias("row_count"),
        F.count_if(copies.isNull()).alias("set_aside"),
        F.coalesce(F.sum(copies), F.lit(0)).alias("valid"),
        F.count(duplicated).alias("duplicate_key_groups"),
        F.sum(duplicated - 1).alias("redundant_rows"),
        F.max(duplicated).alias("max_records_per_key"),
    )
    return observed, written


def _report(census: DataFrame, written: Observation) -> SilverReport:
    return SilverReport(
        row_count=written.get["row_count"],
        validity_census=census,
        duplicate_key_groups=written.get["duplicate_key_groups"],
        redundant_rows=written.get["redundant_rows"],
        max_records_per_key=written.get["max_records_per_key"],
    )


def update_silver(
    spark: SparkSession,
    documents: DataFrame,
    path: str,
    spec: HourlySpec = DEFAULT_SPEC,
    batch: str | None = None,
) -> SilverReport:
    """Merge new documents into a Silver table kept by day; its first increment makes the table.

    Only the days that the documents have valid rows of are read and written anew: of each key the newest
    record counts, whether it came with this increment or an earlier one, so any order of increments ends in
    the same table as one rebuild. Rows without a valid timestamp are added, once for each ``batch``: an
    increment that failed, or whose success wasn't noticed, is started again with the same name. All days
    change at once.
    """
    with utc_session(spark, spec.timezone):
        return _update_silver(spark, documents, path, spec, batch or uuid.uuid4().hex)


def _update_silver(
    spark: SparkSession, documents: DataFrame, path: str, spec: HourlySpec, batch: str
) -> SilverReport:
    if WHOLE in live_folders(spark, path):
        raise ValueError(f"{path} is replaced as a whole; keep increments in a table of their own")
    profile, sums = _gated_profile(
        spark, profile_documents_by_day(flatten_documents(documents, spec), spec), spec
    )
    day = F.to_date("measurement_timestamp")
    # A few days for each run of the increment.
    days = profile.select(F.col(DAY_COLUMN).cast("string")).distinct().collect()
    kept = silver_days(spark, path)
    affected = [kept[f"day-{d}"] for (d,) in days if f"day-{d}" in kept]
    stored = read_silver_days(spark, path, affected, spec)
    stored_rows = stored.count()
    rows, written = _observed(deduplicated_measurements(documents, spec, stored, stored_rows))
    new = Batch(path, batch).write(silver_rows(rows, spec).withColumn(DAY_COLUMN, day), DAY_COLUMN)

    gates.check_row_counts(sums["valid"] + stored_rows, written.get["valid"], "Silver source")
    gates.check_row_counts(sums["set_aside"], written.get["set_aside"], "Silver source")
    gates.check_keyed_table(
        read_silver(spark, new.folder, spec),
        MEASUREMENT_KEY,
        "Written Silver",
        written.get["row_count"],
        unique_where=F.col("is_valid_measurement_timestamp"),
    )
    found = partition_values(spark, new.folder, DAY_COLUMN)
    keys = {f"aside-{batch}" if d == NO_DAY else f"day-{d}" for d in found}
    publish(spark, path, dict.fromkeys(keys, new.folder))
    census = profile.groupBy(*spec.flags).agg(F.sum("count").alias("count"))
    return _report(census, written)
