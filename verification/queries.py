"""One query per operator, over the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.functions.payload import with_reject_reason
from hourlake.operators import accounting, daily, dedupe, flatten, gates, quality
from hourlake.plans.gold import build_gold
from hourlake.plans.ingestion import account_runs
from hourlake.plans.silver import (
    build_silver,
    checked_measurements,
    profile_documents,
    timed_measurements,
    update_silver,
)
from hourlake.schemas import MEASUREMENT_KEY
from hourlake.sources import readers, writers
from hourlake.spec import DEFAULT_METRICS, DEFAULT_SPEC, array_column
from verification import fixtures

Query = Callable[[SparkSession, str], DataFrame]
ARRAYS = ("time_array", *map(array_column, DEFAULT_METRICS))


def _plain(frame: DataFrame) -> DataFrame:
    """Timestamps without zone, the type other engines use for UTC wall-clock times."""
    zoned = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def _joined(array: Column, element: Callable[[Column], Column]) -> Column:
    """An array as text, to be compared across engines."""
    texts = F.transform(array, lambda x: F.coalesce(element(x), F.lit("-")))
    return F.array_join(texts, ",")


def _arrays_as_text(flat: DataFrame) -> DataFrame:
    numbers = {
        array_column(m): _joined(F.col(array_column(m)), lambda x: x.cast("bigint").cast("string"))
        for m in DEFAULT_METRICS
    }
    return flat.withColumns({"time_array": _joined(F.col("time_array"), lambda x: x), **numbers})


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_measurements(fixtures.documents(spark, sf_dir))


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.flatten_documents(fixtures.documents(spark, sf_dir))


def _latest_dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated valid rows with their date; the daily operators skip all others."""
    return daily.add_date(dedupe.latest_valid_rows(_checked(spark, sf_dir)))


def gold_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents to daily rows, in one plan."""
    timed = timed_measurements(fixtures.documents(spark, sf_dir))
    latest = quality.add_metric_flags(dedupe.latest_valid_rows(timed))
    return _plain(daily.daily_report(daily.add_date(latest), observed="unique_rows"))


# Sources and assembly


def source_profile(spark, sf_dir):
    return readers.source_profile(fixtures.table(spark, sf_dir, "events"))


def city_configuration_issues(spark, sf_dir):
    return fixtures.city_configurations(spark, sf_dir).select(
        "configuration", readers.city_configuration_issue().alias("issue")
    )


def city_dimension(spark, sf_dir):
    texts = fixtures.city_configurations(spark, sf_dir)
    return readers.parse_cities(texts.filter(readers.city_configuration_issue().isNull()))


def request_urls(spark, sf_dir):
    urls = accounting.request_urls(fixtures.cities(spark, sf_dir), fixtures.ENDPOINT)
    return urls.select("city_id", "request_url")


def raw_documents(spark, sf_dir):
    return _document_summary(fixtures.documents(spark, sf_dir))


def _document_summary(documents: DataFrame) -> DataFrame:
    hourly = "raw_payload.hourly"
    return _plain(
        documents.select(
            "run_id",
            "city.*",
            "request.endpoint",
            F.array_join("request.hourly_variables", ",").alias("hourly_variables"),
            "request.timezone",
            "request.forecast_days",
            "request.past_days",
            "ingestion_metadata.*",
            F.size(f"{hourly}.time").alias("time_count"),
            *(
                F.size(F.filter(f"{hourly}.{m}", lambda x: x.isNotNull())).alias(f"{m}_count")
                for m in DEFAULT_METRICS
            ),
        )
    )


def documents_roundtrip(spark, sf_dir):
    """Documents appended in two batches, then scanned."""
    path = f"{writers.work_folder(spark)}/documents"
    documents = fixtures.documents(spark, sf_dir)
    early = F.col("run_id") < "run-2024-01-16"
    writers.append_documents(documents.filter(early), path)
    writers.append_documents(documents.filter(~early), path)
    return _document_summary(readers.read_documents(spark, path))


def flatten_documents(spark, sf_dir):
    return _plain(_arrays_as_text(_flat(spark, sf_dir)))


def array_length_issues(spark, sf_dir):
    issues = gates.length_issues(fixtures.damaged_documents(spark, sf_dir))
    # NULL has no length, whether or not the session's size function says -1 for it.
    lengths = (
        F.when(F.col(a).isNotNull(), F.size(a)).alias(a.replace("_array", "_count"))
        for a in ARRAYS
    )
    return issues.select("run_id", "city_id", *lengths)


def zip_explode(spark, sf_dir):
    zipped = flatten.zip_arrays(_flat(spark, sf_dir))
    return _plain(flatten.project_measurements(flatten.explode_measurements(zipped)))


def zip_explode_uneven(spark, sf_dir):
    """Short arrays padded, documents with a NULL array left out."""
    zipped = flatten.zip_arrays(fixtures.damaged_documents(spark, sf_dir))
    rows = flatten.project_measurements(flatten.explode_measurements(zipped))
    return rows.groupBy("run_id", "city_id").agg(
        F.count("*").alias("row_count"),
        *(F.count(c).alias(f"{c}_count") for c in ("measurement_timestamp_raw", *DEFAULT_METRICS)),
    )


def unnest_equal_arrays(spark, sf_dir):
    return _plain(flatten.unnest_equal_arrays(_flat(spark, sf_dir)))


# Validity


def _measured(spark, sf_dir):
    return flatten.unnest_equal_arrays(_flat(spark, sf_dir))


def parse_timestamps(spark, sf_dir):
    parsed = quality.add_timestamp_flag(quality.add_timestamp(_measured(spark, sf_dir)))
    return _plain(
        parsed.select(
            "run_id",
            "city_id",
            "measurement_timestamp_raw",
            "measurement_timestamp",
            "is_valid_measurement_timestamp",
        )
    )


def metric_validity_flags(spark, sf_dir):
    flagged = quality.add_metric_flags(_measured(spark, sf_dir))
    return flagged.select(
        "run_id", "city_id", "measurement_timestamp_raw", *DEFAULT_METRICS, *DEFAULT_SPEC.flags[1:]
    )


def validity_census(spark, sf_dir):
    return quality.validity_census(_checked(spark, sf_dir))


def document_profile(spark, sf_dir):
    """Census and length issues of damaged documents, in one scan."""
    return profile_documents(fixtures.damaged_documents(spark, sf_dir))


def valid_timestamp_rows(spark, sf_dir):
    return _plain(quality.valid_timestamp_rows(_checked(spark, sf_dir)))


def invalid_timestamp_rows(spark, sf_dir):
    return _plain(quality.invalid_timestamp_rows(_checked(spark, sf_dir)))


def duplicate_keys(spark, sf_dir):
    return _plain(quality.duplicate_keys(_checked(spark, sf_dir)))


def duplicate_summary(spark, sf_dir):
    return quality.duplicate_summary(quality.duplicate_keys(_checked(spark, sf_dir)))


# Deduplication


def recency_rank(spark, sf_dir):
    """All records of every key, newest first: an hour is in one document for each day of the
    window at most."""
    window_days = DEFAULT_SPEC.past_days + DEFAULT_SPEC.forecast_days
    ranked = dedupe.rank_by_recency(_checked(spark, sf_dir), depth=window_days)
    return _plain(ranked.select("run_id", "ingested_at_utc", *MEASUREMENT_KEY, "recency_rank"))


def latest_dedupe(spark, sf_dir):
    return _plain(dedupe.latest_valid_rows(_checked(spark, sf_dir)))


def latest_with_counts(spark, sf_dir):
    return _plain(dedupe.latest_valid_rows_with_counts(_checked(spark, sf_dir)))


def silver_rows(spark, sf_dir):
    return _plain(dedupe.silver_rows(dedupe.deduplicate(_checked(spark, sf_dir))))


# Daily


def daily_rollup(spark, sf_dir):
    return daily.daily_rollup(_latest_dated(spark, sf_dir))


def daily_rollup_repeated(spark, sf_dir):
    """Rollup of rows with repeated timestamps: distinct hours differ from row counts."""
    return daily.daily_rollup(daily.add_date(_checked(spark, sf_dir)))


def daily_rollup_whole_hours(spark, sf_dir):
    """The same rollup with the hours in the bits of a number."""
    return daily.daily_rollup(daily.add_date(_checked(spark, sf_dir)), observed="whole_hours")


def daily_rollup_minutes(spark, sf_dir):
    """Rollup of timestamps off the full hour, which differ from run to run, with the day's minutes in the
    bits of numbers."""
    return daily.daily_rollup(_off_the_hour(spark, sf_dir), observed="minutes")


def _off_the_hour(spark, sf_dir):
    run_day = F.substring("run_id", 5, 10).cast("date")
    minute = (F.col("city_id") + F.datediff(run_day, F.lit(fixtures.EPOCH).cast("date"))) % 60
    moved = F.col("measurement_timestamp") + F.make_dt_interval(mins=minute)
    return daily.add_date(_checked(spark, sf_dir).withColumn("measurement_timestamp", moved))


def daily_rollup_unique(spark, sf_dir):
    return daily.daily_rollup(_latest_dated(spark, sf_dir), observed="unique_rows")


def daily_peak(spark, sf_dir):
    return _plain(daily.daily_peak(_latest_dated(spark, sf_dir)))


def daily_peak_texts(spark, sf_dir):
    """Peak times as formatted text."""
    peaks = daily.daily_peak(_latest_dated(spark, sf_dir))
    formatted = F.date_format(daily.peak_column(), "yyyy-MM-dd HH:mm:ss")
    return peaks.select("city_id", "measurement_date", formatted.alias("peak_time"))


def daily_report_repeated(spark, sf_dir):
    """Rollup and peaks of rows with repeated timestamps, in one pass."""
    return _plain(daily.daily_report(daily.add_date(_checked(spark, sf_dir))))


def daily_completeness(spark, sf_dir):
    rollup = daily.daily_rollup(_latest_dated(spark, sf_dir), observed="unique_rows")
    return rollup.select(
        "city_id",
        "measurement_date",
        "observed_hour_count",
        "expected_hour_count",
        "completeness_percentage",
        "is_complete_day",
        "is_fully_valid_day",
    )


def daily_left_join(spark, sf_dir):
    dated = _latest_dated(spark, sf_dir)
    return _plain(daily.join_peak(daily.daily_rollup(dated), daily.daily_peak(dated)))


# Gates


def stage_row_counts(spark, sf_dir):
    """The counts that the row-count gates compare, stage by stage."""
    checked = _checked(spark, sf_dir)
    stages = {
        "documents": fixtures.documents(spark, sf_dir),
        "measurements": checked,
        "silver": dedupe.deduplicate(checked),
        "gold": gold_daily_summary(spark, sf_dir),
    }
    counts = (
        stage.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, stage in stages.items()
    )
    return reduce(DataFrame.unionByName, counts)


def null_key_rows(spark, sf_dir):
    keyed = daily.add_date(_checked(spark, sf_dir))
    return gates.null_key_rows(keyed, ["city_id", "measurement_date"]).select(
        "run_id", "city_id", "measurement_timestamp_raw", "measurement_date"
    )


def duplicate_business_keys(spark, sf_dir):
    keyed = daily.add_date(_checked(spark, sf_dir))
    return gates.duplicate_business_keys(keyed, ["city_id", "measurement_date"])


def run_id_uniqueness(spark, sf_dir):
    """Run ids that occur more than once among appended summaries.

    Failed runs are appended a second time, under the same id.
    """
    runs = _run_counts(spark, sf_dir)
    appended = runs.unionByName(runs.filter("status = 'failed'"))
    return gates.duplicate_business_keys(appended, ["run_id"])


# Accounting


def payload_reject_reasons(spark, sf_dir):
    judged = with_reject_reason(fixtures.payload_texts(spark, sf_dir))
    return judged.select("run_id", "city_id", "reject_reason")


def attempt_limit_violations(spark, sf_dir):
    """Attempts beyond the limit, where a day's events are all one run's."""
    return gates.attempt_limit_violations(fixtures.attempts(spark, sf_dir, tries=None))


def attempt_classification(spark, sf_dir):
    return accounting.classify_attempts(fixtures.attempts(spark, sf_dir))


def city_outcomes(spark, sf_dir):
    return accounting.city_outcomes(fixtures.attempts(spark, sf_dir))


def _run_counts(spark, sf_dir):
    runs = fixtures.attempt_runs(spark, sf_dir)
    return accounting.run_counts(runs, city_outcomes(spark, sf_dir))


def run_status(spark, sf_dir):
    return _plain(_run_counts(spark, sf_dir))


def _run_summaries(spark, sf_dir):
    runs = fixtures.attempt_runs(spark, sf_dir)
    return accounting.run_summary(runs, city_outcomes(spark, sf_dir))


def _summary_as_text(summaries: DataFrame) -> DataFrame:
    """Run summaries with their list of variables as text, to be compared across engines."""
    return _plain(
        summaries.select(
            "run_id",
            "run_started_at_utc",
            "run_completed_at_utc",
            "status",
            "counts.*",
            F.array_join("request_config.hourly_variables", ",").alias("hourly_variables"),
            "request_config.past_days",
            "request_config.forecast_days",
            "request_config.timezone",
        )
    )


def _lists_as_text(lists: DataFrame) -> DataFrame:
    def entry(*fields: str) -> Callable[[Column], Column]:
        return lambda x: F.concat_ws(":", *(x[f].cast("string") for f in fields))

    return lists.select(
        "run_id",
        "block",
        _joined(F.col("successful_cities"), entry("city_id", "city", "attempts_made")).alias(
            "successful_cities"
        ),
        _joined(
            F.col("failed_cities"), entry("city_id", "city", "error_message", "attempts_made")
        ).alias("failed_cities"),
    )


def run_summary(spark, sf_dir):
    return _summary_as_text(_run_summaries(spark, sf_dir))


def run_summary_roundtrip(spark, sf_dir):
    path = f"{writers.work_folder(spark)}/runs"
    writers.append_run_summaries(_run_summaries(spark, sf_dir), path)
    return _summary_as_text(readers.read_run_summaries(spark, path))


def run_city_lists(spark, sf_dir):
    """Cities of each run, ten neighbouring ids in a row, written and read back."""
    path = f"{writers.work_folder(spark)}/run-cities"
    lists = accounting.run_city_lists(city_outcomes(spark, sf_dir), cities_per_block=10)
    writers.append_city_lists(lists, path)
    return _lists_as_text(readers.read_city_lists(spark, path))


def newest_run(spark, sf_dir):
    return _plain(accounting.newest_run(_run_counts(spark, sf_dir)))


def documents_of_run(spark, sf_dir):
    documents = fixtures.documents(spark, sf_dir)
    return _plain(accounting.documents_of_run(documents, "run-2024-01-15"))


def stored_documents_of_run(spark, sf_dir):
    """The same lookup in stored documents: the run's header tells which day's partition to read."""
    folder = writers.work_folder(spark)
    documents = fixtures.documents(spark, sf_dir)
    writers.append_documents(documents, f"{folder}/documents")
    header = documents.select("run_id", "ingestion_metadata.run_started_at_utc").distinct()
    counts = F.struct(*(F.lit(0).cast("bigint").alias(c) for c in (
        "cities_intended", "successful_ingestions", "failed_ingestions")))
    summaries = header.select(
        "run_id",
        "run_started_at_utc",
        F.col("run_started_at_utc").alias("run_completed_at_utc"),
        F.lit("completed").alias("status"),
        counts.alias("counts"),
    )
    writers.append_run_summaries(summaries, f"{folder}/runs")
    return _plain(
        readers.stored_documents_of_run(spark, f"{folder}/documents", f"{folder}/runs", "run-2024-01-15")
    )


def newest_stored_run(spark, sf_dir):
    """The newest run of stored summaries, of which only the newest day's are read."""
    path = f"{writers.work_folder(spark)}/runs"
    writers.append_run_summaries(_run_summaries(spark, sf_dir), path)
    return _summary_as_text(readers.newest_stored_run(spark, path))


def read_cities(spark, sf_dir):
    """City dimension out of configuration files, one list in each, through the loader and its checks."""
    path = f"{writers.work_folder(spark)}/configurations"
    texts = fixtures.city_configurations(spark, sf_dir)
    sound = texts.filter(readers.city_configuration_issue().isNull())
    # One file for each configuration.
    sound.write.partitionBy("configuration").text(path)
    return readers.read_cities(spark, path).select("city_id", "city", "country", "latitude", "longitude")


def city_outcomes_tied(spark, sf_dir):
    """Outcomes where two rows of the log share each attempt number."""
    return accounting.city_outcomes(fixtures.tied_attempts(spark, sf_dir))


def unlisted_city_documents(spark, sf_dir):
    """Documents of the cities that a dimension without every tenth city doesn't have."""
    listed = fixtures.cities(spark, sf_dir).filter("city_id % 10 <> 0")
    documents = accounting.build_documents(
        listed, fixtures.payloads(spark, sf_dir), fixtures.ENDPOINT, fixtures.SOURCE
    )
    return accounting.unlisted_city_documents(documents)


def gold_schema(spark, sf_dir):
    """Names and types of written daily rows, as the files have them."""
    path = f"{writers.work_folder(spark)}/gold"
    gold_daily_summary(spark, sf_dir).write.parquet(path)
    return readers.source_profile(spark.read.parquet(path))


def documents_per_run(spark, sf_dir):
    return accounting.documents_per_run(fixtures.documents(spark, sf_dir))


# Jobs: written to a fresh folder and read back


def _written_documents(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    writers.append_documents(fixtures.documents(spark, sf_dir), f"{folder}/documents")
    return readers.read_documents(spark, f"{folder}/documents")


def silver_roundtrip(spark, sf_dir):
    folder = writers.work_folder(spark)
    documents = _written_documents(spark, sf_dir, folder)
    build_silver(spark, documents, f"{folder}/silver")
    return _plain(readers.read_silver(spark, f"{folder}/silver"))


def silver_increments(spark, sf_dir):
    """Silver rows from three increments, two of which bring records that the third one's replace or that
    come too late to count."""
    folder = writers.work_folder(spark)
    documents = _written_documents(spark, sf_dir, folder)
    for runs in ("run_day < '2024-01-12'", "run_day > '2024-01-18'", "run_day BETWEEN '2024-01-12' AND '2024-01-18'"):
        update_silver(spark, documents.filter(runs), f"{folder}/silver")
    return _plain(readers.read_silver(spark, f"{folder}/silver"))


def gold_roundtrip(spark, sf_dir):
    folder = writers.work_folder(spark)
    documents = _written_documents(spark, sf_dir, folder)
    build_silver(spark, documents, f"{folder}/silver")
    build_gold(spark, f"{folder}/silver", f"{folder}/gold")
    return _plain(readers.read_gold(spark, f"{folder}/gold"))


def ingestion_roundtrip(spark, sf_dir):
    """Run summaries, number of stored documents and bytes of their payload texts, of the
    response log."""
    folder = writers.work_folder(spark)
    account_runs(
        spark,
        fixtures.cities(spark, sf_dir),
        fixtures.response_runs(spark, sf_dir),
        fixtures.responses(spark, sf_dir),
        f"{folder}/documents",
        f"{folder}/runs",
        f"{folder}/run-cities",
        endpoint=fixtures.ENDPOINT,
        source=fixtures.SOURCE,
    )
    documents = readers.read_documents(spark, f"{folder}/documents")
    stored = documents.groupBy("run_id").agg(
        F.count("*").alias("document_count"),
        F.sum(F.char_length("payload_text")).alias("payload_characters"),
    )
    summaries = readers.read_run_summaries(spark, f"{folder}/runs")
    return _summary_as_text(summaries).join(stored, "run_id", "left")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        gold_daily_summary,
        source_profile,
        city_configuration_issues,
        city_dimension,
        request_urls,
        raw_documents,
        documents_roundtrip,
        flatten_documents,
        array_length_issues,
        zip_explode,
        zip_explode_uneven,
        unnest_equal_arrays,
        parse_timestamps,
        metric_validity_flags,
        validity_census,
        document_profile,
        valid_timestamp_rows,
        invalid_timestamp_rows,
        duplicate_keys,
        duplicate_summary,
        recency_rank,
        latest_dedupe,
        latest_with_counts,
        silver_rows,
        daily_rollup,
        daily_rollup_repeated,
        daily_rollup_whole_hours,
        daily_rollup_minutes,
        daily_rollup_unique,
        daily_peak,
        daily_peak_texts,
        daily_report_repeated,
        daily_completeness,
        daily_left_join,
        stage_row_counts,
        null_key_rows,
        duplicate_business_keys,
        run_id_uniqueness,
        payload_reject_reasons,
        attempt_limit_violations,
        attempt_classification,
        city_outcomes,
        run_status,
        run_summary,
        run_summary_roundtrip,
        run_city_lists,
        newest_run,
        documents_of_run,
        documents_per_run,
        stored_documents_of_run,
        newest_stored_run,
        read_cities,
        city_outcomes_tied,
        unlisted_city_documents,
        silver_roundtrip,
        silver_increments,
        gold_schema,
        gold_roundtrip,
        ingestion_roundtrip,
    )
}
