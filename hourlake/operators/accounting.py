"""Ingestion runs as tables: documents, attempts, outcomes and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourlake.functions.runs import failure_class, request_url, run_status
from hourlake.operators.joins import join_dimension
from hourlake.spec import DEFAULT_SPEC, HourlySpec

# Fixed value: status of every document that passed the payload check.
DOCUMENT_STATUS = "ingest_complete"
# End of fixed values.
#: Neighbouring city ids whose outcomes are listed in one row.
CITIES_PER_BLOCK = 1000


def build_documents(
    cities: DataFrame,
    payloads: DataFrame,
    endpoint: str,
    source: str,
    spec: HourlySpec = DEFAULT_SPEC,
) -> DataFrame:
    """Raw documents from accepted payloads and the city each belongs to.

    ``payloads`` has ``run_id, city_id, run_started_at_utc, ingested_at_utc, raw_payload`` and
    may have ``payload_text``, the response as it came; both go through as they are. A payload
    of a city that isn't listed keeps its id, with the rest of the city NULL.
    """
    located = cities.select("city_id", "city", "country", "latitude", "longitude")
    text = F.col("payload_text") if "payload_text" in payloads.columns else F.lit(None).cast("string")
    return join_dimension(payloads, located, "city_id", how="left").select(
        "run_id",
        F.struct(
            "city_id",
            "city",
            "country",
            F.col("latitude").alias("requested_latitude"),
            F.col("longitude").alias("requested_longitude"),
        ).alias("city"),
        F.struct(
            F.lit(endpoint).alias("endpoint"),
            _variables(spec).alias("hourly_variables"),
            F.lit(spec.timezone).alias("timezone"),
            F.lit(spec.forecast_days).alias("forecast_days"),
            F.lit(spec.past_days).alias("past_days"),
        ).alias("request"),
        F.struct(
            "run_started_at_utc",
            "ingested_at_utc",
            F.lit(source).alias("source"),
            F.lit(DOCUMENT_STATUS).alias("status"),
        ).alias("ingestion_metadata"),
        "raw_payload",
        text.alias("payload_text"),
    )


def unlisted_city_documents(documents: DataFrame) -> DataFrame:
    """Run and city of the documents whose city the dimension doesn't have."""
    return documents.filter(F.col("city.city").isNull()).select("run_id", "city.city_id")


def _variables(spec: HourlySpec) -> Column:
    return F.array(*map(F.lit, spec.metrics))


def request_urls(
    cities: DataFrame, endpoint: str, spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    url = request_url(endpoint, F.col("latitude"), F.col("longitude"), spec)
    return cities.withColumn("request_url", url)


def classify_attempts(attempts: DataFrame) -> DataFrame:
    """Add ``failure_class`` to an attempt log."""
    return attempts.withColumn(
        "failure_class", failure_class(F.col("ok"), F.col("error_kind"), F.col("http_code"))
    )


def decisive_attempts(attempts: DataFrame, *carried: str) -> DataFrame:
    """The attempt at which each city of each run stopped, with further columns of the log.

    That is the first success or final failure, or else the last attempt. Of several rows with that
    number a success counts before a failure; then the first by error kind, HTTP code, message and city
    (NULL first) does, and at last by a hash of what is carried, so that the order of the log never
    matters. The whole log is folded, whatever numbers it holds; numbers beyond the limit are for
    ``gates.check_attempt_limit`` to refuse. The aggregate keeps one attempt per city, so it
    combines on the map side whatever the length of the log.
    """
    attempt, known = F.col("attempt"), F.col("attempt").isNotNull()
    stops = F.col("failure_class") != "retryable"
    state = F.struct("attempt", "ok", "city", "error_message", *carried)
    ties = [~F.col("ok"), "error_kind", "http_code", "error_message", "city"]
    if carried:
        ties.append(F.xxhash64(*carried))
    decisive = F.coalesce(
        F.min_by(state, F.when(stops & known, F.struct(attempt, *ties))),
        F.min_by(state, F.when(known, F.struct(-attempt, *ties))),
    )
    return (
        classify_attempts(attempts)
        .groupBy("run_id", "city_id")
        .agg(decisive.alias("last"))
        .select("run_id", "city_id", "last.*")
    )


def outcomes_of(decisive: DataFrame) -> DataFrame:
    """How each city fared, from the attempts at which they stopped."""
    return decisive.select(
        "run_id",
        "city_id",
        "city",
        F.col("attempt").alias("attempts_made"),
        F.col("ok").alias("succeeded"),
        F.when(~F.col("ok"), F.col("error_message")).alias("error_message"),
    )


def city_outcomes(attempts: DataFrame) -> DataFrame:
    """How each city fared in each run: the outcome is that of the attempt it stopped at."""
    return outcomes_of(decisive_attempts(attempts))


def run_counts(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Status and counts per run; a run without any attempt is kept, with zeros.

    ``runs`` has ``run_id, run_started_at_utc, run_completed_at_utc, cities_intended``.
    """
    tally = outcomes.groupBy("run_id").agg(
        F.count_if("succeeded").alias("successful_ingestions"),
        F.count_if(~F.col("succeeded")).alias("failed_ingestions"),
    )
    counted = runs.join(tally, "run_id", "left").fillna(
        0, ["successful_ingestions", "failed_ingestions"]
    )
    status = run_status(F.col("successful_ingestions"), F.col("cities_intended"))
    return counted.select(
        "run_id",
        "run_started_at_utc",
        "run_completed_at_utc",
        status.alias("status"),
        F.col("cities_intended").cast("bigint").alias("cities_intended"),
        "successful_ingestions",
        "failed_ingestions",
    )


def run_summary(
    runs: DataFrame, outcomes: DataFrame, spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    """One row per run: times, status, counts and request; its cities are in ``run_city_lists``."""
    return run_counts(runs, outcomes).select(
        "run_id",
        "run_started_at_utc",
        "run_completed_at_utc",
        "status",
        F.struct("cities_intended", "successful_ingestions", "failed_ingestions").alias("counts"),
        F.struct(
            _variables(spec).alias("hourly_variables"),
            F.lit(spec.past_days).alias("past_days"),
            F.lit(spec.forecast_days).alias("forecast_days"),
            F.lit(spec.timezone).alias("timezone"),
        ).alias("request_config"),
    )


def run_city_lists(outcomes: DataFrame, cities_per_block: int = CITIES_PER_BLOCK) -> DataFrame:
    """Successful and failed cities of each run, one row per run and block of city ids.

    A block is ``cities_per_block`` neighbouring ids, so no list is longer than that, and the
    blocks of a run are the same however many cities it has.
    """
    tries = F.col("attempts_made").cast("int").alias("attempts_made")
    succeeded = F.struct("city_id", "city", tries)
    failed = F.struct("city_id", "city", "error_message", tries)
    block = F.floor(F.col("city_id") / cities_per_block).cast("bigint")
    return outcomes.groupBy("run_id", block.alias("block")).agg(
        _sorted_list(F.when(F.col("succeeded"), succeeded)).alias("successful_cities"),
        _sorted_list(F.when(~F.col("succeeded"), failed)).alias("failed_cities"),
    )


def _sorted_list(entry: Column) -> Column:
    """Entries by city id; collecting skips NULLs and keeps no order of its own."""
    return F.array_sort(F.collect_list(entry))


def newest_run(summaries: DataFrame) -> DataFrame:
    """The run that completed last; the run id settles equal times."""
    return summaries.orderBy(F.desc("run_completed_at_utc"), F.desc("run_id")).limit(1)


def documents_of_run(documents: DataFrame, run_id: str) -> DataFrame:
    """What one run stored; the run filter and the four fields reach the scan."""
    return documents.filter(F.col("run_id") == run_id).select(
        "run_id",
        "city.city_id",
        "city.city",
        "ingestion_metadata.ingested_at_utc",
    )


def documents_per_run(documents: DataFrame) -> DataFrame:
    return documents.groupBy("run_id").agg(F.count("*").alias("document_count"))
