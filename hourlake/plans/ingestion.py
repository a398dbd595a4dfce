"""Ingestion accounting job: logged responses to raw documents and run summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions.payload import with_parsed_payload
from hourlake.operators import gates
from hourlake.operators.accounting import (
    build_documents,
    decisive_attempts,
    outcomes_of,
    run_city_lists,
    run_summary,
)
from hourlake.sources.publish import live_folders
from hourlake.sources.readers import read_run_summaries
from hourlake.sources.session import utc_session
from hourlake.sources.writers import Batch, document_batch, summary_batch, work_folder
from hourlake.spec import DEFAULT_SPEC, HourlySpec


#: How the keys of this job's batches begin; documents that were added in another way have others.
BATCH = "runs-"


def judge_responses(responses: DataFrame, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Attempt log out of a response log.

    ``responses`` has ``run_id, city_id, city, attempt, error_kind, http_code, error_message,
    payload``. An attempt without an error kind brought a payload, and succeeded if the
    payload passes the structure check; else it is a validation failure. ``raw_payload`` is
    what the check's parse found in it.
    """
    answered = F.col("error_kind").isNull()
    reason, message, kind = map(F.col, ("reject_reason", "error_message", "error_kind"))
    refused = answered & reason.isNotNull()
    return (
        with_parsed_payload(responses, "payload", spec)
        .withColumns(
            {
                "ok": answered & reason.isNull(),
                "error_message": F.when(refused, reason).otherwise(message),
                "error_kind": F.when(refused, "validation").otherwise(kind),
            }
        )
        .drop("reject_reason")
    )


def accepted_documents(
    cities: DataFrame,
    decisive: DataFrame,
    endpoint: str,
    source: str,
    spec: HourlySpec = DEFAULT_SPEC,
) -> DataFrame:
    """Raw documents of the cities whose decisive attempt succeeded: one for each, with the response's text."""
    accepted = decisive.filter("ok").drop("city").withColumnRenamed("payload", "payload_text")
    return build_documents(cities, accepted, endpoint, source, spec)


def account_runs(
    spark: SparkSession,
    cities: DataFrame,
    runs: DataFrame,
    responses: DataFrame,
    documents_path: str,
    summaries_path: str,
    city_lists_path: str,
    endpoint: str,
    source: str,
    spec: HourlySpec = DEFAULT_SPEC,
) -> None:
    """Append the documents, city lists and run summaries of the logged runs, once.

    The log is judged once: the attempt at which each city stopped goes to the work folder, and
    everything is made from there. Run ids must be new and attempt numbers within the limit,
    which is checked before anything is written. Documents of unlisted cities are stored like
    any other, and refused by ``gates.check_listed_cities`` where that is wanted.

    Rows are written to folders that nobody reads, and published when all are there: documents, lists, and
    summaries last, each under a key made of the run ids. A job that failed at any point is started again as
    it was: what it had published is replaced by the same, what it had only written counts for nothing. Runs
    of a batch that was interrupted between its publications have to be started again before others.
    """
    with utc_session(spark, spec.timezone):
        key = batch_key(runs)
        summarised = live_folders(spark, summaries_path)
        run_ids = runs.select("run_id")
        if summarised:
            known = read_run_summaries(spark, summaries_path)
            run_ids = run_ids.unionByName(known.select("run_id"))
        gates.check_no_duplicate_keys(run_ids, ["run_id"], "Run summaries")
        gates.check_attempt_limit(responses, spec)
        stored = {k for k in live_folders(spark, documents_path) if k.startswith(BATCH)}
        if open_batches := sorted(stored - summarised.keys() - {key}):
            raise RuntimeError(f"batches {open_batches} were interrupted; start their runs again first")

        carried = ("payload", "raw_payload", "run_started_at_utc", "ingested_at_utc")
        judged = decisive_attempts(judge_responses(responses, spec), *carried)
        staged = f"{work_folder(spark)}/decisive"
        judged.write.parquet(staged)
        decisive = spark.read.schema(judged.schema).parquet(staged)
        outcomes = outcomes_of(decisive)
        batches = [
            document_batch(accepted_documents(cities, decisive, endpoint, source, spec), documents_path, key),
            Batch(city_lists_path, key).write(run_city_lists(outcomes)),
            summary_batch(run_summary(runs, outcomes, spec), summaries_path, key),
        ]
        for batch in batches:
            batch.publish(spark)


def batch_key(runs: DataFrame) -> str:
    """A key for the batch of a set of runs, the same in whatever order they come."""
    two = (F.xxhash64("run_id"), F.xxhash64(F.lit("second"), "run_id"))
    sums = runs.agg(F.count("*"), *(F.coalesce(F.bit_xor(h), F.lit(0)) for h in two)).first()
    return BATCH + "-".join(f"{n % 2**64:x}" for n in sums)
