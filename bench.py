"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores). ``value`` is the total of the
named queries, each the best of BENCH_REPEATS runs. ``documents`` derives the documents from
the events; they are also stored once, and the operators read them from there as they would
read ingested documents. ``end_to_end`` goes from events to daily rows in one plan.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourlake.functions.payload import with_reject_reason
from hourlake.operators import accounting, daily, dedupe, flatten, quality
from hourlake.plans.gold import build_gold
from hourlake.plans.silver import build_silver, checked_measurements, profile_documents
from hourlake.sources import readers, writers
from verification import fixtures
from verification.queries import gold_daily_summary

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(result: DataFrame | None) -> None:
    """Compute every row and column without keeping them; jobs have run already."""
    if isinstance(result, DataFrame):
        result.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    folder = writers.work_folder(spark)
    seconds: dict[str, float] = {}

    def timed(name: str, query: Callable[[], DataFrame | None], repeats: int = REPEATS) -> None:
        best = float("inf")
        for _ in range(repeats):
            started = time.perf_counter()
            run(query())
            best = min(best, time.perf_counter() - started)
        seconds[name] = round(best, 3)

    # Warm up code generation and the file cache, then measure.
    run(accounting.documents_per_run(fixtures.documents(spark, SF_DIR)))
    writers.append_documents(fixtures.documents(spark, SF_DIR), f"{folder}/documents")
    timed("documents", lambda: fixtures.documents(spark, SF_DIR))
    documents = readers.read_documents(spark, f"{folder}/documents")
    flat = flatten.flatten_documents(documents)
    checked = checked_measurements(documents)

    timed("end_to_end", lambda: gold_daily_summary(spark, SF_DIR))
    timed("silver_job", lambda: build_silver(spark, documents, f"{folder}/silver") and None)
    timed("gold_job", lambda: build_gold(spark, f"{folder}/silver", f"{folder}/gold") and None)
    dated = daily.add_date(readers.read_silver(spark, f"{folder}/silver"))

    timed("zip_explode", lambda: flatten.project_measurements(
        flatten.explode_measurements(flatten.zip_arrays(flat))))
    timed("unnest_equal_arrays", lambda: flatten.unnest_equal_arrays(flat))
    timed("checked_measurements", lambda: checked)
    timed("document_profile", lambda: profile_documents(flat))
    timed("duplicate_summary", lambda: quality.duplicate_summary(quality.duplicate_keys(checked)))
    timed("latest_dedupe", lambda: dedupe.latest_valid_rows(checked))
    timed("latest_with_counts", lambda: dedupe.latest_valid_rows_with_counts(checked))
    timed("silver_rows", lambda: dedupe.silver_rows(dedupe.deduplicate(checked)))
    timed("daily_rollup_distinct", lambda: daily.daily_rollup(dated))
    timed("daily_rollup_whole_hours", lambda: daily.daily_rollup(dated, observed="whole_hours"))
    timed("daily_rollup_unique", lambda: daily.daily_rollup(dated, observed="unique_rows"))
    timed("daily_peak", lambda: daily.daily_peak(dated))
    timed("daily_left_join", lambda: daily.join_peak(
        daily.daily_rollup(dated), daily.daily_peak(dated)))
    timed("daily_report_distinct", lambda: daily.daily_report(dated))
    timed("daily_report_whole_hours", lambda: daily.daily_report(dated, observed="whole_hours"))
    timed("payload_reject_reasons", lambda: with_reject_reason(
        fixtures.payload_texts(spark, SF_DIR)).drop("payload"))
    timed("city_outcomes", lambda: accounting.city_outcomes(fixtures.attempts(spark, SF_DIR)))
    timed("run_summary", lambda: accounting.run_summary(
        fixtures.attempt_runs(spark, SF_DIR),
        accounting.city_outcomes(fixtures.attempts(spark, SF_DIR))))

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
