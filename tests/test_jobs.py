import json
from datetime import datetime, timedelta

import pytest
from test_flatten import document, full
from pyspark.sql import functions as F

from hourlake import schemas
from hourlake.operators import dedupe
from hourlake.plans import gold, ingestion, silver
from hourlake.sources import readers, writers
from hourlake.spec import DEFAULT_METRICS

real = silver.profile_documents
HOURS = [f"2026-07-{18 + i // 24}T{i % 24:02}:00" for i in range(72)]


def documents(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.raw_document())


def complete(run_id="r1", city_id=1, hour=10, value=1.0, **changes):
    arrays = {"time": HOURS, **dict.fromkeys(DEFAULT_METRICS, [value] * 72)} | changes
    row = document(city_id, run_id, **arrays)
    row["ingestion_metadata"]["ingested_at_utc"] = datetime(2026, 7, 20, hour)
    return row


def test_silver_and_gold_jobs(spark, tmp_path):
    path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    bad_times = ["nonsense", None, *HOURS[2:]]
    raw = documents(
        spark, complete(), complete("r2", hour=11, value=2.0), complete(city_id=2, time=bad_times)
    )
    report = silver.build_silver(spark, raw, path)
    assert (report.row_count, report.duplicate_key_groups) == (144, 72)
    assert (report.redundant_rows, report.max_records_per_key) == (72, 2)
    assert sorted(r["count"] for r in report.validity_census.collect()) == [2, 214]

    stored = readers.read_silver(spark, path)
    assert stored.columns == list(schemas.silver())
    assert stored.count() == 144
    assert {r["pm10"] for r in stored.filter("city_id = 1").collect()} == {2.0}
    assert stored.filter("NOT is_valid_measurement_timestamp").count() == 2

    assert gold.build_gold(spark, path, gold_path) == 6
    days = readers.read_gold(spark, gold_path)
    assert days.columns == list(schemas.gold())
    assert [f.dataType.simpleString() for f in days.schema] == [
        k.lower() for k in schemas.gold().values()
    ]
    hours = {(r["city_id"], r["observed_hour_count"]) for r in days.collect()}
    assert hours == {(1, 24), (2, 22), (2, 24)}

    # A second run replaces both tables.
    assert silver.build_silver(spark, raw.filter("run_id = 'r2'"), path).row_count == 72
    assert gold.build_gold(spark, path, gold_path) == 3
    assert readers.read_gold(spark, gold_path).count() == 3


def test_jobs_on_no_documents(spark, tmp_path):
    path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    report = silver.build_silver(spark, documents(spark), path)
    assert (report.row_count, report.duplicate_key_groups, report.redundant_rows) == (0, 0, None)
    assert gold.build_gold(spark, path, gold_path) == 0


def test_silver_job_stops_at_the_length_gate(spark, tmp_path):
    path = tmp_path / "silver"
    with pytest.raises(RuntimeError, match="Issues found in 1 source array-length records."):
        silver.build_silver(spark, documents(spark, complete(), full(pm10=[1.0])), str(path))
    assert not path.exists()


def test_silver_without_invalid_rows_scans_once(spark, tmp_path):
    report = silver.build_silver(spark, documents(spark, complete()), str(tmp_path / "silver"))
    assert report.row_count == 72
    assert [r["count"] for r in report.validity_census.collect()] == [72]


def test_silver_rows_come_from_one_scan_and_one_shuffle(spark, tmp_path):
    """Valid rows and those set aside, of stored documents, where both kinds are there."""
    raw = documents(spark, complete(), complete(city_id=2, time=["nonsense", *HOURS[1:]]))
    writers.append_documents(raw, str(tmp_path / "documents"))
    stored = readers.read_documents(spark, str(tmp_path / "documents"))
    plan = silver.deduplicated_measurements(stored)._jdf.queryExecution().optimizedPlan().toString()
    physical = silver.deduplicated_measurements(stored)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Relation [") == 1
    assert "Union" not in plan and "Join" not in plan
    assert physical.count("FileScan") == 1


def test_rows_set_aside_keep_their_copies(spark, tmp_path):
    """A document stored twice has its invalid rows twice, and equal ones within a document stay apart."""
    bad = ["nonsense", None, None, *HOURS[3:]]
    raw = documents(spark, complete(time=bad), complete(time=bad), complete("r2", hour=11, time=bad))
    report = silver.build_silver(spark, raw, str(tmp_path / "silver"))
    stored = readers.read_silver(spark, str(tmp_path / "silver"))
    assert stored.filter("NOT is_valid_measurement_timestamp").count() == 9
    assert (report.row_count, report.max_records_per_key, report.redundant_rows) == (78, 3, 138)
    wanted = dedupe.silver_rows(dedupe.deduplicate(silver.checked_measurements(raw)))
    assert sorted(map(str, stored.collect())) == sorted(map(str, wanted.collect()))


def test_increments_equal_a_rebuild_and_read_only_their_days(spark, tmp_path):
    def shifted(row, days):
        hours = [datetime.fromisoformat(t) + timedelta(days=days) for t in HOURS]
        row["raw_payload"]["hourly"]["time"] = [f"{t:%Y-%m-%dT%H:%M}" for t in hours]
        return row

    bad = ["nonsense", *HOURS[1:]]
    first = [shifted(complete("r1", hour=1), 0), shifted(complete("r2", hour=2, value=2.0), 1), complete("r0", time=bad)]
    second = [shifted(complete("r3", hour=3, value=3.0), 3), shifted(complete("r0", hour=0, value=9.0), 1)]
    path, whole = str(tmp_path / "days"), str(tmp_path / "whole")
    silver.update_silver(spark, documents(spark, *first), path, batch="one")
    before = readers.silver_days(spark, path)
    assert sorted(before) == ["aside-one", *(f"day-2026-07-{d}" for d in (18, 19, 20, 21))]
    report = silver.update_silver(spark, documents(spark, *second), path, batch="two")
    after = readers.silver_days(spark, path)
    # The day that the second increment has no rows of is neither read nor written.
    assert {k for k in before if before[k] == after[k]} == {"aside-one", "day-2026-07-18"}
    assert report.row_count == 120
    # Started again, an increment changes nothing.
    silver.update_silver(spark, documents(spark, *first), path, batch="one")
    silver.build_silver(spark, documents(spark, *first, *second), whole)
    wanted = readers.read_silver(spark, whole).collect()
    assert sorted(map(str, readers.read_silver(spark, path).collect())) == sorted(map(str, wanted))
    with pytest.raises(ValueError, match="replaced as a whole"):
        silver.update_silver(spark, documents(spark, *first), whole)
    with pytest.raises(RuntimeError, match="length records"):
        silver.update_silver(spark, documents(spark, full(pm10=[1.0])), path)
    assert gold.build_gold(spark, path, str(tmp_path / "gold")) == 6


def test_source_that_grows_after_the_gate_is_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    grown = documents(spark, complete(), complete("r2", hour=11, time=[*HOURS, "2026-07-21T00:00"]))
    monkeypatch.setattr(
        silver, "profile_documents", lambda flat, spec: real(flat.filter("run_id = 'r1'"), spec)
    )
    with pytest.raises(
        RuntimeError, match="Silver source row-count validation failed: expected 72, found 145"
    ):
        silver.build_silver(spark, grown, path)
    with pytest.raises(FileNotFoundError, match="nothing has been published"):
        readers.read_silver(spark, path)


def test_gold_counts_distinct_timestamps_off_the_full_hour(spark, tmp_path):
    path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    half = [t.replace(":00", ":30") if i % 2 else t for i, t in enumerate(HOURS)]
    silver.build_silver(spark, documents(spark, complete(), complete("r2", time=half)), path)
    gold.build_gold(spark, path, gold_path)
    assert {r["observed_hour_count"] for r in readers.read_gold(spark, gold_path).collect()} == {36}


def test_gold_job_rejects_null_cities_and_keeps_the_old_table(spark, tmp_path):
    path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    silver.build_silver(spark, documents(spark, complete()), path)
    gold.build_gold(spark, path, gold_path)
    silver.build_silver(spark, documents(spark, complete(city_id=None)), path)
    with pytest.raises(RuntimeError, match="Gold read-back contains 3 rows with null business keys"):
        gold.build_gold(spark, path, gold_path)
    assert {r["city_id"] for r in readers.read_gold(spark, gold_path).collect()} == {1}


RESPONSE = """run_id STRING, city_id INT, city STRING, attempt INT, error_kind STRING,
    http_code INT, error_message STRING, payload STRING, run_started_at_utc TIMESTAMP,
    ingested_at_utc TIMESTAMP"""


def test_ingestion_job(spark, tmp_path, monkeypatch):
    stored, summaries, lists = (str(tmp_path / n) for n in ("documents", "runs", "cities"))
    start = datetime(2034, 8, 1, 4)
    good = {"hourly": {"time": HOURS, **{m: [1] * 72 for m in DEFAULT_METRICS}}}
    extra = json.dumps({"latitude": 4.5} | good | {"hourly_units": {"pm10": "x"}})
    bad_element = json.loads(json.dumps(good))
    bad_element["hourly"]["pm10"][:2] = ["n/a", 2.5]
    repeated = json.dumps(good)[:-1] + ', "hourly": ' + json.dumps(bad_element["hourly"]) + "}"

    def response(city_id, attempt, kind=None, code=None, payload=None):
        message = kind and f"{kind} {attempt}"
        return ("r1", city_id, f"city {city_id}", attempt, kind, code, message, payload, start, start)

    log = spark.createDataFrame(
        [
            response(1, 1, "network"),
            response(1, 2, payload=extra),
            response(2, 1, payload='{"error": true, "reason": "limit"}'),
            response(3, 1, "http", 404),
            # An answer after a final failure, and a second one after the first.
            response(3, 2, payload=json.dumps(good)),
            response(4, 1, payload=json.dumps(bad_element)),
            response(4, 2, payload=json.dumps(good)),
            response(5, 1, payload=repeated),
            response(9, 1, payload=json.dumps(good)),
        ],
        RESPONSE,
    )
    cities = spark.createDataFrame(
        [(i, f"city {i}", "x", 1.0, 2.0) for i in (1, 2, 3, 4, 5)], schemas.CITY
    )
    runs = spark.range(1).select(
        F.lit("r1").alias("run_id"),
        F.lit(start).alias("run_started_at_utc"),
        F.lit(start).alias("run_completed_at_utc"),
        F.lit(6).alias("cities_intended"),
    )

    def account(responses=log, of=runs):
        endpoint = "https://feed.example"
        ingestion.account_runs(
            spark, cities, of, responses, stored, summaries, lists, endpoint, source="feed"
        )

    zone = spark.conf.get("spark.sql.session.timeZone")
    with pytest.raises(RuntimeError, match="1 logged attempts are beyond the limit"):
        account(log.union(log.limit(1).withColumn("attempt", F.lit(4))))

    # Documents of other origin don't matter to the job.
    writers.append_documents(documents(spark), stored)

    # Lost after the documents were written, then after they were published: nothing is stored twice.
    for lost in ("write", "publish"):
        with monkeypatch.context() as patch:
            real_step = getattr(writers.Batch, lost)

            def step(batch, *rest, real_step=real_step, **options):
                if batch.path != stored:
                    raise KeyboardInterrupt
                return real_step(batch, *rest, **options)

            patch.setattr(writers.Batch, lost, step)
            with pytest.raises(KeyboardInterrupt):
                account()
        if lost == "write":
            assert readers.read_documents(spark, stored).count() == 0
    with pytest.raises(RuntimeError, match="were interrupted; start their runs again first"):
        account(of=runs.withColumn("run_id", F.lit("r2")))
    account()
    assert spark.conf.get("spark.sql.session.timeZone") == zone
    documents_read = readers.read_documents(spark, stored)
    found = {r["city"]["city_id"]: r for r in documents_read.collect()}
    assert documents_read.count() == len(found)
    assert found.keys() == {1, 4, 5, 9}
    assert found[1]["payload_text"] == extra
    assert found[9]["city"]["city"] is None
    for city_id in (4, 5):
        assert found[city_id]["raw_payload"]["hourly"]["pm10"][:3] == [None, 2.5, 1.0]
    summary = readers.read_run_summaries(spark, summaries).first()
    assert (summary["status"], *summary["counts"]) == ("partial_failure", 6, 4, 2)
    row = readers.read_city_lists(spark, lists).first()
    assert [(c["city_id"], c["attempts_made"]) for c in row["successful_cities"]] == [
        (1, 2), (4, 1), (5, 1), (9, 1),
    ]
    assert [(c["city_id"], c["error_message"]) for c in row["failed_cities"]] == [
        (2, "API returned an error: limit"),
        (3, "http 1"),
    ]
    assert silver.build_silver(spark, documents_read, str(tmp_path / "silver")).row_count == 288

    with pytest.raises(RuntimeError, match="Run summaries contains 1 duplicate key groups"):
        account()
    assert readers.read_documents(spark, stored).count() == 4

    # Lookups read the partition of the run's day.
    lookup = readers.stored_documents_of_run(spark, stored, summaries, "r1")
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_day" in plan or "PartitionFilters: [(run_day" in plan
    assert sorted(r["city_id"] for r in lookup.collect()) == [1, 4, 5, 9]
    assert readers.stored_documents_of_run(spark, stored, summaries, "r9").collect() == []
    newest = readers.newest_stored_run(spark, summaries)
    assert "completed_day" in newest._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]
    assert [r["run_id"] for r in newest.collect()] == ["r1"]
