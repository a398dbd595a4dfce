"""Silver rows of documents dealt out by city: the rows that combination on the map side gives, with one sort."""

import pytest
from test_jobs import HOURS, complete, documents

from hourlake.operators import dedupe
from hourlake.operators.flatten import flatten_documents
from hourlake.plans import silver
from hourlake.sources import readers, writers


def _raw(spark):
    bad = ["nonsense", None, None, HOURS[5], *HOURS[4:]]
    rows = [complete(f"r{run}", city_id=city, hour=hour, value=float(run), time=time)
            for run, hour, time in ((1, 9, bad), (2, 9, HOURS), (3, 8, bad), (3, 8, bad)) for city in (1, 2, None)]
    rows[4]["ingestion_metadata"]["ingested_at_utc"] = None
    return documents(spark, *rows)


def _texts(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_by_city_equals_combined_rows(spark):
    rows = silver.positioned_measurements(flatten_documents(_raw(spark)))
    by_city = dedupe.latest_and_set_aside_by_city(rows)
    combined = dedupe.latest_and_set_aside(rows)
    assert by_city.columns == combined.columns and by_city.dtypes == combined.dtypes
    assert _texts(by_city) == _texts(combined)


def test_documents_are_dealt_out_and_rows_sorted_once(spark, tmp_path, monkeypatch):
    """One task for so many documents, whatever their number; rows are neither shuffled nor sorted again."""
    monkeypatch.setattr(silver, "DOCUMENTS_PER_TASK", 1)
    writers.append_documents(_raw(spark), str(tmp_path / "documents"))
    stored = readers.read_documents(spark, str(tmp_path / "documents"))
    plan = _plan(silver.deduplicated_measurements(stored))
    assert plan.count("Exchange hashpartitioning") == plan.count("Sort [") == 1
    assert plan.index("posexplode") < plan.index("Exchange") and ", 12)" in plan


def test_stored_rows_join_without_a_further_shuffle(spark, tmp_path):
    path = str(tmp_path / "days")
    raw = _raw(spark).filter("city.city_id IS NOT NULL")
    silver.update_silver(spark, raw.filter("run_id = 'r1'"), path)
    kept = readers.read_silver_days(spark, path, list(readers.silver_days(spark, path).values()))
    plan = _plan(silver.deduplicated_measurements(raw, stored=kept, stored_rows=kept.count()))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Sort [") == 1


@pytest.mark.parametrize("most", [3, 4])
def test_a_city_with_many_documents_is_combined_before_the_shuffle(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(silver, "DOCUMENTS_PER_CITY", most)
    raw = _raw(spark)
    dealt = silver.city_tasks(flatten_documents(raw), 0)
    assert (dealt is None) == (most < 4)
    report = silver.build_silver(spark, raw, str(tmp_path / "silver"))
    wanted = dedupe.silver_rows(dedupe.deduplicate(silver.checked_measurements(raw)))
    assert _texts(readers.read_silver(spark, str(tmp_path / "silver"))) == _texts(wanted)
    assert report.max_records_per_key == 7
    plan = _plan(silver.deduplicated_measurements(raw))
    assert ("partial_max_by" in plan) == (most < 4)


def test_increments_read_documents_for_days_and_census_at_once(spark):
    flat = flatten_documents(_raw(spark))
    by_day = silver.profile_documents_by_day(flat)
    days = {str(r[0]) for r in by_day.select("measurement_day").distinct().collect()}
    assert days == {"None", "2026-07-18", "2026-07-19", "2026-07-20"}
    sums = by_day.drop("measurement_day").groupBy(*silver.DEFAULT_SPEC.flags).sum("count")
    assert sorted(map(tuple, sums.collect())) == sorted(
        map(tuple, silver.profile_documents(flat).drop("length_issues").collect()))
