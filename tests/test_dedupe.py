"""Latest record per key: checked against a plain reduction over generated logs."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from hourlake.operators import dedupe, quality

SCHEMA = """run_id STRING, city_id INT, measurement_timestamp TIMESTAMP, ingested_at_utc TIMESTAMP,
    pm10 DOUBLE, is_valid_measurement_timestamp BOOLEAN"""
START = datetime(2033, 5, 2)


def row(run, city, slot, arrived, value=0.0):
    """``slot`` is an hour or, for a row without a usable time, None."""
    time = None if slot is None else START + timedelta(hours=slot)
    arrival = None if arrived is None else START + timedelta(days=9, minutes=arrived)
    return (run, city, time, arrival, value, slot is not None)


def log(seed, size=300):
    """Rows with few keys, arrivals and runs, so that all of them repeat; values are unique."""
    draw = random.Random(seed)
    rows = [
        row(
            f"run-{draw.randrange(6)}",
            draw.choice([8, 9, None]),
            draw.choice([*range(7), None]),
            draw.choice([*range(4), None]),
            float(i),
        )
        for i in range(size)
    ]
    # Which of two rows with one arrival and run wins is not defined: keep one of each.
    return list({r[:4] + (r[5],): r for r in rows if r[5]}.values()) + [r for r in rows if not r[5]]


def winners(rows):
    best = {}
    for r in rows:
        rank = (r[3] is not None, r[3] or START, r[0])
        if r[5] and (r[1:3] not in best or rank > best[r[1:3]][0]):
            best[r[1:3]] = (rank, r)
    return Counter(r for _, r in best.values())


def with_counts(frame):
    return dedupe.latest_valid_rows_with_counts(frame).drop("record_count")


def collected(frame):
    return Counter(map(tuple, frame.collect()))


@pytest.mark.parametrize("latest", [dedupe.latest_valid_rows, with_counts])
@pytest.mark.parametrize("seed", [1, 2])
def test_latest_arrival_wins_then_the_larger_run(spark, latest, seed):
    rows = log(seed)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert collected(latest(frame).select(*frame.columns)) == winners(rows)


def test_rows_without_a_time_are_all_kept(spark):
    rows = log(3)
    kept = dedupe.deduplicate(spark.createDataFrame(rows, SCHEMA))
    untimed = Counter(r for r in rows if not r[5])
    assert sum(untimed.values()) > 5
    assert collected(kept) == winners(rows) + untimed


def test_duplicate_reports_count_timed_rows_only(spark):
    rows = log(4)
    sizes = Counter(r[1:3] for r in rows if r[5])
    repeated = {key: n for key, n in sizes.items() if n > 1}
    found = quality.duplicate_keys(spark.createDataFrame(rows, SCHEMA))
    assert {tuple(r)[:2]: r["record_count"] for r in found.collect()} == repeated
    summary = quality.duplicate_summary(found).first()
    extra = sum(repeated.values()) - len(repeated)
    assert tuple(summary) == (len(repeated), extra, max(repeated.values()))
    assert tuple(quality.duplicate_summary(found.limit(0)).first()) == (0, None, None)


def test_kept_and_redundant_rows_add_up(spark):
    rows = log(5)
    kept = dedupe.latest_valid_rows_with_counts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r["record_count"] for r in kept) == sum(r[5] for r in rows)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(9).selectExpr(
        "string(id) AS run_id",
        "int(id) AS city_id",
        "timestamp_seconds(id) AS measurement_timestamp",
        "timestamp_seconds(id) AS ingested_at_utc",
        "id > 1 AS is_valid_measurement_timestamp",
    )
    plan = dedupe.latest_valid_rows(frame)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below
    plan = with_counts(frame)._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan[plan.index("Exchange") :]
