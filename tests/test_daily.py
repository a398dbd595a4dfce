"""Daily rollup and peaks, on generated days whose results are worked out by plain Python."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hourlake import schemas
from hourlake.operators import daily
from hourlake.sources.session import setting
from hourlake.spec import DEFAULT_METRICS, DEFAULT_SPEC, HourlySpec

NEW_YEAR = datetime(2030, 1, 1)
SCHEMA = "city_id INT, city STRING, measurement_timestamp TIMESTAMP, " + ", ".join(
    [f"{m} DOUBLE" for m in DEFAULT_METRICS] + [f"{f} BOOLEAN" for f in DEFAULT_SPEC.flags]
)
COUNTINGS = ["distinct", "unique_rows", "minutes", "whole_hours"]


def slot(hour, *values, place=(70, "Quellheim"), timed=True, minutes=0):
    """One measurement row; one value stands for all metrics."""
    values = values * 4 if len(values) == 1 else values
    time = NEW_YEAR + timedelta(hours=hour, minutes=minutes) if timed else None
    return (*place, time, *values, timed, *(v is not None and v >= 0 for v in values))


def dated(spark, rows):
    return daily.add_date(spark.createDataFrame(list(rows), SCHEMA))


def evening():
    """Seven hours of which metric number k misses those divisible by k + 2."""
    return [
        slot(h, *(None if h % (k + 2) == 0 else float((h * (k + 3)) % 11) for k in range(4)))
        for h in range(17, 24)
    ]


def expected(rows):
    """What one day's rows give, by the rules: only valid readings count."""
    row = {}
    for k, m in enumerate(DEFAULT_METRICS):
        valid = [r[3 + k] for r in rows if r[3 + k] is not None and r[3 + k] >= 0]
        row[f"average_{m}"] = pytest.approx(sum(valid) / len(valid)) if valid else None
        row[f"maximum_{m}"] = max(valid, default=None)
        row[f"valid_daily_{m}_count"] = len(valid)
    seen = len({r[2] for r in rows})
    return row | {
        "observed_hour_count": seen,
        "expected_hour_count": 24,
        "completeness_percentage": pytest.approx(seen / 24 * 100),
        "is_complete_day": seen == 24,
        "is_fully_valid_day": all(row[f"valid_daily_{m}_count"] == 24 for m in DEFAULT_METRICS),
    }


@pytest.mark.parametrize("observed", COUNTINGS)
@pytest.mark.parametrize(
    "rows",
    [
        evening(),
        [slot(h, float(h)) for h in range(24)],
        [slot(h, float(h), -0.5, None, 0.0) for h in range(24)],
        [slot(h, float(h)) for h in range(23)] + [slot(23, 5.0, 5.0, 5.0, -1.0)],
        [slot(11, None)],
    ],
    ids=["gaps", "full", "one metric only", "last reading bad", "nothing valid"],
)
def test_rollup_of_one_day(spark, rows, observed):
    found = [r.asDict() for r in daily.daily_rollup(dated(spark, rows), observed=observed).collect()]
    key = {"city_id": 70, "city": "Quellheim", "measurement_date": date(2030, 1, 1)}
    assert found == [key | expected(rows)]


def test_observed_hours_are_distinct_timestamps(spark):
    rows = evening()
    tripled = dated(spark, rows * 3)
    for observed in ("distinct", "minutes", "whole_hours"):
        assert daily.daily_rollup(tripled, observed=observed).first()["observed_hour_count"] == 7
    between = dated(spark, [*rows, slot(20, 2.5, minutes=45)])
    for observed in ("distinct", "minutes"):
        assert daily.daily_rollup(between, observed=observed).first()["observed_hour_count"] == 8
    every = [slot(i // 60, 1.0, minutes=i % 60) for i in range(1440)]
    found = daily.daily_rollup(dated(spark, every + every[::7]), observed="minutes").first()
    assert found["observed_hour_count"] == 1440


def test_minutes_of_a_day_of_25_hours(spark):
    """Where clocks are put back, an hour's minutes come twice and are different times."""
    with setting(spark, "spark.sql.session.timeZone", "Europe/Paris"):
        # Midnight of 27 October 2024 there, and every minute since.
        times = spark.range(25 * 60).selectExpr(
            "1 AS city_id", "timestamp_seconds(1729980000 + 60 * id) AS measurement_timestamp"
        )
        rows = daily.add_date(times).select(
            "*", F.lit("x").alias("city"), *(F.lit(1.0).alias(m) for m in DEFAULT_METRICS),
            *(F.lit(True).alias(f) for f in DEFAULT_SPEC.flags),
        )
        found = [r["observed_hour_count"] for r in daily.daily_rollup(rows, observed="minutes").collect()]
    assert found == [1500]


def test_counting_goes_by_what_the_format_can_say():
    formats = {"yyyy-MM-dd'T'HH:mm": "minutes", "yyyy-MM-dd HH:mm:ss": "distinct", "HH:mm 'seconds' dd.MM.yyyy": "minutes"}
    for text, method in formats.items():
        assert daily.counting_method(HourlySpec(timestamp_format=text)) == method


def test_unknown_counting_method_is_refused(spark):
    with pytest.raises(ValueError, match="unknown method"):
        daily.daily_rollup(dated(spark, evening()), observed="guess")


@pytest.mark.parametrize("order", [1, -1])
def test_peak_is_the_earliest_of_equal_maxima(spark, order):
    # The maximum of 8 is reached at 5, 13 and 21 o'clock; unusable readings come before it.
    rows = [slot(h, float(h % 8) + (h % 8 == 5) * 3) for h in range(3, 24)]
    rows += [slot(0, None), slot(1, -70.0), slot(2, 900.0, timed=False)]
    peaks = daily.daily_peak(dated(spark, rows[::order])).collect()
    assert [tuple(r) for r in peaks] == [(70, date(2030, 1, 1), NEW_YEAR + timedelta(hours=5))]


def several_places(spark):
    blind = (71, "Dunkelau")
    return dated(
        spark,
        [
            *evening(),
            *(slot(h, float(h)) for h in (40, 47, 71)),
            slot(4, None, 6.0, 6.0, 6.0, place=blind),
            slot(8, -2.0, 6.0, 6.0, 6.0, place=blind),
            slot(9, 3.5, place=(None, "Nirgends")),
            slot(10, float("nan"), place=(72, "Zahlbach"))[:7] + (True,) * 5,
            slot(10, 1.25, place=(72, "Zahlbach")),
            slot(12, 640.0, timed=False),
        ],
    )


@pytest.mark.parametrize("observed", ["distinct", "minutes", "whole_hours"])
def test_report_in_one_pass_equals_rollup_joined_with_peaks(spark, observed):
    rows = several_places(spark)
    columns = list(schemas.gold())

    def shown(frame):
        return sorted(str(tuple(r)) for r in frame.select(*columns).collect())

    report = daily.daily_report(rows, observed=observed)
    joined = daily.join_peak(daily.daily_rollup(rows), daily.daily_peak(rows))
    assert report.columns == columns
    assert shown(report) == shown(joined)
    peaks = [(r["city_id"], r["maximum_european_aqi_timestamp"]) for r in report.collect()]
    assert len(peaks) == 6
    assert {city for city, time in peaks if time is None} == {None, 71}


def test_only_invalid_timestamps_give_no_day(spark):
    assert daily.daily_report(dated(spark, [slot(6, 2.0, timed=False)])).collect() == []


def test_other_metrics_and_day_lengths(spark):
    short_days = replace(DEFAULT_SPEC, metrics=("pm2_5",), peak_metric="pm2_5", hours_per_day=3)
    rows = [slot(h, 0.0, 0.0, float(v), 0.0) for h, v in ((1, 4), (2, 9), (3, 6))]
    row = daily.daily_report(dated(spark, rows), short_days).first().asDict()
    assert row["is_fully_valid_day"] and row["completeness_percentage"] == 100.0
    assert row["maximum_pm2_5_timestamp"] == NEW_YEAR + timedelta(hours=2)
    assert not [c for c in row if "pm10" in c]


def test_report_takes_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    spark.createDataFrame(evening(), SCHEMA).write.parquet(path)
    rows = daily.add_date(spark.read.schema(SCHEMA).parquet(path))
    for observed in ("minutes", "whole_hours"):
        report = daily.daily_report(rows, observed=observed)
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == plan.count("Exchange hashpartitioning") == 1
        assert "PushedFilters: [IsNotNull(is_valid_measurement_timestamp)" in plan
