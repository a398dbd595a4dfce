import random
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hourlake.functions.validity import parsed_timestamp
from hourlake.operators import quality
from hourlake.spec import DEFAULT_METRICS, DEFAULT_SPEC, TIMESTAMP_FORMAT, HourlySpec


def test_default_window_has_72_slots():
    assert DEFAULT_SPEC.expected_length == 72


@pytest.mark.parametrize("wrong", [{"metrics": ()}, {"metrics": ("pm10",)}])
def test_spec_needs_metrics_and_a_known_peak(wrong):
    with pytest.raises(ValueError):
        HourlySpec(**wrong)


def parse(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "measurement_timestamp_raw STRING")
    return [r["measurement_timestamp"] for r in quality.add_timestamp(frame).collect()]


def test_timestamp_parsing_keeps_the_raw_text(spark):
    frame = spark.createDataFrame(
        [("2026-07-20T14:00",), ("invalid-timestamp",)], "measurement_timestamp_raw STRING"
    )
    rows = [tuple(r) for r in quality.add_timestamp(frame).collect()]
    assert rows == [
        ("2026-07-20T14:00", datetime(2026, 7, 20, 14)),
        ("invalid-timestamp", None),
    ]


def test_texts_that_only_look_like_timestamps_are_null(spark):
    texts = [
        None, "", "2026-07-20T14:00:00", "2026-07-20T14:00Z", " 2026-07-20T14:00", "2026-07-20",
        "2026-02-30T00:00", "2026-07-20T24:00", "2026-07-20T14:00\n", "2026-07-20 14:00",
        "2026-7-20T14:00", "26-07-20T14:00",
    ]
    assert parse(spark, texts) == [None] * len(texts)


def test_fast_parsing_equals_parsing_by_pattern(spark):
    """Mutations of valid texts, and forms only the pattern parser accepts."""
    chance = random.Random(7)
    alphabet = "0123456789-:tT+ zZ./\n٣"
    texts = [
        "2026-07-20t14:00", "+12026-07-20T14:00", "-2026-07-20T14:00", "0000-01-01T00:00",
        "0999-12-31T23:59", "12026-07-20T14:00", "+2026-07-20T14:00",
    ]
    for _ in range(4000):
        text = list(
            f"{chance.randint(0, 9999):04}-{chance.randint(0, 13):02}-{chance.randint(0, 32):02}"
            f"T{chance.randint(0, 25):02}:{chance.randint(0, 61):02}"
        )
        for _ in range(chance.choice([0, 0, 1, 2])):
            spot = chance.randrange(len(text))
            text[spot : spot + chance.randint(0, 1)] = chance.choice(alphabet)
        texts.append("".join(text))
    frame = spark.createDataFrame([(t,) for t in texts], "raw STRING")
    by_pattern = F.try_to_timestamp("raw", F.lit(TIMESTAMP_FORMAT))
    # Compared as numbers: years beyond 9999 do not fit Python's datetime.
    found = frame.select(
        "raw",
        F.unix_micros(parsed_timestamp(F.col("raw"))).alias("fast"),
        F.unix_micros(by_pattern).alias("slow"),
    )
    assert found.filter(~F.col("fast").eqNullSafe(F.col("slow"))).collect() == []
    assert found.filter("slow IS NOT NULL").count() > 500


def test_other_formats_are_parsed_by_their_pattern(spark):
    spec = replace(DEFAULT_SPEC, timestamp_format="dd.MM.yyyy HH:mm")
    frame = spark.createDataFrame([("20.07.2026 14:00",)], "raw STRING")
    row = frame.select(parsed_timestamp(F.col("raw"), spec)).first()
    assert row[0] == datetime(2026, 7, 20, 14)


def test_timestamp_is_valid_only_with_text_and_value(spark):
    frame = spark.createDataFrame(
        [
            (1, "2026-07-20T14:00", datetime(2026, 7, 20, 14)),
            (2, "invalid-timestamp", None),
            (3, None, datetime(2026, 7, 20, 14)),
        ],
        "id INT, measurement_timestamp_raw STRING, measurement_timestamp TIMESTAMP",
    )
    flagged = quality.add_timestamp_flag(frame).orderBy("id").collect()
    assert [r["is_valid_measurement_timestamp"] for r in flagged] == [True, False, False]


def test_metric_flags(spark):
    frame = spark.createDataFrame(
        [
            (1, 1.0, 2.0, 3.0, 4.0),
            (2, -1.0, -2.0, -3.0, -4.0),
            (3, None, None, None, None),
            (4, 0.0, 0.0, 0.0, 0.0),
            (5, 1.0, None, -1.0, float("nan")),
        ],
        "id INT, " + ", ".join(f"{m} DOUBLE" for m in DEFAULT_METRICS),
    )

    def flags(spec):
        rows = quality.add_metric_flags(frame, spec).orderBy("id").collect()
        return [tuple(r[f"is_valid_{m}"] for m in DEFAULT_METRICS) for r in rows]

    default = flags(DEFAULT_SPEC)
    assert default == [
        (True,) * 4,
        (False,) * 4,
        (False,) * 4,
        (True,) * 4,
        (True, False, False, True),
    ]
    assert flags(replace(DEFAULT_SPEC, reject_nan=True))[4] == (True, False, False, False)
