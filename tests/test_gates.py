from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from hourlake.operators import gates

DAY = date(2026, 7, 20)
KEYS = ["city_id", "measurement_date"]
SCHEMA = "city_id INT, measurement_date DATE"


def test_null_keys(spark):
    frame = spark.createDataFrame([(1, DAY), (None, DAY)], SCHEMA)
    with pytest.raises(
        RuntimeError, match="Test data contains 1 rows with null business keys"
    ):
        gates.check_no_null_keys(frame, KEYS, "Test data")
    gates.check_no_null_keys(frame.limit(1), KEYS, "Test data")
    assert [tuple(r) for r in gates.null_key_rows(frame, KEYS).collect()] == [(None, DAY)]


def test_duplicate_keys_count_groups_and_treat_nulls_as_equal(spark):
    rows = [(1, DAY), (1, DAY), (1, date(2026, 7, 21)), (None, DAY), (None, DAY)]
    frame = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(RuntimeError, match="Test data contains 2 duplicate key groups"):
        gates.check_no_duplicate_keys(frame, KEYS, "Test data")
    gates.check_no_duplicate_keys(frame.distinct(), KEYS, "Test data")


@pytest.mark.parametrize(
    "gate",
    [
        lambda frame: gates.check_no_null_keys(frame, [], "x"),
        lambda frame: gates.check_no_duplicate_keys(frame, [], "x"),
        lambda frame: gates.check_keyed_table(frame, [], "x", 0),
    ],
)
def test_empty_key_list_is_refused(spark, gate):
    with pytest.raises(ValueError, match="key_columns cannot be empty"):
        gate(spark.createDataFrame([], SCHEMA))


def test_duplicate_measurements_look_at_valid_rows_only(spark):
    schema = "city_id INT, measurement_timestamp TIMESTAMP, is_valid_measurement_timestamp BOOLEAN"
    hour = datetime(2026, 7, 20, 1)
    rows = [(1, hour, True), (1, None, False), (1, None, False)]
    gates.check_no_duplicate_measurements(spark.createDataFrame(rows, schema), "Silver")
    with pytest.raises(RuntimeError, match="Silver contains 1 duplicate key groups"):
        gates.check_no_duplicate_measurements(
            spark.createDataFrame([*rows, (1, hour, True)], schema), "Silver"
        )


def test_row_counts():
    gates.check_row_counts(3, 3, "Gold")
    with pytest.raises(
        RuntimeError, match="Gold row-count validation failed: expected 3, found 2"
    ):
        gates.check_row_counts(3, 2, "Gold")


def test_schema_compares_names_types_and_order_but_not_nullability(spark):
    frame = spark.createDataFrame([(1, DAY)], SCHEMA)
    gates.check_schema(frame, spark.createDataFrame([(1, DAY)], SCHEMA.replace("INT", "INT NOT NULL")), "x")
    for other in ("measurement_date", "city_id"), ("city_id",):
        with pytest.raises(RuntimeError, match="x schema does not match"):
            gates.check_schema(frame, frame.select(*other), "x")
    with pytest.raises(RuntimeError, match="x schema does not match"):
        gates.check_schema(frame, frame.withColumn("city_id", F.col("city_id").cast("long")), "x")


@pytest.mark.parametrize(
    "rows, expected, message",
    [
        ([(1, DAY), (2, DAY)], 2, None),
        ([], 0, None),
        ([(1, DAY)], 2, "row-count validation failed: expected 2, found 1"),
        ([(1, DAY), (None, DAY)], 2, "contains 1 rows with null business keys"),
        ([(1, DAY), (1, DAY), (2, DAY)], 3, "contains 1 duplicate key groups"),
    ],
)
def test_keyed_table_check_covers_the_three_gates(spark, rows, expected, message):
    frame = spark.createDataFrame(rows, SCHEMA)
    if message is None:
        gates.check_keyed_table(frame, KEYS, "Gold", expected)
    else:
        with pytest.raises(RuntimeError, match=message):
            gates.check_keyed_table(frame, KEYS, "Gold", expected)


def test_keyed_table_check_on_part_of_the_rows(spark):
    frame = spark.createDataFrame(
        [(1, DAY, True), (None, None, False), (None, None, False)], SCHEMA + ", valid BOOLEAN"
    )
    gates.check_keyed_table(frame, KEYS, "Silver", 3, unique_where=F.col("valid"))
    with pytest.raises(RuntimeError, match="Silver contains 1 duplicate key groups"):
        gates.check_keyed_table(
            frame.union(frame.filter("valid")), KEYS, "Silver", 4, unique_where=F.col("valid")
        )
