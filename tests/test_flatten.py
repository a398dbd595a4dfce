from dataclasses import replace
from datetime import datetime

import pytest

from hourlake import schemas
from hourlake.operators import flatten, gates
from hourlake.plans.silver import profile_documents
from hourlake.spec import DEFAULT_METRICS, DEFAULT_SPEC

SHORT = replace(DEFAULT_SPEC, past_days=0, forecast_days=1, hours_per_day=2)


PLACE = {
    "city": "Moorbrück",
    "country": "Binnenland",
    "requested_latitude": -12.5,
    "requested_longitude": 140.0625,
}
FETCHED = datetime(2034, 12, 31, 23, 59)
PAIR = ("2034-12-31T22:00", "2034-12-31T23:00")


def document(city_id=1, run_id="r1", time=PAIR, **arrays):
    """A document of two slots; metric number k reads k and k + 10."""
    readings = {m: [float(k), k + 10.0] for k, m in enumerate(DEFAULT_METRICS)} | arrays
    return {
        "run_id": run_id,
        "city": {"city_id": city_id, **PLACE},
        "ingestion_metadata": {"ingested_at_utc": FETCHED},
        "raw_payload": {"hourly": {"time": time and list(time), **readings}},
    }


def flat(spark, *documents):
    frame = spark.createDataFrame(documents, schemas.raw_document())
    return flatten.flatten_documents(frame)


def measured(frame):
    return flatten.project_measurements(flatten.explode_measurements(flatten.zip_arrays(frame)))


def test_document_becomes_scalars_and_arrays(spark):
    row = flat(spark, document(88, "dusk", pm10=[None, 6.5])).first().asDict()
    arrays = {f"{m}_array": [float(k), k + 10.0] for k, m in enumerate(DEFAULT_METRICS)}
    arrays |= {"pm10_array": [None, 6.5], "time_array": [*PAIR]}
    assert row == PLACE | arrays | {"run_id": "dusk", "city_id": 88, "ingested_at_utc": FETCHED}


@pytest.mark.parametrize("unnest", [measured, flatten.unnest_equal_arrays])
def test_each_position_becomes_a_row(spark, unnest):
    rows = unnest(flat(spark, document(time=(None, "noon"), pm2_5=[None, -4.0]))).collect()
    found = [(r["measurement_timestamp_raw"], r["pm2_5"], r["nitrogen_dioxide"]) for r in rows]
    assert found == [(None, None, 3.0), ("noon", -4.0, 13.0)]


def test_zip_pads_short_arrays_and_drops_null_ones(spark):
    rows = measured(flat(spark, document(5, pm10=[]), document(6, pm10=None))).collect()
    assert [(r["city_id"], r["pm10"]) for r in rows] == [(5, None), (5, None)]


def test_fewer_metrics_read_fewer_arrays(spark, tmp_path):
    path = str(tmp_path / "documents")
    spark.createDataFrame([document()], schemas.raw_document()).write.parquet(path)
    stored = spark.read.schema(schemas.raw_document()).parquet(path)
    one = flatten.unnest_equal_arrays(flatten.flatten_documents(stored)).select("pm10")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "hourly:struct<time:array<string>,pm10:array<double>>" in plan


FULL = [0.0] * 72
TIMES = [PAIR[0]] * 72


def full(**arrays):
    return document(time=arrays.pop("time", TIMES), **dict.fromkeys(DEFAULT_METRICS, FULL) | arrays)


def test_length_gate_accepts_full_arrays(spark):
    gates.check_lengths(flat(spark, full()))


@pytest.mark.parametrize(
    "arrays",
    [
        {"pm10": FULL[1:]},
        {"pm10": None},
        {"time": None},
        {"time": None, **dict.fromkeys(DEFAULT_METRICS)},
        {"time": TIMES[1:], **dict.fromkeys(DEFAULT_METRICS, FULL[1:])},
        {"time": [], **dict.fromkeys(DEFAULT_METRICS, [])},
        {"time": TIMES + TIMES[:1]},
    ],
)
def test_length_gate_counts_bad_documents(spark, arrays):
    frame = flat(spark, full(), full(**arrays))
    with pytest.raises(RuntimeError, match="Issues found in 1 source array-length records."):
        gates.check_lengths(frame)
    assert [r["length_issues"] for r in profile_documents(frame).collect() if r["length_issues"]] == [1]


def test_profile_counts_each_combination_once(spark):
    frame = flat(
        spark,
        document(pm10=[-1.0, 2.0], time=(PAIR[1], None)),
        document(2, pm10=[1.0]),
        document(3, pm10=None),
    )
    rows = {tuple(r[f] for f in SHORT.flags): (r["count"], r["length_issues"])
            for r in profile_documents(frame, SHORT).collect()}
    assert rows == {
        (True, True, False, True, True): (1, 0),
        (False, True, True, True, True): (1, 0),
        (False, False, False, False, False): (0, 2),
    }
