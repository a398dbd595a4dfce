"""Requests, attempts, outcomes and run tables, on invented stations of an invented feed."""

from datetime import datetime, timedelta
from urllib.parse import parse_qsl, urlencode, urlsplit

import pytest
from pyspark.sql import functions as F

from hourlake import schemas
from hourlake.functions.runs import run_status
from hourlake.operators import accounting, gates, joins
from hourlake.spec import DEFAULT_METRICS

OPENED = datetime(2029, 2, 27, 23, 15)
CLOSED = OPENED + timedelta(hours=3)
ENDPOINT = "http://stations.invalid/readings"
STATIONS = [
    (510, "Nordkap & Söhne", "Eisland", 71.25, -8.5),
    (511, "Tief=Tal?", "Talland", -0.125, 179.75),
    (512, "Nullpunkt", "Meer", 0.0003, -0.00002),
]


def stations(spark):
    return spark.createDataFrame(STATIONS, schemas.CITY)


def test_request_url_is_the_form_encoding_of_its_parameters(spark):
    shown = {510: ("71.25", "-8.5"), 511: ("-0.125", "179.75"), 512: ("0.0003", "-0.00002")}
    for row in accounting.request_urls(stations(spark), ENDPOINT).collect():
        latitude, longitude = shown[row["city_id"]]
        parameters = [
            ("latitude", latitude),
            ("longitude", longitude),
            ("hourly", ",".join(DEFAULT_METRICS)),
            ("timezone", "UTC"),
            ("forecast_days", "1"),
            ("past_days", "2"),
        ]
        assert parse_qsl(urlsplit(row["request_url"]).query) == parameters
        assert row["request_url"] == ENDPOINT + "?" + urlencode(parameters)


PAYLOADS = f"""run_id STRING, city_id INT, run_started_at_utc TIMESTAMP, ingested_at_utc TIMESTAMP,
    raw_payload {schemas.payload()}, payload_text STRING"""


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_documents_nest_city_request_and_payload(spark, limit, monkeypatch):
    monkeypatch.setattr(joins.join_dimension, "__defaults__", (limit, "inner"))
    readings = {m: [place + 0.5, None] for place, m in enumerate(DEFAULT_METRICS)}
    payload = {"hourly": {"time": ["later", None], **readings}}
    known, unknown = 511, 600
    rows = [("night", c, OPENED, CLOSED, payload, f"text of {c}") for c in (known, unknown)]
    frame = spark.createDataFrame(rows, PAYLOADS)
    documents = accounting.build_documents(stations(spark), frame, ENDPOINT, "sky")
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" if limit == 0 else "BroadcastHashJoin") in plan

    found = {r["city"]["city_id"]: r.asDict(recursive=True) for r in documents.collect()}
    assert found.keys() == {known, unknown}
    for city_id, row in found.items():
        assert (row["run_id"], row["raw_payload"]) == ("night", payload)
        assert row["payload_text"] == f"text of {city_id}"
        assert list(row["request"].values()) == [ENDPOINT, [*DEFAULT_METRICS], "UTC", 1, 2]
        stamps = list(row["ingestion_metadata"].values())
        assert stamps == [OPENED, CLOSED, "sky", "ingest_complete"]
    assert tuple(found[known]["city"].values()) == STATIONS[1]
    assert set(found[unknown]["city"].values()) == {unknown, None}
    unlisted = accounting.unlisted_city_documents(documents).collect()
    assert [tuple(r) for r in unlisted] == [("night", unknown)]
    with pytest.raises(RuntimeError, match="1 documents are of cities that are not listed"):
        gates.check_listed_cities(documents)


def test_run_status_over_all_counts_of_a_small_run(spark):
    counts = [(s, i) for i in range(4) for s in range(i + 1)]
    frame = spark.createDataFrame(counts, "s INT, i INT")
    found = frame.select("s", "i", run_status(F.col("s"), F.col("i"))).collect()
    for successful, intended, status in found:
        if successful == intended:
            assert status == "completed"
        else:
            assert status == ("failed" if successful == 0 else "partial_failure")


LOG = """run_id STRING, city_id INT, city STRING, attempt INT, ok BOOLEAN, error_kind STRING,
    http_code INT, error_message STRING"""


def log(spark, tries, run="night"):
    """A log out of station → what its attempts met, by number: ``ok``, a kind, or an HTTP code."""
    rows = []
    for station, met in tries.items():
        for number, what in met.items():
            kind = None if what == "ok" else "http" if isinstance(what, int) else what
            code = what if isinstance(what, int) else None
            message = kind and f"{what}@{number}"
            rows.append((run, station, f"S{station}", number, what == "ok", kind, code, message))
    return spark.createDataFrame(rows, LOG)


def test_failure_class(spark):
    wanted = {"ok": "success", "network": "retryable", 429: "retryable"}
    wanted |= dict.fromkeys(range(500, 600, 11), "retryable")
    wanted |= dict.fromkeys([200, 302, 400, 428, 430, 499, 600], "final")
    wanted |= dict.fromkeys(["validation", "storage", "unexpected", "unheard of"], "final")
    frame = log(spark, {i: {1: what} for i, what in enumerate(wanted)})
    found = accounting.classify_attempts(frame).orderBy("city_id").collect()
    assert [r["failure_class"] for r in found] == list(wanted.values())
    blank = accounting.classify_attempts(log(spark, {1: {1: "http"}}))
    assert blank.first()["failure_class"] == "final"


TRIES = {
    21: {1: 502, 2: "network", 3: "ok"},
    22: {1: "storage", 2: "ok"},
    23: {1: "ok", 2: 404},
    24: {1: "network", 2: 429},
    25: {4: "network", 5: "ok"},
    26: {7: 503},
}


def test_the_first_stop_decides_or_else_the_last_attempt(spark):
    found = accounting.city_outcomes(log(spark, TRIES)).orderBy("city_id").collect()
    assert [tuple(r)[1:] for r in found] == [
        (21, "S21", 3, True, None),
        (22, "S22", 1, False, "storage@1"),
        (23, "S23", 1, True, None),
        (24, "S24", 2, False, "429@2"),
        (25, "S25", 5, True, None),
        (26, "S26", 7, False, "503@7"),
    ]


def test_numbers_beyond_the_limit_are_reported_and_refused(spark):
    frame = log(spark, TRIES | {27: {None: "ok", 0: "network"}})
    found = gates.attempt_limit_violations(frame).collect()
    numbers = sorted(((r["city_id"], r["attempt"]) for r in found), key=str)
    assert numbers == [(25, 4), (25, 5), (26, 7), (27, 0), (27, None)]
    with pytest.raises(RuntimeError, match="5 logged attempts are beyond the limit of 3"):
        gates.check_attempt_limit(frame)
    gates.check_attempt_limit(log(spark, {i: TRIES[i] for i in (21, 22, 23, 24)}))


def runs(spark, **intended):
    return spark.createDataFrame(
        [(run, OPENED, CLOSED, n) for run, n in intended.items()],
        """run_id STRING, run_started_at_utc TIMESTAMP, run_completed_at_utc TIMESTAMP,
           cities_intended BIGINT""",
    )


def test_each_run_has_one_header_with_or_without_attempts(spark):
    outcomes = accounting.city_outcomes(log(spark, TRIES))
    summaries = accounting.run_summary(runs(spark, night=6, idle=4, empty=0), outcomes)
    found = {r["run_id"]: r for r in summaries.collect()}
    assert {k: (r["status"], *r["counts"]) for k, r in found.items()} == {
        "night": ("partial_failure", 6, 3, 3),
        "idle": ("failed", 4, 0, 0),
        "empty": ("completed", 0, 0, 0),
    }
    assert tuple(found["night"]["request_config"]) == ([*DEFAULT_METRICS], 2, 1, "UTC")
    names = [f.name for f in spark.createDataFrame([], schemas.RUN_SUMMARY).schema]
    assert summaries.columns == names


@pytest.mark.parametrize("stations_of_run", [3, 250])
def test_city_lists_have_the_same_blocks_at_every_size(spark, stations_of_run):
    tries = {i: {1: "ok" if i % 4 else "validation"} for i in range(95, 95 + stations_of_run)}
    outcomes = accounting.city_outcomes(log(spark, tries))
    lists = accounting.run_city_lists(outcomes, cities_per_block=40).collect()
    seen = []
    for r in lists:
        both = [*r["successful_cities"], *r["failed_cities"]]
        assert len(both) <= 40
        assert {c["city_id"] // 40 for c in both} == {r["block"]}
        for part in (r["successful_cities"], r["failed_cities"]):
            ids = [c["city_id"] for c in part]
            assert ids == sorted(ids)
        assert {c["error_message"] for c in r["failed_cities"]} <= {"validation@1"}
        seen += [c["city_id"] for c in both]
    assert sorted(seen) == list(tries)


def test_newest_run_by_completion_then_id(spark):
    finished = {"m": 5, "n": 9, "k": 9, "z": 2}
    rows = [(run, CLOSED + timedelta(minutes=m)) for run, m in finished.items()]
    frame = spark.createDataFrame(rows, "run_id STRING, run_completed_at_utc TIMESTAMP")
    assert accounting.newest_run(frame).first()["run_id"] == "n"
