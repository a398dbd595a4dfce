import json

import pytest

from hourlake.functions.payload import with_reject_reason
from hourlake.spec import DEFAULT_METRICS

# Every third slot of a night, one metric after the other counting on in steps of a quarter.
SLOTS = [f"2031-11-30T{hour:02}:00" for hour in range(0, 12, 3)]
GOOD = {"time": SLOTS} | {
    metric: [None if place == row else row + place / 4 for place in range(len(SLOTS))]
    for row, metric in enumerate(DEFAULT_METRICS)
}


def hourly(**changes):
    section = {k: v for k, v in (GOOD | changes).items() if v != "absent"}
    return json.dumps({"hourly": section})


NOT_AN_OBJECT = "API response must be a dictionary"
NO_SECTION = "API response does not contain a valid hourly section"
NO_TIME = "hourly.time must be a non-empty list"

CASES = {
    "accepted": (hourly(), None),
    "extra fields": (json.dumps({"hourly": GOOD | {"x": 1}, "latitude": 1.5}), None),
    "error false": (json.dumps({"error": False, "hourly": GOOD}), None),
    "error as text": (json.dumps({"error": "true", "hourly": GOOD}), None),
    "error as number": (json.dumps({"error": 1, "hourly": GOOD}), None),
    "no text": (None, NOT_AN_OBJECT),
    "empty text": ("", NOT_AN_OBJECT),
    "broken": ('{"hourly":', NOT_AN_OBJECT),
    "repeated key, last one good": (hourly()[:-1] + ', "hourly": ' + json.dumps(GOOD) + "}", None),
    "repeated key, last one bad": (hourly()[:-1] + ', "hourly": 3}', NO_SECTION),
    "repeated variable": (hourly()[:-2] + ', "pm10": 7}}', "Hourly variable 'pm10' must be a list"),
    "list": ("[1]", NOT_AN_OBJECT),
    "null": ("null", NOT_AN_OBJECT),
    "string": ('"hourly"', NOT_AN_OBJECT),
    "error": ('{"error": true}', "API returned an error: Unknown API error"),
    "error with reason": (
        '{"error": true, "reason": "limit reached"}',
        "API returned an error: limit reached",
    ),
    "error with number": ('{"error": true, "reason": 429}', "API returned an error: 429"),
    "error with null": ('{"error": true, "reason": null}', "API returned an error: None"),
    "error with boolean": ('{"error": true, "reason": true}', "API returned an error: True"),
    "error before structure": (
        '{"error": true, "hourly": 1}',
        "API returned an error: Unknown API error",
    ),
    "no section": ("{}", NO_SECTION),
    "section is null": ('{"hourly": null}', NO_SECTION),
    "section is a list": ('{"hourly": []}', NO_SECTION),
    "empty section": ('{"hourly": {}}', NO_TIME),
    "time absent": (hourly(time="absent"), NO_TIME),
    "time empty": (hourly(time=[]), NO_TIME),
    "time null": (hourly(time=None), NO_TIME),
    "time is text": (hourly(time="now"), NO_TIME),
    "one missing": (hourly(pm10="absent"), "Missing hourly variables: ['pm10']"),
    "two missing": (
        hourly(pm2_5="absent", european_aqi="absent"),
        "Missing hourly variables: ['european_aqi', 'pm2_5']",
    ),
    "not a list": (hourly(pm10={}), "Hourly variable 'pm10' must be a list"),
    "null variable": (hourly(pm10=None), "Hourly variable 'pm10' must be a list"),
    "first in order": (
        hourly(nitrogen_dioxide=1, pm10=[1]),
        "Hourly variable 'pm10' has 1 values; expected 4",
    ),
    "too short": (hourly(pm10=[1]), "Hourly variable 'pm10' has 1 values; expected 4"),
    "empty variable": (hourly(pm2_5=[]), "Hourly variable 'pm2_5' has 0 values; expected 4"),
    "too long": (
        hourly(nitrogen_dioxide=[1, 2, 3]),
        "Hourly variable 'nitrogen_dioxide' has 3 values; expected 4",
    ),
}


@pytest.fixture(scope="module")
def reasons(spark):
    frame = spark.createDataFrame(
        [(name, text) for name, (text, _) in CASES.items()], "name STRING, payload STRING"
    )
    judged = with_reject_reason(frame)
    assert judged.columns == ["name", "payload", "reject_reason"]
    return {r["name"]: r["reject_reason"] for r in judged.collect()}


@pytest.mark.parametrize("name", CASES)
def test_first_broken_rule_is_the_reason(reasons, name):
    assert reasons[name] == CASES[name][1]
