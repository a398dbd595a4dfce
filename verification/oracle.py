"""The registered queries as plain SQL, written independently of the Spark code."""

from __future__ import annotations

METRICS = ("european_aqi", "pm10", "pm2_5", "nitrogen_dioxide")
METRIC_LIST = ", ".join(METRICS)
FLAGS = ("is_valid_measurement_timestamp", *(f"is_valid_{m}" for m in METRICS))
FLAG_LIST = ", ".join(FLAGS)
VARIABLES = ",".join(METRICS)


def _each(template: str, separator: str = ", ") -> str:
    return separator.join(template.format(m=m) for m in METRICS)


CITIES = """
cities AS (
  SELECT CAST(c_custkey AS INTEGER) AS city_id, c_name AS city, n_name AS country,
    CAST(c_custkey * 37 % 18000 - 9000 AS DOUBLE) / 100 AS latitude,
    CAST(c_custkey * 91 % 36000 - 18000 AS DOUBLE) / 100 AS longitude
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

# One row per document and slot, before anything is parsed.
SLOTS = f"""{CITIES},
hourly AS (
  SELECT CAST(user_id AS INTEGER) AS city_id, date_trunc('hour', ts) AS hour,
    {", ".join(
        f"max(CASE WHEN event_type = '{event}' THEN CAST(round(value * 100) AS BIGINT) - 1000 END)"
        f" AS {metric}"
        for metric, event in zip(METRICS, ("click", "view", "purchase", "signup"))
    )}
  FROM events GROUP BY ALL
),
windows AS (
  SELECT DISTINCT city_id, CAST(hour AS DATE) + CAST(lag AS INTEGER) AS run_day
  FROM hourly, range(3) lags(lag)
),
places AS (
  SELECT city_id, run_day, CAST(i AS INTEGER) AS i,
    city_id + i + date_diff('day', DATE '2024-01-01', run_day) AS spread,
    date_diff('day', DATE '2024-01-01', run_day) AS day_number,
    CAST(run_day AS TIMESTAMP) + (i - 48) * INTERVAL 1 HOUR AS slot
  FROM windows, range(72) slots(i)
),
slots AS (
  SELECT 'run-' || strftime(run_day, '%Y-%m-%d') AS run_id, city_id, i, day_number,
    CAST(run_day AS TIMESTAMP) + INTERVAL 6 HOUR AS run_started_at_utc,
    CAST(run_day AS TIMESTAMP) + INTERVAL 6 HOUR - (day_number % 2) * INTERVAL 1 DAY
      AS ingested_at_utc,
    CASE WHEN spread % 17 = 0 THEN 'invalid-timestamp' WHEN spread % 29 = 0 THEN NULL
      ELSE strftime(slot, '%Y-%m-%dT%H:%M') END AS raw,
    {_each("CAST({m} AS DOUBLE) AS {m}")}
  FROM places LEFT JOIN (SELECT *, hour AS slot FROM hourly) USING (city_id, slot)
)"""

DOCUMENTS = f"""{SLOTS},
documents_flat AS (
  SELECT run_id, city_id, any_value(day_number) AS day_number,
    any_value(run_started_at_utc) AS run_started_at_utc,
    any_value(ingested_at_utc) AS ingested_at_utc,
    list(raw ORDER BY i) AS time_array, {_each("list({m} ORDER BY i) AS {m}_array")}
  FROM slots GROUP BY run_id, city_id
)"""

DAMAGED_SLOTS = f"""{SLOTS},
damaged AS (
  SELECT run_id, city_id, i, raw, (city_id + day_number) % 13 AS fault, {METRIC_LIST} FROM slots
)"""

MEASUREMENTS = f"""{SLOTS},
measured AS (
  SELECT run_id, s.city_id, city, country, latitude AS requested_latitude,
    longitude AS requested_longitude, ingested_at_utc, raw AS measurement_timestamp_raw,
    {METRIC_LIST}
  FROM slots s JOIN cities c ON s.city_id = c.city_id
),
parsed AS (
  SELECT *, CASE WHEN length(measurement_timestamp_raw) = 16
      THEN try_strptime(measurement_timestamp_raw, '%Y-%m-%dT%H:%M') END AS measurement_timestamp
  FROM measured
),
checked AS (
  SELECT *,
    measurement_timestamp_raw IS NOT NULL AND measurement_timestamp IS NOT NULL
      AS is_valid_measurement_timestamp,
    {_each("{m} IS NOT NULL AND {m} >= 0 AS is_valid_{m}")}
  FROM parsed
)"""

RANKED = f"""{MEASUREMENTS},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY city_id, measurement_timestamp
      ORDER BY ingested_at_utc DESC, run_id DESC) AS recency_rank,
    count(*) OVER (PARTITION BY city_id, measurement_timestamp) AS record_count
  FROM checked WHERE is_valid_measurement_timestamp
),
latest AS (SELECT * EXCLUDE (recency_rank, record_count) FROM ranked WHERE recency_rank = 1)"""

SILVER_COLUMNS = f"""run_id, ingested_at_utc, city_id, city, country, requested_latitude,
  requested_longitude, measurement_timestamp, measurement_timestamp_raw, {METRIC_LIST}, {FLAG_LIST}"""


def _daily(source: str) -> str:
    """Rollup, peak and report over the valid rows of a CTE."""
    fully = " AND ".join(f"valid_daily_{m}_count = 24" for m in METRICS)
    return f"""
dated AS (
  SELECT *, CAST(measurement_timestamp AS DATE) AS measurement_date FROM {source}
  WHERE is_valid_measurement_timestamp
),
sums AS (
  SELECT city_id, measurement_date, min(city) AS city,
    {_each("avg({m}) FILTER (is_valid_{m}) AS average_{m}")},
    {_each("max({m}) FILTER (is_valid_{m}) AS maximum_{m}")},
    count(DISTINCT measurement_timestamp) AS observed_hour_count,
    {_each("count(*) FILTER (is_valid_{m}) AS valid_daily_{m}_count")}
  FROM dated GROUP BY city_id, measurement_date
),
rollup_rows AS (
  SELECT *, CAST(24 AS INTEGER) AS expected_hour_count,
    observed_hour_count / 24.0::DOUBLE * 100 AS completeness_percentage,
    observed_hour_count = 24 AS is_complete_day,
    observed_hour_count = 24 AND {fully} AS is_fully_valid_day
  FROM sums
),
peaks AS (
  SELECT city_id, measurement_date, measurement_timestamp AS maximum_european_aqi_timestamp
  FROM (
    SELECT *, row_number() OVER (PARTITION BY city_id, measurement_date
      ORDER BY european_aqi DESC, measurement_timestamp) AS n
    FROM dated WHERE is_valid_european_aqi
  ) WHERE n = 1
)"""


DAILY = f"{RANKED},{_daily('latest')}"
GOLD = f"""WITH {DAILY}
SELECT * FROM rollup_rows LEFT JOIN peaks USING (city_id, measurement_date)"""

DOCUMENT_SUMMARY = f"""WITH {DOCUMENTS}
SELECT run_id, d.city_id, city, country, latitude AS requested_latitude,
  longitude AS requested_longitude, 'https://feed.example/hourly' AS endpoint,
  '{VARIABLES}' AS hourly_variables, 'UTC' AS timezone, CAST(1 AS INTEGER) AS forecast_days,
  CAST(2 AS INTEGER) AS past_days, run_started_at_utc, ingested_at_utc, 'events' AS source,
  'ingest_complete' AS status, CAST(len(time_array) AS INTEGER) AS time_count,
  {_each("CAST(len([x FOR x IN {m}_array IF x IS NOT NULL]) AS INTEGER) AS {m}_count")}
FROM documents_flat d JOIN cities c ON d.city_id = c.city_id"""

UNNESTED = f"""WITH {MEASUREMENTS} SELECT * FROM measured"""

# Rows without a valid timestamp each stand alone: document and raw text keep them apart.
SILVER = f"""WITH {MEASUREMENTS}
SELECT {SILVER_COLUMNS} FROM checked
QUALIFY NOT is_valid_measurement_timestamp OR row_number() OVER (
  PARTITION BY city_id, measurement_timestamp,
    CASE WHEN NOT is_valid_measurement_timestamp THEN run_id END
  ORDER BY ingested_at_utc DESC, run_id DESC) = 1"""

PAYLOADS = f"""{DOCUMENTS},
base AS (
  SELECT run_id, city_id, run_started_at_utc, ingested_at_utc, day_number,
    (city_id + day_number) % 12 AS fault,
    CAST(to_json({{'hourly': {{'time': time_array, {_each("'{m}': {m}_array")}}}}}) AS VARCHAR)
      AS text
  FROM documents_flat
),
payload_texts AS (
  SELECT * EXCLUDE (text, fault), CASE fault
    WHEN 0 THEN '[' || text || ']'
    WHEN 1 THEN '{{"error":true,"reason":"quota of city ' || city_id || '"}}'
    WHEN 2 THEN '{{"error":true}}'
    WHEN 3 THEN '{{"hourly":[1,2]}}'
    WHEN 4 THEN replace(text, '"time":', '"clock":')
    WHEN 5 THEN '{{"hourly":{{"time":[]}}}}'
    WHEN 6 THEN replace(replace(text, '"pm10":', '"pm":'), '"nitrogen_dioxide":', '"no2":')
    WHEN 7 THEN replace(text, '"pm2_5":', '"pm2_5":"n/a","pm2_5_list":')
    WHEN 8 THEN replace(text, '"pm10":[', '"pm10":[1.0,')
    WHEN 9 THEN replace(text, '{{"hourly":', '{{"error":"true","hourly":')
    WHEN 10 THEN '{{' || text
    ELSE text END AS payload
  FROM base
),
parsed_payloads AS (
  SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS j FROM payload_texts
),
looked_up AS (
  SELECT *, json_type(j) AS kind, json_type(j, '$.hourly') AS hourly_kind,
    json_type(j, '$.hourly.time') AS time_kind, json_array_length(j, '$.hourly.time') AS n,
    [v FOR v IN {sorted(METRICS)} IF json_type(j, '$.hourly.' || v) IS NULL] AS missing
  FROM parsed_payloads
),
judged AS (
  SELECT *, CASE
    WHEN kind IS NULL OR kind <> 'OBJECT' THEN 'API response must be a dictionary'
    WHEN json_type(j, '$.error') = 'BOOLEAN' AND j ->> '$.error' = 'true'
      THEN 'API returned an error: ' || coalesce(j ->> '$.reason', 'Unknown API error')
    WHEN hourly_kind IS NULL OR hourly_kind <> 'OBJECT'
      THEN 'API response does not contain a valid hourly section'
    WHEN time_kind IS NULL OR time_kind <> 'ARRAY' OR n = 0
      THEN 'hourly.time must be a non-empty list'
    WHEN len(missing) > 0
      THEN 'Missing hourly variables: [''' || array_to_string(missing, ''', ''') || ''']'
    {_each("""WHEN json_type(j, '$.hourly.{m}') <> 'ARRAY'
      THEN 'Hourly variable ''{m}'' must be a list'
    WHEN json_array_length(j, '$.hourly.{m}') <> n
      THEN 'Hourly variable ''{m}'' has ' || json_array_length(j, '$.hourly.{m}')
        || ' values; expected ' || n""", " ")}
    END AS reject_reason
  FROM looked_up
)"""

ATTEMPTS = """
placed AS (
  SELECT *, 'run-' || strftime(ts, '%Y-%m-%d') || '-' || lpad(CAST(user_id % 50 AS VARCHAR), 2, '0')
      AS shard, CAST(user_id AS INTEGER) AS city_id,
    CAST(json_extract(props, '$.k') AS INTEGER) AS k,
    row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id ORDER BY ts, event_id) AS place
  FROM events
),
keyed AS (SELECT *, shard || '-' || (place - 1) // 3 AS run_id FROM placed),
numbered AS (SELECT *, CAST((place - 1) % 3 + 1 AS INTEGER) AS attempt FROM keyed),
attempts AS (
  SELECT run_id, city_id, 'city-' || city_id AS city, attempt, event_type = 'purchase' AS ok,
    CASE event_type WHEN 'error' THEN 'http' WHEN 'click' THEN 'network'
      WHEN 'view' THEN 'validation'
      WHEN 'signup' THEN CASE WHEN k % 2 = 0 THEN 'storage' ELSE 'unexpected' END
      END AS error_kind,
    CASE WHEN event_type = 'error'
      THEN CAST([429, 500, 503, 404, 400, 599][k % 6 + 1] AS INTEGER) END AS http_code,
    CASE WHEN event_type <> 'purchase' THEN event_type || ' #' || event_id END AS error_message
  FROM numbered
),
classified AS (
  SELECT *, CASE WHEN ok THEN 'success'
    WHEN error_kind = 'network' THEN 'retryable'
    WHEN error_kind = 'http' AND (http_code = 429 OR http_code // 100 = 5) THEN 'retryable'
    ELSE 'final' END AS failure_class
  FROM attempts
)"""


#: Two neighbouring events of a user's day share an attempt number; six of them are one run's.
TIED_ATTEMPTS = ATTEMPTS.replace("(place - 1) // 3", "(place - 1) // 6").replace(
    "(place - 1) % 3 + 1", "((place - 1) % 6) // 2 + 1"
)


def _outcomes(source: str) -> str:
    """Per city the first attempt that ended the tries, or else the last attempt."""
    return f"""
ended AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, city_id
    ORDER BY CASE WHEN failure_class = 'retryable' THEN 1 ELSE 0 END,
      CASE WHEN failure_class = 'retryable' THEN -attempt ELSE attempt END) AS n
  FROM {source}
),
outcomes AS (
  SELECT run_id, city_id, city, attempt AS attempts_made, ok AS succeeded, error_message
  FROM ended WHERE n = 1
),
tallies AS (
  SELECT run_id, count(*) FILTER (succeeded) AS successful_ingestions,
    count(*) FILTER (NOT succeeded) AS failed_ingestions
  FROM outcomes GROUP BY run_id
),
run_rows AS (
  SELECT r.run_id, run_started_at_utc, run_completed_at_utc,
    CASE WHEN coalesce(successful_ingestions, 0) = cities_intended THEN 'completed'
      WHEN successful_ingestions > 0 THEN 'partial_failure' ELSE 'failed' END AS status,
    cities_intended, coalesce(successful_ingestions, 0) AS successful_ingestions,
    coalesce(failed_ingestions, 0) AS failed_ingestions
  FROM runs r LEFT JOIN tallies t ON r.run_id = t.run_id
)"""


RUNS = f"""{ATTEMPTS},{_outcomes("classified")}""".replace(
    "run_rows AS (",
    """runs AS (
  SELECT run_id, min(ts) AS run_started_at_utc, max(ts) AS run_completed_at_utc,
    count(DISTINCT city_id) AS cities_intended
  FROM keyed GROUP BY run_id
),
run_rows AS (""",
)
RUN_COLUMNS = """run_id, run_started_at_utc, run_completed_at_utc, status, cities_intended,
  successful_ingestions, failed_ingestions"""
SUMMARY_COLUMNS = f"""{RUN_COLUMNS}, '{VARIABLES}' AS hourly_variables,
  CAST(2 AS INTEGER) AS past_days, CAST(1 AS INTEGER) AS forecast_days, 'UTC' AS timezone"""

CONFIGURATIONS = f"""{CITIES},
numbered AS (SELECT *, CAST(city_id // 100 AS INTEGER) AS configuration FROM cities)"""

RESPONSES = f"""{PAYLOADS},
tries AS (
  SELECT *, (city_id + day_number) % 3 + 1 AS tries, (city_id + day_number) % 11 = 0 AS lost
  FROM judged
),
tried AS (
  SELECT run_id, city_id, 'city-' || city_id AS city, CAST(attempt AS INTEGER) AS attempt,
    attempt = tries AND NOT lost AND reject_reason IS NULL AS ok,
    CASE WHEN attempt = tries AND NOT lost THEN
        CASE WHEN reject_reason IS NULL THEN 'success' ELSE 'final' END
      WHEN attempt = tries THEN 'final' ELSE 'retryable' END AS failure_class,
    CASE WHEN attempt = tries AND NOT lost THEN reject_reason
      ELSE 'no answer to attempt ' || attempt END AS error_message
  FROM tries, range(1, 4) numbers(attempt) WHERE attempt <= tries
),
runs AS (
  SELECT run_id, run_started_at_utc,
    max(ingested_at_utc) + INTERVAL 1 HOUR AS run_completed_at_utc, count(*) AS cities_intended
  FROM judged GROUP BY run_id, run_started_at_utc
),{_outcomes("tried")}"""

LENGTHS = f"""{DAMAGED_SLOTS},
lengths AS (
  SELECT run_id, city_id, fault,
    CASE fault WHEN 2 THEN NULL WHEN 3 THEN 71 WHEN 4 THEN 0 ELSE 72 END AS time_count,
    CASE fault WHEN 3 THEN 71 WHEN 4 THEN 0 ELSE 72 END AS european_aqi_count,
    CASE fault WHEN 0 THEN 71 WHEN 3 THEN 71 WHEN 4 THEN 0 ELSE 72 END AS pm10_count,
    CASE fault WHEN 1 THEN NULL WHEN 3 THEN 71 WHEN 4 THEN 0 ELSE 72 END AS pm2_5_count,
    CASE fault WHEN 3 THEN 71 WHEN 4 THEN 0 ELSE 72 END AS nitrogen_dioxide_count
  FROM (SELECT DISTINCT run_id, city_id, fault FROM damaged)
)"""
LENGTH_ISSUE = f"""({_each("{m}_count <> time_count OR {m}_count IS NULL", " OR ")}
  OR time_count <> 72 OR time_count IS NULL)"""

_GOLD = [
    ("city_id", "int"),
    ("measurement_date", "date"),
    ("city", "string"),
    *((f"{name}_{m}", "double") for m in METRICS for name in ("average", "maximum")),
    ("observed_hour_count", "bigint"),
    *((f"valid_daily_{m}_count", "bigint") for m in METRICS),
    ("expected_hour_count", "int"),
    ("completeness_percentage", "double"),
    ("is_complete_day", "boolean"),
    ("is_fully_valid_day", "boolean"),
    ("maximum_european_aqi_timestamp", "timestamp_ntz"),
]
GOLD_COLUMNS = ", ".join(f"({n}, '{name}', '{kind}')" for n, (name, kind) in enumerate(_GOLD))

ORACLE_SQL: dict[str, str] = {
    "gold_daily_summary": GOLD,
    "source_profile": """
SELECT CAST(column_index AS INTEGER) - 1 AS position, column_name,
  CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
    ELSE lower(data_type) END AS column_type,
  (SELECT count(*) FROM events) AS row_count
FROM duckdb_columns() WHERE table_name = 'events'""",
    "city_configuration_issues": f"""WITH {CONFIGURATIONS}
SELECT DISTINCT configuration, CASE configuration % 7
  WHEN 3 THEN 'City configuration must be a list'
  WHEN 5 THEN 'City configuration list must not be empty' END AS issue FROM numbered""",
    "city_dimension": f"""WITH {CONFIGURATIONS}
SELECT city_id, city, country, latitude, longitude FROM numbered
WHERE configuration % 7 NOT IN (3, 5)""",
    "request_urls": f"""WITH {CITIES}
SELECT city_id, 'https://feed.example/hourly?latitude=' || latitude || '&longitude=' || longitude
  || '&hourly={"%2C".join(METRICS)}&timezone=UTC&forecast_days=1&past_days=2' AS request_url
FROM cities""",
    "raw_documents": DOCUMENT_SUMMARY,
    "documents_roundtrip": DOCUMENT_SUMMARY,
    "flatten_documents": f"""WITH {DOCUMENTS}
SELECT run_id, d.city_id, city, country, latitude AS requested_latitude,
  longitude AS requested_longitude, ingested_at_utc,
  array_to_string([coalesce(x, '-') FOR x IN time_array], ',') AS time_array,
  {_each("array_to_string([coalesce(CAST(CAST(x AS BIGINT) AS VARCHAR), '-')"
         " FOR x IN {m}_array], ',') AS {m}_array")}
FROM documents_flat d JOIN cities c ON d.city_id = c.city_id""",
    "array_length_issues": f"""WITH {LENGTHS}
SELECT run_id, city_id, time_count, {_each("{m}_count")} FROM lengths WHERE {LENGTH_ISSUE}""",
    "zip_explode": UNNESTED,
    "zip_explode_uneven": f"""WITH {DAMAGED_SLOTS}
SELECT run_id, city_id, count(*) AS row_count, count(raw) AS measurement_timestamp_raw_count,
  {_each("count({m}) AS {m}_count")}
FROM (
  SELECT * REPLACE (CASE WHEN fault = 0 AND i = 71 THEN NULL ELSE pm10 END AS pm10) FROM damaged
  WHERE fault NOT IN (1, 2, 4) AND NOT (fault = 3 AND i = 71)
) GROUP BY run_id, city_id""",
    "unnest_equal_arrays": UNNESTED,
    "parse_timestamps": f"""WITH {MEASUREMENTS}
SELECT run_id, city_id, measurement_timestamp_raw, measurement_timestamp,
  is_valid_measurement_timestamp FROM checked""",
    "metric_validity_flags": f"""WITH {MEASUREMENTS}
SELECT run_id, city_id, measurement_timestamp_raw, {METRIC_LIST},
  {_each("is_valid_{m}")} FROM checked""",
    "validity_census": f"""WITH {MEASUREMENTS}
SELECT {FLAG_LIST}, count(*) AS count FROM checked GROUP BY ALL""",
    "document_profile": f"""WITH {LENGTHS},
sound AS (
  SELECT d.* FROM damaged d JOIN lengths l USING (run_id, city_id) WHERE NOT {LENGTH_ISSUE}
),
flagged AS (
  SELECT coalesce(raw LIKE '2%', FALSE) AS is_valid_measurement_timestamp,
    {_each("coalesce({m} >= 0, FALSE) AS is_valid_{m}")}, 1 AS n, 0 AS issues FROM sound
  UNION ALL
  SELECT FALSE, FALSE, FALSE, FALSE, FALSE, 0, 1 FROM lengths WHERE {LENGTH_ISSUE}
)
SELECT {FLAG_LIST}, CAST(sum(n) AS BIGINT) AS count, CAST(sum(issues) AS BIGINT) AS length_issues
FROM flagged GROUP BY ALL""",
    "valid_timestamp_rows": f"""WITH {MEASUREMENTS}
SELECT * FROM checked WHERE is_valid_measurement_timestamp""",
    "invalid_timestamp_rows": f"""WITH {MEASUREMENTS}
SELECT * FROM checked WHERE NOT is_valid_measurement_timestamp""",
    "duplicate_keys": f"""WITH {MEASUREMENTS}
SELECT city_id, measurement_timestamp, count(*) AS record_count FROM checked
WHERE is_valid_measurement_timestamp GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_summary": f"""WITH {MEASUREMENTS}
SELECT count(*) AS duplicate_key_groups, CAST(sum(n - 1) AS BIGINT) AS redundant_rows,
  max(n) AS max_records_per_key
FROM (
  SELECT count(*) AS n FROM checked WHERE is_valid_measurement_timestamp
  GROUP BY city_id, measurement_timestamp HAVING count(*) > 1
)""",
    "recency_rank": f"""WITH {RANKED}
SELECT run_id, ingested_at_utc, city_id, measurement_timestamp,
  CAST(recency_rank AS INTEGER) AS recency_rank FROM ranked WHERE recency_rank <= 3""",
    "latest_dedupe": f"WITH {RANKED} SELECT * FROM latest",
    "latest_with_counts": f"""WITH {RANKED}
SELECT * EXCLUDE (recency_rank) FROM ranked WHERE recency_rank = 1""",
    "silver_rows": SILVER,
    "daily_rollup": f"WITH {DAILY} SELECT * FROM rollup_rows",
    "daily_rollup_unique": f"WITH {DAILY} SELECT * FROM rollup_rows",
    "daily_rollup_repeated": f"WITH {MEASUREMENTS},{_daily('checked')} SELECT * FROM rollup_rows",
    "daily_rollup_whole_hours": f"WITH {MEASUREMENTS},{_daily('checked')}"
    " SELECT * FROM rollup_rows",
    "daily_rollup_minutes": f"""WITH {MEASUREMENTS},
moved AS (
  SELECT * REPLACE (measurement_timestamp + CAST((city_id
      + date_diff('day', DATE '2024-01-01', CAST(substr(run_id, 5, 10) AS DATE))) % 60 AS INTEGER)
      * INTERVAL 1 MINUTE AS measurement_timestamp) FROM checked
),{_daily('moved')} SELECT * FROM rollup_rows""",
    "daily_peak": f"WITH {DAILY} SELECT * FROM peaks",
    "daily_peak_texts": f"""WITH {DAILY}
SELECT city_id, measurement_date,
  strftime(maximum_european_aqi_timestamp, '%Y-%m-%d %H:%M:%S') AS peak_time FROM peaks""",
    "daily_report_repeated": f"""WITH {MEASUREMENTS},{_daily('checked')}
SELECT * FROM rollup_rows LEFT JOIN peaks USING (city_id, measurement_date)""",
    "daily_completeness": f"""WITH {DAILY}
SELECT city_id, measurement_date, observed_hour_count, expected_hour_count,
  completeness_percentage, is_complete_day, is_fully_valid_day FROM rollup_rows""",
    "daily_left_join": GOLD,
    "stage_row_counts": f"""WITH {DAILY}
SELECT 'documents' AS stage, count(DISTINCT (run_id, city_id)) AS row_count FROM slots
UNION ALL SELECT 'measurements', count(*) FROM checked
UNION ALL SELECT 'silver', (SELECT count(*) FROM latest)
  + (SELECT count(*) FROM checked WHERE NOT is_valid_measurement_timestamp)
UNION ALL SELECT 'gold', count(*) FROM rollup_rows""",
    "null_key_rows": f"""WITH {MEASUREMENTS}
SELECT run_id, city_id, measurement_timestamp_raw,
  CAST(measurement_timestamp AS DATE) AS measurement_date
FROM checked WHERE city_id IS NULL OR measurement_timestamp IS NULL""",
    "duplicate_business_keys": f"""WITH {MEASUREMENTS}
SELECT city_id, CAST(measurement_timestamp AS DATE) AS measurement_date, count(*) AS count
FROM checked GROUP BY ALL HAVING count(*) > 1""",
    "run_id_uniqueness": f"""WITH {RUNS}
SELECT run_id, count(*) AS count
FROM (SELECT run_id FROM run_rows UNION ALL SELECT run_id FROM run_rows WHERE status = 'failed')
GROUP BY run_id HAVING count(*) > 1""",
    "payload_reject_reasons": f"WITH {PAYLOADS} SELECT run_id, city_id, reject_reason FROM judged",
    "attempt_classification": f"WITH {ATTEMPTS} SELECT * FROM classified",
    "city_outcomes": f"WITH {RUNS} SELECT * FROM outcomes",
    "run_status": f"WITH {RUNS} SELECT {RUN_COLUMNS} FROM run_rows",
    "run_summary": f"WITH {RUNS} SELECT {SUMMARY_COLUMNS} FROM run_rows",
    "run_summary_roundtrip": f"WITH {RUNS} SELECT {SUMMARY_COLUMNS} FROM run_rows",
    "attempt_limit_violations": f"""WITH {ATTEMPTS}
SELECT shard || '-0' AS run_id, city_id, CAST(place AS INTEGER) AS attempt FROM placed
WHERE place > 3""",
    "run_city_lists": f"""WITH {RUNS}
SELECT run_id, CAST(city_id // 10 AS BIGINT) AS block,
  coalesce(string_agg(city_id || ':' || city || ':' || attempts_made, ',' ORDER BY city_id)
    FILTER (succeeded), '') AS successful_cities,
  coalesce(string_agg(city_id || ':' || city || ':' || error_message || ':' || attempts_made,
    ',' ORDER BY city_id) FILTER (NOT succeeded), '') AS failed_cities
FROM outcomes GROUP BY run_id, city_id // 10""",
    "newest_run": f"""WITH {RUNS} SELECT {RUN_COLUMNS} FROM run_rows
ORDER BY run_completed_at_utc DESC, run_id DESC LIMIT 1""",
    "documents_of_run": f"""WITH {DOCUMENTS}
SELECT run_id, d.city_id, city, ingested_at_utc
FROM documents_flat d JOIN cities c ON d.city_id = c.city_id WHERE run_id = 'run-2024-01-15'""",
    "documents_per_run": f"""WITH {DOCUMENTS}
SELECT run_id, count(*) AS document_count FROM documents_flat GROUP BY run_id""",
    "stored_documents_of_run": f"""WITH {DOCUMENTS}
SELECT run_id, d.city_id, city, ingested_at_utc
FROM documents_flat d JOIN cities c ON d.city_id = c.city_id WHERE run_id = 'run-2024-01-15'""",
    "newest_stored_run": f"""WITH {RUNS} SELECT {SUMMARY_COLUMNS} FROM run_rows
ORDER BY run_completed_at_utc DESC, run_id DESC LIMIT 1""",
    "read_cities": f"""WITH {CONFIGURATIONS}
SELECT city_id, city, country, latitude, longitude FROM numbered
WHERE configuration % 7 NOT IN (3, 5)""",
    "city_outcomes_tied": f"""WITH {TIED_ATTEMPTS}
SELECT run_id, city_id, city, attempt AS attempts_made, ok AS succeeded, error_message
FROM classified
QUALIFY row_number() OVER (PARTITION BY run_id, city_id
  ORDER BY failure_class = 'retryable',
    CASE WHEN failure_class = 'retryable' THEN -attempt ELSE attempt END,
    ok DESC, error_kind NULLS FIRST, http_code NULLS FIRST, error_message NULLS FIRST) = 1""",
    "unlisted_city_documents": f"""WITH {DOCUMENTS}
SELECT run_id, city_id FROM documents_flat
WHERE city_id NOT IN (SELECT city_id FROM cities WHERE city_id % 10 <> 0)""",
    "gold_schema": f"""WITH {DAILY},
daily AS (SELECT count(*) AS row_count FROM rollup_rows)
SELECT CAST(n AS INTEGER) AS position, name AS column_name, kind AS column_type, row_count
FROM daily, (VALUES {GOLD_COLUMNS}) named(n, name, kind)""",
    "silver_roundtrip": SILVER,
    "silver_increments": SILVER,
    "gold_roundtrip": GOLD,
    "ingestion_roundtrip": f"""WITH {RESPONSES},
stored AS (
  SELECT run_id, count(*) AS document_count,
    CAST(sum(length(payload)) AS BIGINT) AS payload_characters
  FROM tried JOIN judged USING (run_id, city_id) WHERE ok GROUP BY run_id
)
SELECT {SUMMARY_COLUMNS}, document_count, payload_characters FROM run_rows LEFT JOIN stored USING (run_id)""",
}
