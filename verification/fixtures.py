"""Documents, payloads and attempt logs derived from the driver's tables.

``events`` stands in for the sensor feed: a user is a city, four event types are the four
metrics and each event value, in shifted whole cents, is a reading. Every event of every user
is used. All groups built here are bounded: 24 hours a day, 72 slots a document.

Documents are dealt out by city, in as many tasks as the events need: a task's memory stays the same as
the tables grow, and what is grouped by city and anything else needs no further shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourlake.operators.accounting import build_documents
from hourlake.operators.flatten import flatten_documents
from hourlake.spec import DEFAULT_SPEC, HourlySpec

# Which event type feeds which metric.
EVENT_OF_METRIC = {
    "european_aqi": "click",
    "pm10": "view",
    "pm2_5": "purchase",
    "nitrogen_dioxide": "signup",
}
EPOCH = "2024-01-01"
HTTP_CODES = (429, 500, 503, 404, 400, 599)
ENDPOINT = "https://feed.example/hourly"
SOURCE = "events"
# End of fixed values.
#: An event's hour is in three documents at most, or 216 slots: about 2 million measurement rows a task.
EVENTS_PER_TASK = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def task_count(spark: SparkSession, events: int = 0) -> int:
    """Enough tasks to use the whole cluster, and so many that none gets more than its share of events."""
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffles, spark.sparkContext.defaultParallelism, -(-events // EVENTS_PER_TASK))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dimension: one city per customer, in the customer's nation."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.cast("int").alias("city_id"),
        F.col("c_name").alias("city"),
        F.col("n_name").alias("country"),
        ((key * 37 % 18000 - 9000) / 100).alias("latitude"),
        ((key * 91 % 36000 - 18000) / 100).alias("longitude"),
    )


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest reading per city, hour and metric; NULL where there was none."""
    cents = F.round(F.col("value") * 100).cast("bigint") - 1000
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").cast("int").alias("city_id"),
            F.date_trunc("hour", "ts").alias("hour"),
        )
        .agg(
            *(
                F.max(F.when(F.col("event_type") == event, cents)).cast("double").alias(metric)
                for metric, event in EVENT_OF_METRIC.items()
            )
        )
    )


def _day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(EPOCH).cast("date"))


def _slot_times(run_day: Column, city_id: Column, spec: HourlySpec) -> Column:
    """Raw texts of a document's slots in order: mostly an hour, sometimes unparseable, sometimes NULL.

    Each is picked by its place in one list of texts, which is made once for a document; the last place has the
    unparseable text, and no text is before the first.
    """
    window_days = spec.past_days + spec.forecast_days
    slots = window_days * 24
    hours = ",".join(f"@T{hour:02}:00" for hour in range(24))
    days = (F.date_add(run_day, i - spec.past_days).cast("string") for i in range(window_days))
    texts = (F.replace(F.lit(hours), F.lit("@"), day) for day in days)
    choice = F.split(F.concat_ws(",", *texts, F.lit("invalid-timestamp")), ",")
    spread = city_id + _day_number(run_day)

    def place(slot: int) -> Column:
        return F.when((spread + slot) % 17 == 0, slots).when((spread + slot) % 29 == 0, -1).otherwise(slot)

    return F.array(*(F.get(choice, place(slot)) for slot in range(slots)))


def _slot_readings(by_slot: Column, spec: HourlySpec) -> Column:
    """Readings of a document's slots in order. One expression for each slot is compiled; a function over the
    slots would be interpreted, which takes longer."""
    slots = (spec.past_days + spec.forecast_days) * 24
    return F.array(*(F.try_element_at(by_slot, F.lit(slot)) for slot in range(slots)))


def payloads(
    spark: SparkSession, sf_dir: str, spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    """One payload per city and run day: 72 slots from two days before the run day.

    Runs are daily, so an hour shows up in up to three payloads. A run day gets a payload when
    its window holds any reading.
    """
    window_days = spec.past_days + spec.forecast_days
    lag = F.explode(F.sequence(F.lit(0), F.lit(window_days - 1)))
    document = ("city_id", "run_day")
    tasks = task_count(spark, table(spark, sf_dir, "events").count())
    by_slot = F.map_from_entries(F.collect_list(F.struct("slot", "readings")))
    # A list of one, though it is a key: texts made from nothing but keys would also be made for a filter on each
    # reading, and where no reading is asked for, only an aggregate with a list keeps the expressions for the
    # slots in several methods; in one they are too long to be compiled.
    city = F.get(F.collect_set("city_id"), F.lit(0))
    slots = (
        hourly_readings(spark, sf_dir)
        # Arrays are far larger than the readings they are built from, so the number of tasks
        # is set here; going by the size of the readings would leave few, each with a large part of the
        # arrays. A city has one reading an hour at most, so none is hot.
        .repartition(tasks, "city_id")
        .select("*", lag.alias("lag"))
        .select(
            "city_id",
            F.date_add(F.to_date("hour"), F.col("lag")).alias("run_day"),
            ((spec.past_days - F.col("lag")) * 24 + F.hour("hour")).alias("slot"),
            F.struct(*spec.metrics).alias("readings"),
        )
        .groupBy(*document)
        .agg(
            _slot_times(F.col("run_day"), city, spec).alias("time"),
            _slot_readings(by_slot, spec).alias("readings"),
        )
    )
    run_started = F.col("run_day").cast("timestamp") + F.expr("INTERVAL 6 HOURS")
    # Two successive runs share an ingestion time, so the run id has to settle it.
    shift = F.make_dt_interval(days=_day_number(F.col("run_day")) % 2)
    hourly = F.struct("time", *(F.col(f"readings.{m}").alias(m) for m in spec.metrics))
    return slots.select(
        F.concat(F.lit("run-"), F.col("run_day").cast("string")).alias("run_id"),
        "city_id",
        run_started.alias("run_started_at_utc"),
        (run_started - shift).alias("ingested_at_utc"),
        F.struct(hourly.alias("hourly")).alias("raw_payload"),
    )


def documents(
    spark: SparkSession, sf_dir: str, spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    """Raw documents as the ingestion job assembles them."""
    return build_documents(
        cities(spark, sf_dir),
        payloads(spark, sf_dir, spec),
        endpoint=ENDPOINT,
        source=SOURCE,
        spec=spec,
    )


def _class_of(city_id: Column, run_id: Column, classes: int) -> Column:
    """Which of a number of fault classes a city's document of one run falls into."""
    day = F.substring(run_id, 5, 10).cast("date")
    return (city_id + _day_number(day)) % classes


def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened documents, five in thirteen with arrays that break the length rules."""
    flat = flatten_documents(documents(spark, sf_dir))
    fault = _class_of(F.col("city_id"), F.col("run_id"), 13)

    def damaged(name: str) -> Column:
        array = F.col(name)
        chain = F.when(fault == 3, F.slice(array, 1, 71)).when(fault == 4, F.slice(array, 1, 0))
        if name == "pm10_array":
            chain = chain.when(fault == 0, F.slice(array, 1, 71))
        if name in ("pm2_5_array", "time_array"):
            gone = 1 if name == "pm2_5_array" else 2
            chain = chain.when(fault == gone, F.lit(None))
        return chain.otherwise(array).alias(name)

    return flat.select(*(damaged(c) if c.endswith("_array") else c for c in flat.columns))


def payload_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as JSON text, nine in twelve breaking one structure rule each."""
    text = F.to_json("raw_payload")
    fault = _class_of(F.col("city_id"), F.col("run_id"), 12)

    def replaced(column: Column, old: str, new: str) -> Column:
        return F.replace(column, F.lit(old), F.lit(new))

    quota = F.concat(
        F.lit('{"error":true,"reason":"quota of city '),
        F.col("city_id").cast("string"),
        F.lit('"}'),
    )
    faults = [
        F.concat(F.lit("["), text, F.lit("]")),
        quota,
        F.lit('{"error":true}'),
        F.lit('{"hourly":[1,2]}'),
        replaced(text, '"time":', '"clock":'),
        F.lit('{"hourly":{"time":[]}}'),
        replaced(replaced(text, '"pm10":', '"pm":'), '"nitrogen_dioxide":', '"no2":'),
        replaced(text, '"pm2_5":', '"pm2_5":"n/a","pm2_5_list":'),
        replaced(text, '"pm10":[', '"pm10":[1.0,'),
        replaced(text, '{"hourly":', '{"error":"true","hourly":'),
        F.concat(F.lit("{"), text),
    ]
    chain = F.when(F.lit(False), text)
    for number, faulty in enumerate(faults):
        chain = chain.when(fault == number, faulty)
    return payloads(spark, sf_dir).select(
        "run_id",
        "city_id",
        "run_started_at_utc",
        "ingested_at_utc",
        chain.otherwise(text).alias("payload"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response log: up to two failed requests per city and run before the last attempt.

    One city in eleven ends on HTTP 404; the others get their payload, faulty or not.
    """
    tries = _class_of(F.col("city_id"), F.col("run_id"), 3) + 1
    lost = _class_of(F.col("city_id"), F.col("run_id"), 11) == 0
    attempt, last = F.col("attempt"), F.col("attempt") == F.col("tries")
    answered = last & ~lost
    code = F.when(last, F.lit(404)).when(attempt == 2, F.lit(503))
    kind = F.when(code.isNotNull(), "http").otherwise("network")
    return (
        payload_texts(spark, sf_dir)
        .withColumn("tries", tries)
        .withColumn("attempt", F.explode(F.sequence(F.lit(1), F.col("tries"))))
        .select(
            "run_id",
            "city_id",
            F.concat(F.lit("city-"), F.col("city_id").cast("string")).alias("city"),
            "attempt",
            F.when(~answered, kind).alias("error_kind"),
            F.when(~answered, code).alias("http_code"),
            F.when(~answered, F.concat(F.lit("no answer to attempt "), attempt.cast("string")))
            .alias("error_message"),
            F.when(answered, F.col("payload")).alias("payload"),
            "run_started_at_utc",
            "ingested_at_utc",
        )
    )


def response_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of the response log; each meant to reach every city that was logged."""
    return (
        payloads(spark, sf_dir)
        .groupBy("run_id", "run_started_at_utc")
        .agg(
            (F.max("ingested_at_utc") + F.expr("INTERVAL 1 HOUR")).alias("run_completed_at_utc"),
            F.count("*").alias("cities_intended"),
        )
    )


def _attempt_keys(events: DataFrame, tries: int | None) -> DataFrame:
    """Events as numbered attempts: every ``tries`` events of a user's day are one run's; without
    a number all of them are."""
    day = F.to_date("ts").cast("string")
    shard = F.lpad((F.col("user_id") % 50).cast("string"), 2, "0")
    in_order = Window.partitionBy("day", "city_id").orderBy("ts", "event_id")
    numbered = events.withColumns(
        {"day": day, "shard": shard, "city_id": F.col("user_id").cast("int")}
    ).withColumn("place", F.row_number().over(in_order) - 1)
    group = F.floor(F.col("place") / tries) if tries else F.lit(0)
    return numbered.withColumns(
        {
            "run_id": F.concat_ws("-", F.lit("run"), "day", "shard", group.cast("string")),
            "attempt": (F.col("place") % tries if tries else F.col("place")).cast("int") + 1,
        }
    )


def attempts(
    spark: SparkSession, sf_dir: str, tries: int | None = DEFAULT_SPEC.max_attempts
) -> DataFrame:
    """Attempt log: each event of a user's day is an attempt at that city, so many in a run."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    codes = F.array(*map(F.lit, HTTP_CODES))
    return (
        _attempt_keys(table(spark, sf_dir, "events"), tries)
        .select(
            "run_id",
            "city_id",
            F.concat(F.lit("city-"), F.col("city_id").cast("string")).alias("city"),
            "attempt",
            (kind == "purchase").alias("ok"),
            F.when(kind == "error", "http")
            .when(kind == "click", "network")
            .when(kind == "view", "validation")
            .when(kind == "signup", F.when(k % 2 == 0, "storage").otherwise("unexpected"))
            .alias("error_kind"),
            F.when(kind == "error", F.get(codes, k % len(HTTP_CODES))).alias("http_code"),
            F.when(
                kind != "purchase",
                F.concat(kind, F.lit(" #"), F.col("event_id").cast("string")),
            ).alias("error_message"),
        )
    )


def tied_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempt log in which two neighbouring events of a user's day have one attempt number."""
    log = attempts(spark, sf_dir, tries=2 * DEFAULT_SPEC.max_attempts)
    return log.withColumn("attempt", F.floor((F.col("attempt") + 1) / 2).cast("int"))


def attempt_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of the attempt log, from first to last event."""
    return (
        _attempt_keys(table(spark, sf_dir, "events"), DEFAULT_SPEC.max_attempts)
        .groupBy("run_id")
        .agg(
            F.min("ts").cast("timestamp").alias("run_started_at_utc"),
            F.max("ts").cast("timestamp").alias("run_completed_at_utc"),
            F.count_distinct("city_id").alias("cities_intended"),
        )
    )


def city_configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration texts of at most 100 cities each; some hold an object or no city."""
    entry = F.struct("city_id", "city", "country", "latitude", "longitude")
    number = F.floor(F.col("city_id") / 100)
    fault = F.col("configuration") % 7
    text = F.to_json(F.sort_array(F.collect_list(entry)))
    return (
        cities(spark, sf_dir)
        .groupBy(number.cast("int").alias("configuration"))
        .agg(text.alias("text"))
        .select(
            "configuration",
            F.when(fault == 3, F.concat(F.lit('{"cities":'), "text", F.lit("}")))
            .when(fault == 5, "[]")
            .otherwise(F.col("text"))
            .alias("value"),
        )
    )
