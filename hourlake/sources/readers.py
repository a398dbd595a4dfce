"""Tables and configuration as DataFrames, always with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake import schemas
from hourlake.operators.accounting import documents_of_run, newest_run
from hourlake.sources.publish import DATA, file_system, is_table, live_folders
from hourlake.spec import DEFAULT_SPEC, HourlySpec

# What a rejected city configuration reports.
NOT_A_LIST = "City configuration must be a list"
EMPTY_LIST = "City configuration list must not be empty"
# End of fixed values.
#: The column by which a Silver table kept by day is stored, and the folder of rows without a day.
DAY_COLUMN, NO_DAY = "measurement_day", "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What a table holds now; a folder that isn't a published table is read as it is.

    The folders that count are looked up once: the frame stays on them, whatever is published later.
    """
    reader = spark.read.schema(schema)
    if not is_table(spark, path):
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(*_published(spark, path)).drop(DATA)


def _published(spark: SparkSession, path: str) -> list[str]:
    folders = list(live_folders(spark, path).values())
    if not folders:
        raise FileNotFoundError(f"nothing has been published to {path}")
    return folders


def read_documents(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    spec: HourlySpec = DEFAULT_SPEC,
    **options: str,
) -> DataFrame:
    """Raw documents from a table or files, or from any connector on the class path via ``fmt``.

    Those of a table also have ``run_day``, the day on which their run started and by which they are stored.
    """
    schema = schemas.raw_document(spec)
    if fmt == "parquet" and path and is_table(spark, path):
        return read_table(spark, path, f"{schema}, run_day DATE")
    reader = spark.read.format(fmt).schema(schema).options(**options)
    return reader.load(path) if path else reader.load()


def read_run_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Run summaries, with ``completed_day``, the day by which they are stored."""
    return read_table(spark, path, f"{schemas.RUN_SUMMARY}, completed_day DATE")


def read_city_lists(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.RUN_CITIES)


def stored_documents_of_run(
    spark: SparkSession, documents_path: str, summaries_path: str, run_id: str, spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    """What one run stored. The run's header tells the day, and only documents of that day are read; a run
    without a header has stored nothing that counts."""
    started = F.to_date("run_started_at_utc")
    days = read_run_summaries(spark, summaries_path).filter(F.col("run_id") == run_id).select(started)
    header = days.first()
    documents = read_documents(spark, documents_path, spec=spec)
    day = F.lit(header[0] if header else None).cast("date")
    on_day = F.col("run_day").eqNullSafe(day) if header else F.lit(False)
    return documents_of_run(documents.filter(on_day), run_id)


def newest_stored_run(spark: SparkSession, summaries_path: str) -> DataFrame:
    """``newest_run`` of the stored summaries, of which only those of the newest day are read: the names of
    the folders tell that day."""
    summaries = read_run_summaries(spark, summaries_path)
    days = _partition_days(spark, summaries_path, "completed_day")
    if days:
        newest = F.lit(max(days)).cast("date")
        summaries = summaries.filter(F.col("completed_day") == newest)
    return newest_run(summaries.drop("completed_day"))


def _partition_days(spark: SparkSession, path: str, column: str) -> list[str]:
    """The days of a table's partitions, from the names of folders; none for rows without a day."""
    folders = live_folders(spark, path).values()
    return [d for folder in folders for d in partition_values(spark, folder, column) if d != NO_DAY]


def partition_values(spark: SparkSession, folder: str, column: str) -> list[str]:
    """The values of a partition column in a data folder, from the names of its folders."""
    files, location = file_system(spark, folder)
    names = (status.getPath().getName() for status in files.listStatus(location))
    return [name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}=")]


def read_silver(spark: SparkSession, path: str, spec: HourlySpec = DEFAULT_SPEC) -> DataFrame:
    """Silver rows, of a table that is replaced as a whole or of one that is kept by day."""
    schema = schemas.ddl(schemas.silver(spec))
    days = silver_days(spark, path)
    if not days:
        return read_table(spark, path, schema)
    return read_silver_days(spark, path, list(days.values()), spec)


def silver_days(spark: SparkSession, path: str) -> dict[str, str]:
    """Key → folder of a Silver table kept by day: ``day-2024-01-31``, or ``aside-`` and a batch."""
    found = {}
    for key, folder in live_folders(spark, path).items():
        kind, _, name = key.partition("-")
        if kind in ("day", "aside"):
            found[key] = f"{folder}/{DAY_COLUMN}={name if kind == 'day' else NO_DAY}"
    return found


def read_silver_days(
    spark: SparkSession, path: str, folders: list[str], spec: HourlySpec = DEFAULT_SPEC
) -> DataFrame:
    schema = schemas.ddl(schemas.silver(spec))
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*folders).drop(DATA, DAY_COLUMN)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Daily rows as written; the schema gate compares what the files say."""
    if not is_table(spark, path):
        return spark.read.parquet(path)
    return spark.read.option("basePath", path).parquet(*_published(spark, path)).drop(DATA)


def city_configuration_issue(text: str = "value") -> Column:
    """Why a configuration text is refused, NULL when it is a non-empty JSON list."""
    entries = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    return F.when(entries.isNull(), F.lit(NOT_A_LIST)).when(F.size(entries) == 0, EMPTY_LIST)


def parse_cities(texts: DataFrame, text: str = "value") -> DataFrame:
    """City rows out of configuration texts, each a JSON list of cities.

    An object at the top would be read as a list of one, so check the issue column first.
    """
    entries = F.from_json(text, f"ARRAY<STRUCT<{schemas.CITY}>>")
    return texts.select(F.inline(entries))


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """City dimension from JSON configuration files, each holding one list.

    JSON across lines has to be read file by file; keep a dimension too large for that as a
    table instead.
    """
    texts = spark.read.text(path, wholetext=True)
    issue = texts.select(F.max(city_configuration_issue())).first()[0]
    if issue is not None:
        raise ValueError(issue)
    return parse_cities(texts)


def source_profile(frame: DataFrame) -> DataFrame:
    """Column names and types of a source, with its row count."""
    columns = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
            )
            for i, f in enumerate(frame.schema.fields)
        )
    )
    return frame.agg(F.count("*").alias("row_count")).select("row_count", F.inline(columns))
