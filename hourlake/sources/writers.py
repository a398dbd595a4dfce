"""Writing tables: batches that are appended once, and overwrites that are checked before they take effect."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.sources.publish import begin, new_folder, publish

# Documents grow manyfold when exploded, so they are stored in small row groups: a scan task
# then starts from a few megabytes instead of a few gigabytes of measurements.
DOCUMENT_ROW_GROUP_BYTES = 16 * 1024 * 1024
#: The key of tables that are replaced as a whole.
WHOLE = "table"


class Batch:
    """Rows that are to be in a table once, whatever number of times their job was started.

    ``write`` puts them into a data folder that no reader looks at; ``publish`` makes them the batch's rows,
    in place of what an earlier start may have published under the same key.
    """

    def __init__(self, path: str, key: str | None = None) -> None:
        self.path, self.key, self.folder = path, key or uuid.uuid4().hex, new_folder(path)

    def write(self, frame: DataFrame, partition: str | None = None, **options: str) -> Batch:
        """Write the rows, in folders by the column ``partition`` if there is one. Adaptive execution splits a
        hot value of it and brings small ones together, so that files are neither huge nor many."""
        begin(frame.sparkSession, self.path)
        if partition:
            frame = frame.hint("rebalance", partition)
        writer = frame.write.options(**options)
        (writer.partitionBy(partition) if partition else writer).parquet(self.folder)
        return self

    def publish(self, spark: SparkSession) -> None:
        publish(spark, self.path, {self.key: self.folder})


def document_batch(documents: DataFrame, path: str, key: str | None = None, **options: str) -> Batch:
    """Write documents by the day on which their run started, without publishing them."""
    options = {"parquet.block.size": str(DOCUMENT_ROW_GROUP_BYTES)} | options
    started = F.col("ingestion_metadata.run_started_at_utc")
    return Batch(path, key).write(documents.withColumn("run_day", F.to_date(started)), "run_day", **options)


def summary_batch(summaries: DataFrame, path: str, key: str | None = None, **options: str) -> Batch:
    """Write run summaries by the day on which their run was completed, without publishing them."""
    day = F.to_date("run_completed_at_utc")
    return Batch(path, key).write(summaries.withColumn("completed_day", day), "completed_day", **options)


def append_documents(
    documents: DataFrame, path: str | None = None, fmt: str = "parquet", batch: str | None = None, **options: str
) -> None:
    """Add documents to a table of Parquet files, once for each ``batch`` key; or through a connector."""
    if fmt == "parquet":
        document_batch(documents, path, batch, **options).publish(documents.sparkSession)
    else:
        _append(documents, path, fmt, options)


def append_run_summaries(
    summaries: DataFrame, path: str | None = None, fmt: str = "parquet", batch: str | None = None, **options: str
) -> None:
    if fmt == "parquet":
        summary_batch(summaries, path, batch, **options).publish(summaries.sparkSession)
    else:
        _append(summaries, path, fmt, options)


def append_city_lists(
    lists: DataFrame, path: str | None = None, fmt: str = "parquet", batch: str | None = None, **options: str
) -> None:
    if fmt == "parquet":
        Batch(path, batch).write(lists, **options).publish(lists.sparkSession)
    else:
        _append(lists, path, fmt, options)


def _append(frame: DataFrame, path: str | None, fmt: str, options: dict[str, str]) -> None:
    frame.write.format(fmt).mode("append").options(**options).save(path)


def replace_table(frame: DataFrame, path: str, check: Callable[[str], None]) -> None:
    """Let a table hold the rows of ``frame`` once ``check`` has passed on the new files.

    The rows go to a new data folder of the table. If the check raises, the table stays as it was and the
    folder is left for inspection. A reader finds the old rows or the new ones at any time.
    """
    batch = Batch(path, WHOLE).write(frame)
    try:
        check(batch.folder)
    except Exception as error:
        error.add_note(f"rejected rows are kept in {batch.folder}")
        raise
    batch.publish(frame.sparkSession)


def work_folder(spark: SparkSession) -> str:
    """A fresh folder for intermediate tables, where all executors and the driver see it: in the
    shared folder that the cluster names, or else in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/hourlake-{uuid.uuid4().hex}"
