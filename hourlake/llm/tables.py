"""Reading the given tables and keeping intermediate ones where every executor can see them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, with its file system: ``spark.checkpoint.dir``, or a folder of the
    warehouse where that is unset, as in tests. An address without a scheme is on the default file system,
    also for those who open files of it without Spark."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_work"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"))
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(place).toString()


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: cuts the lineage, and what reads it
    survives lost executors."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: Bytes of a batch that goes to Python; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded(frame: DataFrame) -> DataFrame:
    """``frame``, about to go to Python: from now on the session's batches hold ``BATCH_BYTES`` at most, or
    less where it says so itself. Frames are worked out later than they are made, so the setting stays."""
    conf = frame.sparkSession.conf
    now = conf.get(_BATCH).removesuffix("b")
    if not (now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        conf.set(_BATCH, str(BATCH_BYTES))
    return frame


def text_bytes(documents: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, to size partitions by."""
    return documents.agg(F.sum(F.octet_length(text))).first()[0] or 0


def as_bytes(column: str) -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string").cast("binary"), F.lit(b""))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string")) % F.lit(modulus)


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, max_bytes: int
) -> list[tuple[int, bytes, int]]:
    """(doc_id, text bytes, label) of at most ``per_class`` labelled rows of either class, chosen by
    a hash of their id among those where ``learn`` holds. Texts are whole; those longer than
    ``max_bytes`` aren't learned from. Bounded by 2 * per_class rows, so the chosen ids are fit to
    be broadcast, and no text but theirs moves; repeated ids bring in a row each.
    """
    rows = labels.where(learn & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("y"))
    order: Sequence[Column] = (F.xxhash64("doc_id"), F.col("doc_id"))
    texts = documents.select("doc_id", as_bytes("text").alias("data"))
    # Ids of the few long texts go through this join, so the choice is among those to be learned from.
    long = documents.where(F.octet_length(F.col("text")) > max_bytes).select("doc_id")
    fit = rows.join(long, "doc_id", "left_anti")
    texts = texts.where(F.length("data") <= max_bytes)
    negative, positive = (fit.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1))
    chosen = texts.join(F.broadcast(negative.union(positive)), "doc_id").collect()
    return sorted((r.doc_id, bytes(r.data), int(r.y)) for r in chosen)
