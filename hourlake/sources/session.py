"""Settings of the caller's session that a job needs for its own time only."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def utc_session(spark: SparkSession, timezone: str) -> Iterator[None]:
    """The session in the feed's time zone, and back in its own afterwards."""
    with setting(spark, "spark.sql.session.timeZone", timezone):
        yield


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)
