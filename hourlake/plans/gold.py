"""Gold job: Silver rows to one row per city and day."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from hourlake.operators import gates
from hourlake.operators.daily import add_date, counting_method, daily_report
from hourlake.schemas import DAILY_KEY
from hourlake.sources.readers import read_gold, read_silver
from hourlake.sources.session import utc_session
from hourlake.sources.writers import replace_table
from hourlake.spec import DEFAULT_SPEC, HourlySpec


def build_gold(
    spark: SparkSession, silver_path: str, path: str, spec: HourlySpec = DEFAULT_SPEC
) -> int:
    """Replace the Gold table at ``path``; returns its row count. The session's own time zone is
    restored afterwards."""
    with utc_session(spark, spec.timezone):
        return _build_gold(spark, silver_path, path, spec)


def _build_gold(spark: SparkSession, silver_path: str, path: str, spec: HourlySpec) -> int:
    """Replace the Gold table, from one scan and one shuffle of Silver, unless the feed's timestamps have
    seconds: their exact distinct count takes a second shuffle.
    """
    silver = read_silver(spark, silver_path, spec)
    report = daily_report(add_date(silver), spec, counting_method(spec))
    written = Observation()
    counted = report.observe(written, F.count("*").alias("row_count"))

    def check(staging: str) -> None:
        staged = read_gold(spark, staging)
        gates.check_schema(report, staged, "Gold read-back")
        gates.check_keyed_table(
            staged, DAILY_KEY, "Gold read-back", written.get["row_count"]
        )

    replace_table(counted, path, check)
    return written.get["row_count"]
