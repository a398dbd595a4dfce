"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
from oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# Queries over texts have tests of their own.
QUERIES = {n: q for n, q in driver.queries().items() if n not in driver.LLM_QUERIES}
ORACLES = {n: q for n, q in driver.oracle_sql().items() if n in QUERIES}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_roundtrip")])
def test_plan_has_no_python_and_no_product(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_entry_is_the_daily_summary(spark):
    assert driver.entry(spark).columns[:2] == ["city_id", "measurement_date"]
