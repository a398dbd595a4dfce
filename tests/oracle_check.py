"""Compare registered queries with their SQL, as the driver does.

Usage: python tests/oracle_check.py [scale factor] [query name ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


# How Spark's types are called in the SQL engine.
SQL_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def normalised(columns, rows):
    """Column names in order, and the rows as a sorted list over those columns."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(shaped, key=repr)


def compare(spark, connection, sf_dir, name, query, sql) -> str | None:
    """What differs between Spark and SQL, or None."""
    frame = query(spark, sf_dir)
    columns, rows = normalised(frame.columns, frame.collect())
    answer = connection.execute(sql)
    wanted_columns, wanted = normalised([d[0] for d in answer.description], answer.fetchall())
    if columns != wanted_columns:
        return f"{name}: columns {columns} instead of {wanted_columns}"
    kinds = {f.name: SQL_TYPES[f.dataType.simpleString()] for f in frame.schema.fields}
    wanted_kinds = {d[0]: str(d[1]) for d in answer.description}
    if kinds != wanted_kinds:
        differing = {c: (kinds[c], wanted_kinds[c]) for c in kinds if kinds[c] != wanted_kinds[c]}
        return f"{name}: types {differing}"
    if len(rows) != len(wanted):
        return f"{name}: {len(rows)} rows instead of {len(wanted)}"
    for row, other in zip(rows, wanted):
        if row != other:
            return f"{name}: {row}\n  instead of {other}"
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as driver

    scale, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{scale}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    oracles = driver.oracle_sql()
    for name, query in driver.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name, query, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{name}: {type(error).__name__}: {str(error)[:1500]}"
        print(problem or f"{name}: same", f"({time.time() - started:.1f} s)", flush=True)


if __name__ == "__main__":
    main()
