"""The registered queries and the pipeline, on the smallest tables."""

from pathlib import Path

import pytest
from llm_cases import rows
from oracle_check import compare, connect

import corpus_pipeline
from hourlake.llm.queries import QUERIES
from hourlake.llm.sql import ORACLE_SQL
from hourlake.llm.tables import read_table

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the driver's tables")


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_sql(spark, name):
    connection = connect(SF_DIR)
    assert compare(spark, connection, SF_DIR, name, QUERIES[name], ORACLE_SQL[name]) is None


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))


def test_stages_keep_columns_and_run_chains_them(spark):
    docs = read_table(spark, SF_DIR, "documents")
    sizes = [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, SF_DIR)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert result.schema.names == docs.schema.names
            docs = spark.createDataFrame(result.collect(), docs.schema)
            sizes.append(docs.count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] > sizes[4]
    packed = corpus_pipeline.run(spark, SF_DIR)
    wanted = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(packed.select(*columns)) == rows(wanted.select(*columns))
