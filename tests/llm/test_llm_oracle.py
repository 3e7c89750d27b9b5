"""The training-data queries that SQL can express, against DuckDB."""

import pytest
from oracle_harness import compare, duck_connection

import __spark_entry__ as E
from tidemark.llm.queries import LLM_ORACLE

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(E.queries()[name](spark, SF), duck_connection(SF), E.oracle_sql()[name])
    assert ok, msg
