"""Every registered query against its DuckDB oracle (sf0.001 by default;
TIDEMARK_ORACLE_SF=/root/testdata/sf0.01 for the driver's scale)."""

import pytest

import __spark_entry__ as E
from oracle_harness import SF_ORACLE, compare, duck_connection
from tidemark.plans.named import QUERIES

#: The loads and reconciliations; tests/llm has its own.
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_ORACLE)
    ok, msg = compare(df, con, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3 and set(df.columns) >= {"status", "overall_status", "match_rate"}


def test_decimal_outputs_listed(spark):
    from pyspark.sql import types as T

    from tidemark.plans.oracle import DECIMAL_OUTPUTS

    found = {}
    for name, fn in QUERIES.items():
        if "_job" in name or name == "table_lifecycle":
            continue
        cols = [f.name for f in fn(spark, SF_ORACLE).schema.fields if isinstance(f.dataType, T.DecimalType)]
        if cols:
            found[name] = cols
    assert found == DECIMAL_OUTPUTS


def test_date_outputs_listed(spark):
    from pyspark.sql import types as T

    from tidemark.plans.oracle import DATE_OUTPUTS

    found = {}
    for name, fn in QUERIES.items():
        if "_job" in name or name == "table_lifecycle":
            continue
        cols = [f.name for f in fn(spark, SF_ORACLE).schema.fields if isinstance(f.dataType, T.DateType)]
        if cols:
            found[name] = cols
    assert found == DATE_OUTPUTS
