"""Physical plan shape: shuffles, no cross products, pushdown, pruning."""

import pytest

import __spark_entry__ as E
from oracle_harness import SF_SMALL
from tidemark.operators import compare as C
from tidemark.operators import loads as L
from tidemark.plans import named as N


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_plans_a_cross_product(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, fn in N.QUERIES.items():
            if "_job" in name or name == "table_lifecycle":
                continue
            p = plan(fn(spark, SF_SMALL))
            assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_reconcile_shuffles_twice_by_key_with_partial_aggregation(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        s, t = N.customer_pair(spark, SF_SMALL)
        p = plan(C.reconcile(s, t, ["c_custkey"]))
        hashed = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
        assert len(hashed) == 2, p
        assert p.count("HashAggregate") >= 6  # partial + final for each of the three aggregates
        assert "SortMergeJoin" not in p and "BroadcastHashJoin" not in p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scd2_duplicate_check_adds_no_exchange(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t, s = N.scd2_pair(spark, SF_SMALL)
        p = plan(L.scd2(t, s, **N.SCD2_ARGS))
        # one exchange per join side; the window reuses the source side's
        assert p.count("Exchange hashpartitioning") == 2, p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    df = E.queries()["src_enriched_events"](spark, SF_SMALL)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "ts" in ln][0]
    assert "props" not in scan  # unused column pruned


@pytest.mark.parametrize("name", ["recon_summary", "scd2_full", "scd1_upsert", "incremental_keyed"])
def test_headline_plans_stay_in_the_jvm(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p


@pytest.mark.parametrize("name", ["recon_mismatch_all", "recon_details", "recon_summary_fanout"])
def test_reconciliation_aggregates_are_hash_based(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(E.queries()[name](spark, SF_SMALL))
        assert "SortAggregate" not in p and "ObjectHashAggregate" not in p, p
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
