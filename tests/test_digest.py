"""Digest drill-down: the results of a whole reconciliation, and what it shuffles."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle_harness import SF_SMALL
from tidemark.operators import compare as C
from tidemark.operators import digest as DG
from tidemark.plans import named as N

KEY = st.one_of(st.none(), st.integers(0, 5))
ROWS = st.lists(st.tuples(KEY, KEY, st.sampled_from(["x", "y", None])), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS, st.sampled_from([(1,), (4,), (2, 2, 3)]))
def test_equals_a_whole_reconciliation(spark, a, b, levels):
    s, t = (spark.createDataFrame(rows, "a int, b long, v string") for rows in (a, b))
    keys = ["a", "b"]
    assert DG.reconcile_digest(s, t, keys, levels=levels).collect() == C.reconcile(s, t, keys).collect()
    order = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert order(DG.issue_rows_digest(s, t, keys, levels=levels)) == order(C.issue_rows(s, t, keys))


def test_key_types_may_differ_and_unique_keys_may_be_vouched_for(spark):
    s = spark.range(2000).selectExpr("cast(id as int) AS k", "concat('v', id) AS v")
    t = spark.range(1, 2003).selectExpr("id AS k", "CASE WHEN id = 7 THEN 'other' ELSE concat('v', id) END AS v")
    whole = C.reconcile(s, t, ["k"]).collect()
    for unique in (False, True):
        assert DG.reconcile_digest(s, t, ["k"], unique_keys=unique).collect() == whole
    assert DG.issue_rows_digest(s, t, ["k"], unique_keys=True).count() == 1 + 3 + 1


def _shuffled(spark, df) -> tuple[int, int]:
    """Bytes and rows that the query's exchanges wrote, from its plan's metrics."""
    df.collect()
    plan, seen, total = df._jdf.queryExecution().executedPlan(), [], [0, 0]
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange" and node.id() not in seen:
            seen.append(node.id())
            metrics = node.metrics()
            total[0] += metrics.apply("shuffleBytesWritten").value()
            total[1] += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return tuple(total)


def test_equal_sides_exchange_digests_only(spark):
    s, _ = N.customer_pair(spark, "/root/testdata/sf0.01")
    big = s.selectExpr("explode(sequence(c_custkey * 20, c_custkey * 20 + 19)) AS k", "c_name", "c_acctbal")  # 30,000 rows
    whole, _ = _shuffled(spark, C.reconcile(big, big, ["k"]))
    few, rows = _shuffled(spark, DG.reconcile_digest(big, big, ["k"], unique_keys=True, levels=(256, 16)))
    assert few < 1_000_000 and few < whole / 4, (few, whole)
    changed = big.selectExpr("k", "CASE WHEN k = 77 THEN 'x' ELSE c_name END AS c_name", "c_acctbal")
    _, rows_one = _shuffled(spark, DG.reconcile_digest(big, changed, ["k"], unique_keys=True, levels=(256, 16)))
    assert rows_one - rows < 600  # finer digests of one bucket, and the rows of one fine bucket


def test_lists_of_buckets_are_broadcast_and_rows_filtered_before_their_exchange(spark):
    s, t = N.customer_pair(spark, SF_SMALL)
    plan = DG.digest_counts(s, t, ["c_custkey"], ["c_name"], unique_keys=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan and "Cartesian" not in plan
    assert not re.search("Python|Arrow|Pandas", plan)
