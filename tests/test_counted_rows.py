"""Summaries by digest: fingerprints of values, grouped in tables, where that tells as much as texts."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle_harness import SF_SMALL
from tidemark.operators import compare as C
from tidemark.operators import digest as DG
from tidemark.plans import named as N

KEY = st.one_of(st.none(), st.integers(0, 3))
TEXT = st.sampled_from(["", "x", "y", "1", None])
BARRED = st.sampled_from(["x", "x||y", "|", "y", None])


def _rows(text):
    return st.lists(st.tuples(KEY, text, text, st.sampled_from([1, 2, None])), max_size=9)


@pytest.mark.parametrize("text", [TEXT, BARRED])
def test_equals_a_whole_reconciliation(spark, text):
    @settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(_rows(text), _rows(text), st.booleans())
    def equal(a, b, exact):
        s, t = (spark.createDataFrame(rows, "k int, v string, w string, n long") for rows in (a, b))
        for x, y in ((s, t), (s, s)):
            assert DG.reconcile_digest(x, y, ["k"], exact=exact, levels=(4, 2)).collect() == C.reconcile(x, y, ["k"], exact=exact).collect()

    equal()


def test_texts_that_values_do_not_tell(spark):
    """('x||y', NULL) and ('x', 'y') have one text; so have a NULL and '' that are all that is compared."""
    s = spark.sql("SELECT * FROM VALUES (1, 'x||y', CAST(NULL AS STRING)), (2, 'x', NULL), (3, 'x|', 'y'), (4, '', '') AS t(k, v, w)")
    t = spark.sql("SELECT * FROM VALUES (1, 'x', 'y'), (2, NULL, 'x'), (3, 'x', '|y'), (4, NULL, '') AS t(k, v, w)")
    for cols in (["v", "w"], ["v"]):
        for exact in (False, True):
            for keys in ([1], [2], [3], [4], [1, 2, 3, 4]):
                two = [df.filter(df.k.isin(keys)).select("k", *cols) for df in (s, t)]
                assert DG.reconcile_digest(*two, ["k"], exact=exact).collect() == C.reconcile(*two, ["k"], exact=exact).collect(), (cols, exact, keys)


def test_crowded_keys_of_several_columns(spark, monkeypatch):
    monkeypatch.setattr(C, "CROWD_LEAST", 500)
    s = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "CAST(id % 5 AS STRING) AS v", "id % 2 AS n")
    t = s.selectExpr("k", "CASE WHEN k = 11 THEN NULL ELSE v END AS v", "CASE WHEN k % 50 = 7 THEN n + 1 ELSE n END AS n")
    assert C.crowded_keys(s, t, ["k"])
    assert DG.reconcile_digest(s, t, ["k"]).collect() == C.reconcile(s, t, ["k"]).collect()


def test_no_text_is_made_of_values_and_no_row_is_sorted(spark, monkeypatch):
    raw, changed = N.lineitem_raw_pair(spark, SF_SMALL)
    plan = lambda t: DG.reconcile_digest(raw, t, N.LI_KEYS)._jdf.queryExecution().executedPlan().toString()
    differ, every, same = plan(changed), plan(raw.withColumn("l_quantity", -raw.l_quantity).select(raw.columns)), plan(raw)
    for p in (differ, every, same):
        assert not [x for x in ("sha2(", "Sort") if x in p], p
    for p in (every, same):  # all buckets differ, or none: no list of them is looked up
        assert p.count("BroadcastHashJoin") == 0, p
    assert same.count("FileScan parquet") == 1  # equal sides: the source's rows stand for the target's
    monkeypatch.setattr(C, "TASK_ROWS", 100)
    assert plan(raw).count("REPARTITION_BY_NUM") == 1  # tasks by the rows that were counted
    assert DG.reconcile_digest(raw, changed, N.LI_KEYS).collect() == C.reconcile(raw, changed, N.LI_KEYS).collect()


def test_crowded_buckets_have_a_largest_size():
    """Pairs of the others' rows are counted in 64 bits."""
    rows = dict.fromkeys(range(512), 2**32)
    assert C.crowded(rows, "b").count(",") == 511 and C.crowded(dict.fromkeys(range(512), 2**31), "b") is None
