"""Reconciliations that exchange each row once: by key, with crowded keys apart."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oracle_harness import SF_SMALL
from tidemark.operators import compare as C
from tidemark.operators import digest as DG
from tidemark.plans import named as N

KEY = st.one_of(st.none(), st.integers(0, 4))
ROWS = st.lists(st.tuples(KEY, KEY, st.sampled_from(["x", "y", None]), st.sampled_from(["y", None])), max_size=9)
KEYS, COLUMNS = ["a", "b"], ["v", "w"]


def _sorted(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, ROWS, st.booleans(), st.booleans())
def test_issues_and_numbers_are_those_of_the_profile(spark, a, b, exact, apart):
    s, t = (spark.createDataFrame(rows, "a int, b long, v string, w string") for rows in (a, b))
    inside = f"{C._bucket_sql(KEYS, 2)} IN (1)" if apart else None
    rows = C.side_rows(s, t, KEYS, COLUMNS, exact)
    assert _sorted(C.issues_of_rows(rows, KEYS, inside)) == _sorted(C.issue_rows(s, t, KEYS, exact=exact))
    whole = C.summarize_profile(C.key_profile(s, t, KEYS, COLUMNS, exact), KEYS, True)
    assert C.summary_of_rows(rows, KEYS, True, inside).collect() == whole.collect()


def test_rows_are_exchanged_once(spark):
    s, t = N.lineitem_raw_pair(spark, SF_SMALL)
    cols = C.compare_columns(s.columns, t.columns, N.LI_KEYS)
    for df in (C.issues_of_rows(C.side_rows(s, t, N.LI_KEYS, cols), N.LI_KEYS, None), DG.issue_rows_digest(s, t, N.LI_KEYS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(k__") == 1 and "SortMergeJoin" not in plan, plan
        assert " HashAggregate(keys=[k__" not in plan and " ObjectHashAggregate" not in plan  # one sort, no tables
    plan = DG.reconcile_digest(s, t, N.LI_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k__") == 1, plan


def test_crowded_keys_are_combined_before_their_exchange(spark, monkeypatch):
    monkeypatch.setattr(C, "CROWD_LEAST", 1000)
    rows = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "CAST(id % 5 AS STRING) AS v")
    other = rows.selectExpr("k", "CASE WHEN k = 11 THEN '!' ELSE v END AS v")
    inside = C.crowded_keys(rows, other, ["k"])
    held = rows.selectExpr("k AS k__k").filter(inside).groupBy("k__k").count().collect()
    assert max(held, key=lambda r: r["count"])["k__k"] == 7 and len(held) < 20
    assert C.crowded_keys(rows.filter("k <> 7"), other.filter("k <> 7"), ["k"]) is None
    assert DG.reconcile_digest(rows, other, ["k"]).collect() == C.reconcile(rows, other, ["k"]).collect()
    assert _sorted(DG.issue_rows_digest(rows, other, ["k"], levels=(512, 4))) == _sorted(C.issue_rows(rows, other, ["k"]))


def test_digests_of_values_see_what_texts_show(spark):
    """Equal numbers of types with other texts differ; NULLs that move don't, but for exact fingerprints."""
    s = spark.sql("SELECT 1 AS k, 1.5D AS v, CAST(NULL AS STRING) AS a, 'x' AS b UNION ALL SELECT 2, -0.0D, 'y', 'z'")
    t = spark.sql("SELECT 1 AS k, CAST(1.50 AS DECIMAL(9,2)) AS v, 'x' AS a, CAST(NULL AS STRING) AS b UNION ALL SELECT 2, 0, 'y', 'z'")
    for cols in (["v"], ["a", "b"], ["v", "a", "b"]):
        for exact in (False, True):
            two = [df.select("k", *cols) for df in (s, t)]
            assert DG.reconcile_digest(*two, ["k"], exact=exact).collect() == C.reconcile(*two, ["k"], exact=exact).collect()


def test_finer_digests_only_where_few_buckets_differ(spark):
    s = spark.range(4000).selectExpr("id AS k", "CAST(id AS STRING) AS v")
    few, most = (s.selectExpr("k", f"CASE WHEN k % {n} = 1 THEN '!' ELSE v END AS v") for n in (4000, 2))
    digests = lambda t: DG.digest_rows(s, t, ["k"], ["v"], levels=(64, 8))[0]._jdf.queryExecution().executedPlan().toString().count("bit_xor")
    assert digests(few) > 0 and digests(most) == 0
