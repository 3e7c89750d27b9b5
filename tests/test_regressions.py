"""One test per place where our contract differs from the reference code."""

import datetime as dt
from decimal import Decimal

import pytest

from tidemark.operators import compare as C
from tidemark.operators import loads as L

ARGS = dict(keys=["k"], columns=["v"], batch_id="b2", delete_column="del", delete_value="Y")
T_SCHEMA = (
    "k int, v string, del string, _hash string, batch_id string, effective_start_date timestamp_ntz, "
    "effective_end_date timestamp_ntz, is_active string, updated_timestamp timestamp_ntz"
)
T0, T1 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)


def _h(v):
    import hashlib

    return hashlib.sha256((v or "").encode()).hexdigest()


def _target(spark, rows):
    return spark.createDataFrame(rows, T_SCHEMA)


def test_d1_history_does_not_spawn_extra_versions(spark):
    # key 1 has two closed versions with other hashes and an active one; an
    # unchanged source must leave exactly one active row.
    t = _target(spark, [
        (1, "a", "N", _h("a"), "b0", T0, T1, "N", T1),
        (1, "b", "N", _h("b"), "b0", T0, T1, "N", T1),
        (1, "c", "N", _h("c"), "b1", T1, None, "Y", T1),
    ])
    s = spark.createDataFrame([(1, "c", "N")], "k int, v string, del string")
    out = L.scd2(t, s, as_of="2026-02-01 00:00:00", **ARGS).collect()
    assert len(out) == 3 and sum(r.is_active == "Y" for r in out) == 1


def test_d2_returning_changed_key_inserted_once(spark):
    t = _target(spark, [(1, "a", "N", _h("a"), "b0", T0, T1, "N", T1)])
    s = spark.createDataFrame([(1, "z", "N")], "k int, v string, del string")
    out = L.scd2(t, s, as_of="2026-02-01 00:00:00", **ARGS).collect()
    assert sum(r.is_active == "Y" for r in out) == 1 and len(out) == 2


def test_d3_d4_exact_counts(spark):
    t = _target(spark, [
        (1, "a", "N", _h("a"), "b0", T0, None, "Y", T0),
        (2, "b", "N", _h("b"), "b0", T0, None, "Y", T0),
        (3, "c", "N", _h("c"), "b0", T0, None, "Y", T0),
    ])
    s = spark.createDataFrame([(1, "a", "N"), (2, "B", "N"), (3, "c", "Y"), (4, "d", "N")], "k int, v string, del string")
    st = L.scd2_stats(t, s, as_of="2026-02-01 00:00:00", **ARGS).collect()[0]
    assert (st.source_count, st.inserted, st.updated, st.deleted, st.active_count, st.historical_count) == (4, 1, 1, 1, 3, 2)
    p = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    ps = spark.createDataFrame([(1, "a"), (2, "x"), (3, "y")], "k int, v string")
    t1 = L.scd1(None, p, ["k"], ["v"], as_of="2026-01-01 00:00:00")
    s1 = L.scd1_stats(t1, ps, ["k"], ["v"], as_of="2026-02-01 00:00:00").collect()[0]
    assert (s1.source_count, s1.inserted, s1.updated, s1.active_count) == (3, 1, 2, 3)


def test_d5_null_flag_is_not_a_delete(spark):
    t = _target(spark, [(1, "a", "N", _h("a"), "b0", T0, None, "Y", T0)])
    s = spark.createDataFrame([(1, "changed", None), (2, "new", None)], "k int, v string, del string")
    acts = {r.k: r.action for r in L.scd2_actions(t, s, as_of="2026-02-01 00:00:00", **ARGS).collect()}
    assert acts == {1: "changed", 2: "new"}


def test_d6_first_load_skips_flagged_rows(spark):
    s = spark.createDataFrame([(1, "a", "Y"), (2, "b", "N")], "k int, v string, del string")
    out = L.scd2(None, s, as_of="2026-02-01 00:00:00", **ARGS).collect()
    assert [r.k for r in out] == [2]


def test_d7_configured_delete_column_is_carried(spark):
    s = spark.createDataFrame([(1, "a", "N")], "k int, v string, gone string")
    out = L.scd2(None, s, as_of="2026-02-01 00:00:00", keys=["k"], columns=["v"], batch_id="b",
                 delete_column="gone", delete_value="Y")
    assert "gone" in out.columns


def test_d8_falsy_delete_value_still_deletes(spark):
    t = spark.createDataFrame([(1, "a", 1, _h("a"), "b0", T0, None, "Y", T0)], T_SCHEMA.replace("del string", "del int"))
    s = spark.createDataFrame([(1, "a", 0)], "k int, v string, del int")
    acts = L.scd2_actions(t, s, as_of="2026-02-01 00:00:00", keys=["k"], columns=["v"], batch_id="b",
                          delete_column="del", delete_value=0).collect()
    assert acts[0].action == "deleted"


def test_d9_exact_fingerprint_tells_null_placement_apart(spark):
    s = spark.createDataFrame([(1, "a", None, "b")], "k int, x string, y string, z string")
    t = spark.createDataFrame([(1, "a", "b", None)], "k int, x string, y string, z string")
    assert C.reconcile(s, t, ["k"]).collect()[0].mismatch_count == 0  # the reference's fingerprint
    assert C.reconcile(s, t, ["k"], exact=True).collect()[0].mismatch_count == 1


def test_d11_decimal_and_date_keys_render_as_json(spark):
    s = spark.createDataFrame([(Decimal("1.50"), dt.date(2026, 1, 1), "a")], "k decimal(5,2), d date, v string")
    t = spark.createDataFrame([], "k decimal(5,2), d date, v string")
    r = C.issue_rows(s, t, ["k", "d"]).collect()[0]
    assert r.issue_type == "MISSING" and r.record_keys == '{"k":1.50,"d":"2026-01-01"}'


def test_d12_counts_are_long(spark):
    s = spark.createDataFrame([(1, "a")], "k int, v string")
    schema = dict((f.name, f.dataType.simpleString()) for f in C.reconcile(s, s, ["k"]).schema.fields)
    assert all(schema[c] == "bigint" for c in ("source_count", "mismatch_count", "matched_count"))


def test_d13_empty_source_rate_is_zero(spark):
    e = spark.createDataFrame([], "k int, v string")
    r = C.with_thresholds(C.reconcile(e, e, ["k"]), {"max_mismatch_percent": 0.0}).collect()[0]
    assert r.match_rate == 0.0 and r.summary == "Perfect match: 0/0 records" and not r.threshold_breached


def test_d15_null_keys(spark):
    s = spark.createDataFrame([(None, "a"), (1, "a")], "k int, v string")
    t = spark.createDataFrame([(None, "b"), (1, "a")], "k int, v string")
    r = C.reconcile(s, t, ["k"]).collect()[0]
    # NULL = NULL for missing / extra, never for mismatches
    assert (r.missing_count, r.extra_count, r.mismatch_count, r.matched_count) == (0, 0, 0, 2)


def test_d18_threshold_flag_kept_next_to_status(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    r = C.with_thresholds(C.reconcile(s, t, ["k"]), {"max_missing_percent": 10.0}).collect()[0]
    assert r.status == "FAILED" and r.threshold_breached and r.overall_status == "THRESHOLD_BREACHED"


def test_d20_duplicate_source_keys_raise(spark):
    t = _target(spark, [(1, "a", "N", _h("a"), "b0", T0, None, "Y", T0)])
    s = spark.createDataFrame([(1, "x", "N"), (1, "y", "N")], "k int, v string, del string")
    with pytest.raises(Exception, match="DUPLICATE_SOURCE_KEY"):
        L.scd2(t, s, as_of="2026-02-01 00:00:00", **ARGS).collect()
    with pytest.raises(Exception, match="DUPLICATE_SOURCE_KEY"):
        L.scd1(L.scd1(None, s.limit(1), ["k"], ["v"]), s, ["k"], ["v"]).collect()


def test_null_source_keys_insert_and_never_match(spark):
    t = _target(spark, [(None, "a", "N", _h("a"), "b0", T0, None, "Y", T0)])
    s = spark.createDataFrame([(None, "a", "N"), (None, "b", "N")], "k int, v string, del string")
    acts = sorted(r.action for r in L.scd2_actions(t, s, as_of="2026-02-01 00:00:00", **ARGS).collect())
    assert acts == ["new", "new", "target_only"]


def test_compare_columns_rules():
    assert C.compare_columns(["k", "a", "B", "c"], ["k", "a", "b", "c"], ["k"], ["a", "c", "zz"], ["c"]) == ["a"]
    assert C.compare_columns(["k", "b", "a"], ["k", "a", "b"], ["k"]) == ["a", "b"]


def test_column_decisions_say_why():
    made = C.column_decisions(["k", "a", "b", "only_s", "X"], ["k", "a", "b", "only_t", "x"], ["k"], ["a", "x", "zz"], ["b"])
    assert made == {"k": "key", "a": "compared", "b": "excluded", "only_s": "one_sided", "only_t": "one_sided",
                    "X": "one_sided", "x": "one_sided", "zz": "unknown"}
    folded = C.column_decisions(["K", "X"], ["k", "x"], ["k"], match_case=False)
    assert folded == {"K": "key", "X": "compared"}


def test_exact_sees_microseconds(spark):
    s = spark.createDataFrame([(1, "2026-01-01 00:00:00.123456")], "k int, t string").selectExpr("k", "CAST(t AS TIMESTAMP_NTZ) AS t")
    t = spark.createDataFrame([(1, "2026-01-01 00:00:00.123999")], "k int, t string").selectExpr("k", "CAST(t AS TIMESTAMP_NTZ) AS t")
    assert C.reconcile(s, t, ["k"], exact=True).collect()[0].mismatch_count == 1
    keys = [r.record_keys for r in C.issue_rows(s, t, ["t"]).orderBy("issue_type").collect()]
    assert keys == ['{"t":"2026-01-01T00:00:00.123999"}', '{"t":"2026-01-01T00:00:00.123456"}']


def test_delete_column_is_resolved_or_refused(spark):
    t = _target(spark, [(1, "a", "N", _h("a"), "b0", T0, None, "Y", T0)])
    s = spark.createDataFrame([(1, "a", "Y")], "k int, v string, del string")
    acts = lambda name: L.scd2_actions(t, s, as_of="2026-02-01 00:00:00", **{**ARGS, "delete_column": name}).collect()
    assert acts("DEL")[0].action == "deleted"
    with pytest.raises(ValueError, match="is_gone"):
        acts("is_gone")


def test_pairs_beyond_64_bits_do_not_fail(spark):
    big = "CAST(4000000000 AS BIGINT)"
    prof = spark.range(1).selectExpr(f"{big} AS source_rows", f"{big} AS target_rows",
                                     "CAST(16000000000000000000 AS DECIMAL(38,0)) AS mismatched_pairs")
    assert C.summarize_profile(prof, ["k"], True).collect()[0].mismatch_count == C.LONG_MAX


def test_key_names_with_dots(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], ["a.b", "v"])
    t = spark.createDataFrame([(1, "x"), (3, "c")], ["a.b", "v"])
    r = C.reconcile(s, t, ["a.b"]).collect()[0]
    assert (r.missing_count, r.extra_count, r.mismatch_count, r.source_duplicates) == (1, 1, 1, 1)
    assert C.issue_rows(s, t, ["a.b"]).count() == 4
    assert L.incremental(t, s, ["a.b"]).count() == 4
    assert L.scd1(L.scd1(None, t, ["a.b"], ["v"]), s.dropDuplicates(), ["a.b"], ["v"]).count() == 3


def test_issues_of_keys_with_several_versions_carry_hashes(spark):
    s = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x")], "k int, v string")
    t = spark.createDataFrame([(1, "a"), (2, "x")], "k int, v string")
    rows = C.issue_rows(s, t, ["k"]).filter("issue_type = 'MISMATCH'").collect()
    # only b differs from a row of the other side, and a (target) from b (source)
    assert {(r.source_values, r.target_values) for r in rows} == {(_h("b"), None), (_h("a"), _h("a"))}
    v = {r.fingerprint: (r.source_rows, r.target_rows) for r in C.mismatch_versions(s, t, ["k"], ["v"]).collect()}
    assert v == {_h("a"): (1, 1), _h("b"): (1, 0)}
