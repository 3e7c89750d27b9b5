"""Randomised checks against plain Python models of the reference semantics."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators import compare as C
from tidemark.operators import loads as L

SCHEMA = "k int, a int, b string"
keys = st.one_of(st.none(), st.integers(0, 5))
rows = st.lists(
    st.tuples(keys, st.one_of(st.none(), st.integers(0, 3)), st.sampled_from([None, "a", "b", "a|", "|b"])),
    max_size=12,
)
SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))


def _fp(r):
    return "||".join(str(v) for v in r[1:] if v is not None)


def model(src, tgt):
    sk, tk = Counter(r[0] for r in src), Counter(r[0] for r in tgt)
    mism = sum(1 for s in src for t in tgt if s[0] is not None and s[0] == t[0] and _fp(s) != _fp(t))
    return dict(
        source_count=len(src),
        target_count=len(tgt),
        missing_count=len(set(sk) - set(tk)),
        extra_count=len(set(tk) - set(sk)),
        source_duplicates=sum(1 for c in sk.values() if c > 1),
        target_duplicates=sum(1 for c in tk.values() if c > 1),
        mismatch_count=mism,
        matched_count=len(src) - len(set(sk) - set(tk)) - mism,
    )


@SETTINGS
@given(rows, rows)
def test_fused_reconcile_equals_plain_model(spark, src, tgt):
    s, t = spark.createDataFrame(src, SCHEMA), spark.createDataFrame(tgt, SCHEMA)
    got = C.reconcile(s, t, ["k"]).collect()[0].asDict()
    want = model(src, tgt)
    assert {k: got[k] for k in want} == want
    if want["source_count"]:
        assert got["match_rate"] == round(want["matched_count"] / want["source_count"] * 100, 2)
    else:
        assert got["match_rate"] == 0.0


@SETTINGS
@given(rows)
def test_reconcile_with_itself_has_no_missing_or_extra(spark, src):
    s = spark.createDataFrame(src, SCHEMA)
    r = C.reconcile(s, s, ["k"]).collect()[0]
    assert r.missing_count == 0 and r.extra_count == 0


unique_rows = st.dictionaries(st.integers(0, 8), st.tuples(st.one_of(st.none(), st.integers(0, 2)),
                                                            st.sampled_from(["x", "y", None])), max_size=8)
flags = st.dictionaries(st.integers(0, 8), st.sampled_from(["Y", "N", None]), max_size=8)


def _scd2_src(spark, d, fl):
    return spark.createDataFrame([(k, a, b, fl.get(k, "N")) for k, (a, b) in d.items()],
                                 "k int, a int, b string, is_deleted string")


ARGS = dict(keys=["k"], columns=["a", "b"], batch_id="b", delete_column="is_deleted", delete_value="Y")


@SETTINGS
@given(unique_rows, unique_rows, flags)
def test_scd2_invariants(spark, first, second, fl):
    from pyspark.sql import functions as F

    t0 = L.scd2(None, _scd2_src(spark, first, {}), as_of="2026-01-01 00:00:00", **ARGS)
    t0 = spark.createDataFrame(t0.collect(), t0.schema)
    src = _scd2_src(spark, second, fl)
    t1 = L.scd2(t0, src, as_of="2026-02-01 00:00:00", **ARGS)
    t1 = spark.createDataFrame(t1.collect(), t1.schema)
    # row count never shrinks; at most one active row per key
    assert t1.count() >= t0.count()
    assert t1.filter("is_active = 'Y'").groupBy("k").count().filter("count > 1").count() == 0
    # a closed version ends exactly when the key's next version starts
    closed = t1.filter(F.col("effective_end_date") == F.to_timestamp_ntz(F.lit("2026-02-01 00:00:00")))
    for r in closed.collect():
        if not (fl.get(r.k) == "Y"):
            assert t1.filter((F.col("k") == r.k) & (F.col("is_active") == "Y")).count() == 1
    # idempotent: the same batch again changes nothing
    acts = L.scd2_actions(t1, src, as_of="2026-03-01 00:00:00", label_reactivated=False, **ARGS)
    assert {r.action for r in acts.collect()} <= {"unchanged", "target_only", "skipped"}


@SETTINGS
@given(unique_rows, unique_rows)
def test_scd1_is_last_writer_wins(spark, first, second):
    tgt = spark.createDataFrame([(k, a, b) for k, (a, b) in first.items()], "k int, a int, b string")
    src = spark.createDataFrame([(k, a, b) for k, (a, b) in second.items()], "k int, a int, b string")
    t0 = L.scd1(None, tgt, ["k"], ["a", "b"], as_of="2026-01-01 00:00:00")
    t1 = L.scd1(t0, src, ["k"], ["a", "b"], as_of="2026-02-01 00:00:00")
    got = {r.k: (r.a, r.b) for r in t1.collect()}
    assert got == {**first, **second}


@SETTINGS
@given(st.lists(st.integers(0, 20), unique=True, max_size=10), st.lists(st.integers(0, 20), unique=True, max_size=10))
def test_incremental_twice_equals_once(spark, tgt_keys, batch_keys):
    t = spark.createDataFrame([(k,) for k in tgt_keys], "k int")
    b = spark.createDataFrame([(k,) for k in batch_keys], "k int")
    once = L.incremental(t, b, ["k"])
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = L.incremental(once, b, ["k"])
    assert sorted(r.k for r in twice.collect()) == sorted(set(tgt_keys) | set(batch_keys))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=10), st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=10))
def test_incremental_new_rows_model(spark, tgt_keys, batch_keys):
    # NULL keys are always new; duplicates inside the batch are all appended.
    t = spark.createDataFrame([(k,) for k in tgt_keys], "k int")
    b = spark.createDataFrame([(k, i) for i, k in enumerate(batch_keys)], "k int, i int")
    got = sorted(r.i for r in L.incremental_new_rows(t, b, ["k"]).collect())
    want = sorted(i for i, k in enumerate(batch_keys) if k is None or k not in set(tgt_keys))
    assert got == want


import datetime as _dt  # noqa: E402
import hashlib  # noqa: E402

T_SCHEMA = (
    "k int, v string, del string, _hash string, batch_id string, effective_start_date timestamp_ntz, "
    "effective_end_date timestamp_ntz, is_active string, updated_timestamp timestamp_ntz"
)
_T0, _TH, _AS = _dt.datetime(2026, 1, 1), _dt.datetime(2025, 6, 1), _dt.datetime(2026, 2, 1)


def _h(v):
    return hashlib.sha256(("" if v is None else v).encode()).hexdigest()


def scd2_model(target, source):
    """The decision table of SURVEY 2.12 (our contract), row by row."""
    out = [r for r in target if r[7] != "Y"]
    active = {r[0]: r for r in target if r[7] == "Y" and r[0] is not None}
    out += [r for r in target if r[7] == "Y" and r[0] is None]
    seen = set()
    for k, v, d in source:
        flag = d == "Y"
        new = (k, v, d, _h(v), "b1", _AS, None, "Y", _AS)
        t = active.get(k) if k is not None else None
        if t is None:
            if not flag:
                out.append(new)
            continue
        seen.add(k)
        closed = t[:6] + (_AS, "N", _AS)
        if flag:
            out.append(closed)
        elif _h(v) != t[3]:
            out += [closed, new]
        else:
            out.append(t)
    out += [t for k, t in active.items() if k not in seen]
    return sorted(out, key=repr)


hist_rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", None])), max_size=6)
act_rows = st.dictionaries(st.one_of(st.none(), st.integers(0, 6)), st.sampled_from(["a", "b", None]), max_size=6)
src_rows = st.dictionaries(st.integers(0, 7), st.tuples(st.sampled_from(["a", "b", "c", None]),
                                                        st.sampled_from(["Y", "N", None])), max_size=7)


@SETTINGS
@given(hist_rows, act_rows, src_rows, st.booleans())
def test_scd2_matches_decision_table_model(spark, hist, act, src, null_key_source):
    target = [(k, v, "N", _h(v), "bh", _TH, _T0, "N", _T0) for k, v in hist]
    target += [(k, v, "N", _h(v), "b0", _T0, None, "Y", _T0) for k, v in act.items()]
    source = [(k, v, d) for k, (v, d) in src.items()] + ([(None, "z", "N")] if null_key_source else [])
    t = spark.createDataFrame(target, T_SCHEMA)
    s = spark.createDataFrame(source, "k int, v string, del string")
    got = L.scd2(t, s, keys=["k"], columns=["v"], as_of="2026-02-01 00:00:00", batch_id="b1",
                 delete_column="del", delete_value="Y").collect()
    assert sorted((tuple(r) for r in got), key=repr) == scd2_model(target, source)


@SETTINGS
@given(hist_rows, act_rows, src_rows)
def test_scd2_change_set_applied_to_old_state_gives_new_state(spark, hist, act, src):
    target = [(k, v, "N", _h(v), "bh", _TH, _T0, "N", _T0) for k, v in hist]
    target += [(k, v, "N", _h(v), "b0", _T0, None, "Y", _T0) for k, v in act.items()]
    source = [(k, v, d) for k, (v, d) in src.items()]
    t = spark.createDataFrame(target, T_SCHEMA)
    s = spark.createDataFrame(source, "k int, v string, del string")
    args = dict(keys=["k"], columns=["v"], as_of="2026-02-01 00:00:00", batch_id="b1", delete_column="del",
                delete_value="Y")
    changes = [tuple(r)[:-1] for r in L.scd2_changes(L.scd2_joined(t, s, **args)).collect()]
    closed_keys = {c[0] for c in changes if c[7] == "N"}
    kept = [r for r in target if not (r[7] == "Y" and r[0] in closed_keys)]
    merged = sorted(kept + changes, key=repr)
    assert merged == sorted((tuple(r) for r in L.scd2(t, s, **args).collect()), key=repr)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=10), st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=10))
def test_incremental_tagged_agrees_with_new_rows(spark, tgt_keys, batch_keys):
    t = spark.createDataFrame([(k,) for k in tgt_keys], "k int")
    b = spark.createDataFrame([(k, i) for i, k in enumerate(batch_keys)], "k int, i int")
    tagged = L.incremental_tagged(t, b, ["k"]).collect()
    assert len(tagged) == len(batch_keys)
    assert sorted(r._row.i for r in tagged if r._new) == sorted(r.i for r in L.incremental_new_rows(t, b, ["k"]).collect())
