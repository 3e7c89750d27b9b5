"""Columns called like helper columns: none is changed, lost or refused."""

import re
from pathlib import Path

import pytest

import tidemark.operators as operators
from tidemark.operators import compare as C
from tidemark.operators import digest as DG
from tidemark.operators import loads as L

HOME = Path(operators.__file__).parent
#: Every helper name that the operators' code spells, and their result columns.
META = {*L.SCD2_META, L.CREATED_AT, L.UPDATED_AT}
NAMES = sorted(
    {n for f in ("loads.py", "compare.py", "digest.py") for n in re.findall(r"\b_[a-zA-Z]\w*", (HOME / f).read_text()) if not n.startswith("__")} - META
    | {"source_rows", "target_rows", "source_hash", "mismatched_pairs", "source_versions", "fingerprint", "cnt", "action", "has_history", "t__k", "s__k", "k__k", "bucket", "differ"}
)
AT = dict(as_of="2026-02-22 00:00:00")


def named(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"`{n}` {'int' if i == 0 else 'string'}" for i, n in enumerate(names)))


def test_names_are_found():
    assert {"_spread", "_new", "_sp", "_tp", "_flag", "_h", "_rows", "_row", "_ns", "_b"} <= set(NAMES) and len(NAMES) > 30


@pytest.mark.parametrize("at", range(0, len(NAMES), 12))
def test_every_helper_name_as_key_and_column(spark, at):
    """A table whose key and tracked columns are a dozen helper names."""
    names = NAMES[at : at + 12]
    key, cols = names[0], names[1:]
    row = lambda k, v: (k, *[f"{v}{i}" for i in range(len(cols))])
    old = named(spark, [row(1, "a"), row(2, "b"), row(None, "n")], names)
    new = named(spark, [row(2, "B"), row(3, "c"), row(None, "m")], names)
    plain = lambda df: sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=repr)
    every = sorted([row(1, "a"), row(2, "b"), row(None, "n"), row(3, "c"), row(None, "m")], key=repr)
    assert plain(L.incremental(old, new, [key])) == every
    assert plain(L.incremental_tagged(old, new, [key]).filter("_new").select("_row.*")) == sorted([row(3, "c"), row(None, "m")], key=repr)
    first = L.scd1(None, old, [key], cols, **AT)
    assert plain(first) == plain(old)
    assert plain(L.scd1(first, new, [key], cols, **AT)) == sorted([row(1, "a"), row(2, "B"), row(3, "c"), row(None, "n"), row(None, "m")], key=repr)
    state = L.scd2(None, old, [key], cols, batch_id="x", **AT)
    assert plain(state) == plain(old)
    again = L.scd2(state, new, [key], cols, batch_id="y", as_of="2026-02-23 00:00:00")
    assert plain(again) == sorted([*every, row(2, "B")], key=repr) and again.filter("is_active = 'N'").count() == 1
    assert {r[0] for r in L.scd2_actions(state, new, [key], cols, **AT).collect()} == {1, 2, 3, None}
    assert L.scd2_changes(L.scd2_joined(state, new, [key], cols, **AT)).count() == 4
    for read in (lambda k: C.reconcile(old, new, k), lambda k: DG.reconcile_digest(old, new, k)):
        r = read([key]).first()
        assert (r.source_count, r.target_count, r.missing_count, r.extra_count, r.mismatch_count) == (3, 3, 1, 1, 1)
    assert [tuple(r) for r in C.missing_keys(old, new, [key]).collect()] == [(1,)]
    assert [r[0] for r in C.mismatches(old, new, [key], cols).collect()] == [2]
    assert {r[0] for r in C.mismatch_versions(old, new, [key], cols).collect()} == {2}
    assert C.duplicate_keys(old.union(old), [key]).count() == 3
    want = sorted(map(tuple, C.issue_rows(old, new, [key]).collect()), key=repr)
    assert len(want) == 3 and want == sorted(map(tuple, DG.issue_rows_digest(old, new, [key]).collect()), key=repr)


def test_names_of_the_tables_own_are_refused_not_lost(spark):
    s = spark.createDataFrame([(1, "x")], "k int, batch_id string")
    with pytest.raises(ValueError, match="batch_id"):
        L.scd2(None, s, ["k"], ["batch_id"], **AT)


@pytest.mark.parametrize("exact", [False, True])
def test_nested_values_by_content(spark, exact):
    make = lambda *maps: spark.createDataFrame([(i, m, [m], (m, "x")) for i, m in enumerate(maps)], "k int, m map<string,int>, a array<map<string,int>>, s struct<m:map<string,int>,t:string>")
    a = make({"a": 1, "b": 2}, {"a": 1}, {}, None, {"a": None})
    b = make({"b": 2, "a": 1}, {"a": 2}, None, {}, {"a": None})
    got = {r.k for r in C.mismatches(a, b, ["k"], ["m", "a", "s"], exact=exact).collect()}
    assert got == {1, 2, 3}
    # lengths and NULLs are marked at every level
    x = spark.createDataFrame([(1, ["a", "b"]), (2, [None]), (3, ["N;"])], "k int, v array<string>")
    y = spark.createDataFrame([(1, ["ab"]), (2, []), (3, [None])], "k int, v array<string>")
    assert {r.k for r in C.mismatches(x, y, ["k"], ["v"], exact=True).collect()} == {1, 2, 3}
