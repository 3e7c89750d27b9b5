"""Key buckets, clustered tables, appends and jobs that run again, snapshots, parallel specs."""

import os
import threading
import uuid
from pathlib import Path

import pytest

from tidemark.operators import loads as L
from tidemark.plans import jobs as JB
from tidemark.sinks import buckets as BK
from tidemark.sinks import records as RC
from tidemark.sinks import tables as TB
from tidemark.sources.tables import load_source, read_table
from tidemark.streaming.batches import load_each_batch

AT = "2026-02-22 00:00:00"


@pytest.fixture()
def db(spark):
    name = f"st_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def history(spark, n=2000):
    return L.scd2(None, spark.range(n).selectExpr("cast(id as int) AS k", "concat('v', id) AS v"), ["k"], ["v"], as_of="2026-01-01 00:00:00", batch_id="b0")


def spec_of(name, table, kind="scd2", **target):
    return {"name": name, "target": {"table_name": table, **target}, "load_type": kind, "scd": {"keys": ["k"], "columns": ["v"]}}


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_bucketed_state_equals_the_whole_one(spark, db, kind):
    args = dict(as_of=AT, batch_id="b1")
    first = history(spark, 300) if kind == "scd2" else L.scd1(None, spark.range(300).selectExpr("cast(id as int) AS k", "concat('v', id) AS v"), ["k"], ["v"], as_of="2026-01-01 00:00:00")
    batch = spark.createDataFrame([(5, "x"), (6, "v6"), (900, "new"), (None, "keyless"), (None, "other")], "k bigint, v string")
    TB.create_table(spark, first, f"{db}.whole")
    BK.create_state(spark, first, f"{db}.parts", ["k"], 32)
    whole = JB.run_load(spark, spec_of("a", f"{db}.whole", kind), batch, "b1", AT)
    parts = JB.run_load(spark, spec_of("b", f"{db}.parts", kind, key_buckets=32), batch, "b1", AT)
    assert whole == parts and rows_of(spark.read.table(f"{db}.whole")) == rows_of(spark.read.table(f"{db}.parts"))
    again = spark.createDataFrame([(5, "y"), (None, "third")], "k bigint, v string")
    assert JB.run_load(spark, spec_of("a", f"{db}.whole", kind), again, "b2", AT) == JB.run_load(spark, spec_of("b", f"{db}.parts", kind, key_buckets=32), again, "b2", AT)
    assert rows_of(spark.read.table(f"{db}.whole")) == rows_of(spark.read.table(f"{db}.parts"))
    only = spark.createDataFrame([(None, "alone")], "k bigint, v string")
    assert JB.run_load(spark, spec_of("b", f"{db}.parts", kind, key_buckets=32), only, "b3", AT)["inserted"] == 1
    assert JB.run_load(spark, spec_of("b", f"{db}.parts", kind, key_buckets=32), only.limit(0), "b4", AT)["source_count"] == 0
    with pytest.raises(ValueError, match="not kept in key buckets"):
        JB.run_load(spark, spec_of("a", f"{db}.whole", kind, key_buckets=4), batch, "b5", AT)


def _bytes(places):
    return sum(f.stat().st_size for p in places for f in Path(p.removeprefix("file:")).rglob("*.parquet"))


def test_a_load_writes_what_its_batch_touches(spark, db):
    BK.create_state(spark, history(spark, 20_000), f"{db}.h", ["k"], 100)
    state = BK.bucketed_state(spark, f"{db}.h")
    before = state.manifest
    batch = spark.createDataFrame([(7, "changed")], "k int, v string")
    assert len(state.touched(batch)) == 1
    JB.run_load(spark, spec_of("h", f"{db}.h", key_buckets=100), batch, "b1", AT)
    after = BK.bucketed_state(spark, f"{db}.h").manifest
    new = {p["path"] for p in after.values()} - {p["path"] for p in before.values()}
    assert len(new) == 1 and _bytes(new) < 0.03 * _bytes(p["path"] for p in before.values())
    plan = BK.bucketed_state(spark, f"{db}.h").read([3])._jdf.queryExecution().executedPlan().toString()
    assert "(1 paths)" in plan and "PartitionFilters" in plan
    assert spark.read.table(f"{db}.h").count() == 20_001
    assert BK.release_versions(spark, f"{db}.h") == 1 and spark.read.table(f"{db}.h").count() == 20_001
    assert not any(os.path.exists(p["path"].removeprefix("file:")) for b, p in before.items() if p["path"] not in {x["path"] for x in after.values()})


def test_a_load_that_dies_before_its_commit_leaves_the_old_state(spark, db, monkeypatch):
    BK.create_state(spark, history(spark, 50), f"{db}.h", ["k"], 8)
    old = rows_of(spark.read.table(f"{db}.h"))

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(BK, "_commit", die)
        with pytest.raises(RuntimeError):
            JB.run_load(spark, spec_of("h", f"{db}.h", key_buckets=8), spark.createDataFrame([(1, "x")], "k int, v string"), "b1", AT)
    assert rows_of(spark.read.table(f"{db}.h")) == old


@pytest.mark.parametrize("kind", ["scd1", "scd2"])
def test_clustered_target_is_joined_as_it_lies(spark, db, kind):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spec = spec_of("h", f"{db}.h", kind, cluster_by_keys=8)
        source = spark.range(400).selectExpr("cast(id as int) AS k", "concat('v', id) AS v")
        JB.run_load(spark, spec, source, "b0", "2026-01-01 00:00:00")
        JB.run_load(spark, spec, source.limit(50), "b1", "2026-01-02 00:00:00")
        assert TB.clustering(spark, f"{db}.h") == (8, ["k"])  # kept by the snapshot of the second load
        changed = source.selectExpr("k", "CASE WHEN k < 9 THEN 'x' ELSE v END AS v").filter("k < 100")
        target = read_table(spark, f"{db}.h")
        joined = L.scd1_joined(target, changed, ["k"], ["v"], AT) if kind == "scd1" else L.scd2_joined(target, changed, ["k"], ["v"], AT, "b2")
        with JB._as_it_lies(spark):
            plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "SortMergeJoin" in plan  # the source's
        plain = TB.create_table(spark, target, f"{db}.plain")
        want = JB.run_load(spark, spec_of("p", f"{db}.plain", kind), changed, "b2", AT)
        assert plain and JB.run_load(spark, spec, changed, "b2", AT) == want
        assert rows_of(spark.read.table(f"{db}.h")) == rows_of(spark.read.table(f"{db}.plain"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_append_is_finished_by_the_next_run(spark, db, monkeypatch):
    source = spark.range(40).selectExpr("id AS k", "concat('v', id) AS v").repartition(4)
    TB.create_table(spark, source.filter("k < 3"), f"{db}.t")
    moved = []
    real = TB.file_system

    def dies_on_third_move(spark, path):
        if "/part-" in path and "_staged" not in path:
            moved.append(path)
            if len(moved) == 3:
                raise RuntimeError("killed")
        return real(spark, path)

    with monkeypatch.context() as m:
        m.setattr(TB, "file_system", dies_on_third_move)
        with pytest.raises(RuntimeError):
            TB.append_once(spark, source, f"{db}.t", "batch-1")
    spec = {"name": "t", "source": {"sql": "SELECT 1"}, "target": {"table_name": f"{db}.t"}, "load_type": "incremental"}
    out = JB.run_load(spark, spec, source, "b", tag="batch-1")
    assert out["active_count"] == 43 and JB.run_load(spark, spec, source, "b", tag="batch-1") is None
    spark.catalog.refreshTable(f"{db}.t")
    assert rows_of(spark.read.table(f"{db}.t")) == rows_of(source.union(source.filter("k < 3")))
    assert JB.run_load(spark, spec, source, "b", tag="batch-2")["inserted"] == 40


@pytest.mark.parametrize("kind,more", [("scd1", {}), ("scd2", {}), ("scd2", {"key_buckets": 4}), ("incremental", {}), ("full_refresh", {})])
def test_jobs_recognise_a_batch_that_ran(spark, db, kind, more):
    spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string").createOrReplaceTempView("rerun_src")
    spec = {**spec_of("s", f"{db}.t", kind, **more), "source": {"table": "rerun_src"}}
    config = lambda batch: {"job": {"name": "j", "batch_id": batch, "rerun_safe": True}, "tables": [spec]}
    run = lambda batch: JB.run_loads(spark, config(batch), as_of=AT, audit_table=f"{db}.audit").collect()[0]
    assert run("b1").status == "SUCCESS" and run("b1").status == "SKIPPED"
    rows = rows_of(spark.read.table(f"{db}.t"))
    assert run("b2").status == "SUCCESS" and run("b2").status == "SKIPPED"
    assert len(rows) == 2 and spark.read.table(f"{db}.t").count() == (2 if kind == "full_refresh" else 3)
    assert [r.status for r in spark.read.table(f"{db}.audit").orderBy("start_time").collect()] == ["SUCCESS", "SKIPPED"] * 2


def test_stream_epochs_are_applied_once(spark, db):
    apply = load_each_batch({"name": "s", "target": {"table_name": f"{db}.t"}, "load_type": "incremental"}, stream="checkpoint-1")
    batch = spark.createDataFrame([(None, "x"), (1, "y")], "k int, v string")
    for epoch in (0, 0, 1, 1, 0):
        apply(batch, epoch)
    assert spark.read.table(f"{db}.t").count() == 4


def test_snapshots_are_listed_read_and_released(spark, db):
    frames = [spark.range(n).selectExpr("id") for n in (3, 4, 5)]
    TB.create_table(spark, frames[0], f"{db}.t")
    for f in frames[1:]:
        TB.replace_state(spark, f, f"{db}.t")
    found = TB.snapshots(spark, f"{db}.t")
    assert [TB.read_snapshot(spark, p).count() for p in found] == [3, 4, 5]
    assert TB.release_snapshots(spark, f"{db}.t", keep=2) == found[:1] and TB.snapshots(spark, f"{db}.t") == found[1:]
    assert TB.release_snapshots(spark, f"{db}.t", keep=1) == found[1:2] and spark.read.table(f"{db}.t").count() == 5


@pytest.mark.parametrize("dies_at", ["before", "between"])
def test_a_replacement_that_dies_loses_no_table(spark, db, monkeypatch, dies_at):
    TB.create_table(spark, spark.range(3).selectExpr("id"), f"{db}.t")

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        if dies_at == "before":
            real = TB.drop_table
            m.setattr(TB, "drop_table", lambda s, name: die() if name == f"{db}.t" else real(s, name))
        else:
            real_finish = TB.finish_replacement
            calls = []
            m.setattr(TB, "finish_replacement", lambda s, name: real_finish(s, name) if not calls.append(1) and len(calls) == 1 else die())
        with pytest.raises(RuntimeError):
            TB.replace_table_as(spark, spark.range(5).selectExpr("id AS other", "'x' AS more"), f"{db}.t")
    assert read_table(spark, f"{db}.t").count() == (3 if dies_at == "before" else 5)
    TB.replace_table_as(spark, spark.range(7).selectExpr("id AS third"), f"{db}.t")
    assert read_table(spark, f"{db}.t").columns == ["third"]


def test_specs_wait_for_what_they_read(spark, db):
    table = lambda n, **s: {"name": n, "source": s, "target": {"table_name": f"{db}.{n}"}, "load_type": "full_refresh"}
    specs = [table("a", sql="SELECT 1 AS k"), table("b", sql=f"SELECT k + 1 AS k FROM {db}.a"), table("c", table=f"{db}.b"),
             table("d", sql=f"SELECT 5 AS k -- not {db}.a_other"), table("a", sql="SELECT 9 AS k")]
    assert JB.waits_for(specs) == [set(), {0}, {1}, set(), {0, 1}]
    config = {"job": {"name": "p", "parallel_execution": 4}, "tables": [*specs, {"name": "bad", "source": {}, "target": {"table_name": f"{db}.x"}}]}
    out = JB.run_loads(spark, config, audit_table=f"{db}.audit").collect()
    assert [r.name for r in out] == ["a", "b", "c", "d", "a", "bad"] and [r.status for r in out] == ["SUCCESS"] * 5 + ["FAILED"]
    assert [spark.read.table(f"{db}.{t}").first()[0] for t in "abcd"] == [9, 2, 2, 5]
    assert spark.read.table(f"{db}.audit").count() == 6


def test_specs_run_side_by_side_under_tags(spark):
    meet, tags = threading.Barrier(3, timeout=60), []

    def run(spec):
        tags.append(spark.sparkContext.getJobTags())
        meet.wait()  # all three are in here at once, or this raises
        return (spec["name"],)

    specs = [{"name": f"s{i}", "source": {}, "target": {}} for i in range(3)]
    assert JB._run_all(spark, "job", specs, 3, run) == [("s0",), ("s1",), ("s2",)]
    assert sorted(map(sorted, tags)) == [["job-s0"], ["job-s1"], ["job-s2"]]


def test_parallel_reconciliations_and_records_by_day(spark, db):
    for i in range(3):
        spark.range(50).selectExpr("id AS k", f"CASE WHEN id < {i} THEN 'x' ELSE 'y' END AS v").createOrReplaceTempView(f"side_{i}")
    recs = [{"name": f"r{i}", "source": {"table": "side_0"}, "target": {"table": f"side_{i}"}, "keys": ["k"],
             "drill_down": i == 2, "unique_keys": i == 2} for i in range(3)]
    config = {"job": {"name": "j", "batch_id": "b", "results_table": f"{db}.results", "details_table": f"{db}.details"},
              "reconciliations": recs, "settings": {"parallel_execution": True, "partition_by_day": True}}
    assert [r.recon_name for r in JB.run_reconciliations(spark, config).collect()] == ["r0", "r1", "r2"]
    results = {r.recon_name: (r.source_count, r.mismatch_count) for r in spark.read.table(f"{db}.results").collect()}
    assert results == {"r0": (50, 0), "r1": (50, 1), "r2": (50, 2)}
    from tidemark.operators import reports as RP

    details = spark.read.table(f"{db}.details")
    day = str(details.first()[RC.DAY])
    report = RP.issue_counts(details, day)
    assert sorted(map(tuple, report.collect())) == [("r1", "MISMATCH", 1), ("r2", "MISMATCH", 2)]
    assert "PartitionFilters: [isnotnull(execution_day" in report._jdf.queryExecution().executedPlan().toString()
    assert RP.issue_counts(details, "2000-01-01").count() == 0
    n = len(details.inputFiles())
    TB.compact_partition(spark, f"{db}.details", RC.DAY, day)
    after = spark.read.table(f"{db}.details")
    assert n > 1 == len(after.inputFiles()) and after.count() == 3


def test_markers_of_a_source(spark):
    got = load_source(spark, {"sql": "SELECT :as_of AS a, :limit AS n", "args": {"limit": 5}}, {"as_of": AT, "batch_id": "unused"}).first()
    assert tuple(got) == (AT, 5)
