"""Load and reconciliation jobs end to end: tables, snapshots, audit rows."""

import uuid

import pytest

from tidemark.plans import jobs as JB


@pytest.fixture()
def db(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name


def _cfg(db, specs):
    return {"job": {"name": "job", "batch_id": "b1"}, "tables": specs}


def test_scd2_job_twice_is_idempotent(spark, db):
    spark.createDataFrame([(1, "a", "N"), (2, "b", "N")], "k int, v string, del string").createOrReplaceTempView("src_v1")
    spec = {"name": "h", "source": {"table": "src_v1"}, "target": {"table_name": f"{db}.hist"}, "load_type": "scd2",
            "scd": {"keys": ["k"], "columns": ["v"]}, "delete_handling": {"enabled": True, "column": "del", "value": "Y"}}
    r1 = JB.run_loads(spark, _cfg(db, [spec]), as_of="2026-01-01 00:00:00", audit_table=f"{db}.audit").collect()[0]
    assert (r1.status, r1.inserted, r1.active_count) == ("SUCCESS", 2, 2)
    spark.createDataFrame([(1, "a", "N"), (2, "B", "N"), (3, "c", "N")], "k int, v string, del string").createOrReplaceTempView("src_v1")
    r2 = JB.run_loads(spark, _cfg(db, [spec]), as_of="2026-02-01 00:00:00", audit_table=f"{db}.audit").collect()[0]
    assert (r2.inserted, r2.updated, r2.active_count, r2.historical_count) == (1, 1, 3, 1)
    r3 = JB.run_loads(spark, _cfg(db, [spec]), as_of="2026-03-01 00:00:00", audit_table=f"{db}.audit").collect()[0]
    assert (r3.inserted, r3.updated, r3.deleted, r3.active_count, r3.historical_count) == (0, 0, 0, 3, 1)
    assert spark.read.table(f"{db}.hist").count() == 4
    assert spark.read.table(f"{db}.audit").count() == 3


def test_failures_are_isolated_and_audited(spark, db):
    spark.createDataFrame([(1, "a")], "k int, v string").createOrReplaceTempView("src_ok")
    specs = [
        {"name": "bad", "source": {}, "target": {"table_name": f"{db}.x"}, "load_type": "scd1"},
        {"name": "weird", "source": {"table": "src_ok"}, "target": {"table_name": f"{db}.y"}, "load_type": "nope"},
        {"name": "ok", "source": {"table": "src_ok"}, "target": {"table_name": f"{db}.z"}, "load_type": "full_refresh"},
    ]
    rows = {r.name: r for r in JB.run_loads(spark, _cfg(db, specs), audit_table=f"{db}.audit").collect()}
    assert rows["bad"].status == "FAILED" and "a source needs one of" in rows["bad"].error_message
    assert rows["weird"].status == "FAILED" and "Unknown load_type" in rows["weird"].error_message
    assert rows["ok"].status == "SUCCESS" and rows["ok"].active_count == 1
    assert spark.read.table(f"{db}.audit").filter("status = 'FAILED'").count() == 2
    with pytest.raises(ValueError):
        JB.run_loads(spark, _cfg(db, specs), names=["absent"])


def test_incremental_job_appends_new_keys_only(spark, db):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").createOrReplaceTempView("ev")
    spec = {"name": "e", "source": {"table": "ev"}, "target": {"table_name": f"{db}.ev"}, "load_type": "incremental",
            "scd": {"keys": ["k"]}}
    JB.run_loads(spark, _cfg(db, [spec])).collect()
    spark.createDataFrame([(2, "b"), (3, "c"), (3, "c")], "k int, v string").createOrReplaceTempView("ev")
    r = JB.run_loads(spark, _cfg(db, [spec])).collect()[0]
    assert (r.source_count, r.inserted, r.active_count) == (3, 2, 4)


def test_duplicate_keys_fail_the_load(spark, db):
    spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string").createOrReplaceTempView("dups")
    spec = {"name": "d", "source": {"table": "dups"}, "target": {"table_name": f"{db}.d"}, "load_type": "scd1",
            "scd": {"keys": ["k"], "columns": ["v"]}}
    r = JB.run_loads(spark, _cfg(db, [spec])).collect()[0]
    assert r.status == "FAILED" and "DUPLICATE_SOURCE_KEY" in r.error_message
    assert not spark.catalog.tableExists(f"{db}.d")


def test_reconciliation_job(spark, db):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string").createOrReplaceTempView("rs")
    spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "k int, v string").createOrReplaceTempView("rt")
    cfg = {
        "job": {"name": "r", "batch_id": "b", "results_table": f"{db}.res", "details_table": f"{db}.det"},
        "reconciliations": [
            {"name": "one", "source": {"table": "rs"}, "target": {"table": "rt"}, "keys": ["k"],
             "thresholds": {"max_mismatch_percent": 50.0}},
            {"name": "no_data", "source": {"table": "rs"}, "target": {"table": "rt"}, "keys": ["k"],
             "validations": {"data_comparison": False}},
            {"name": "broken", "source": {"table": "no_such_view"}, "target": {"table": "rt"}, "keys": ["k"]},
        ],
    }
    out = {r.recon_name: r for r in JB.run_reconciliations(spark, cfg).collect()}
    assert out["one"].overall_status == "FAILED" and not out["one"].threshold_breached
    assert out["no_data"].data_status == "SKIPPED" and out["no_data"].overall_status == "PASSED"
    assert out["broken"].overall_status == "FAILED" and out["broken"].error_message
    res = {r.recon_name: r for r in spark.read.table(f"{db}.res").collect()}
    assert res["one"].matched_count == 1 and res["one"].summary.startswith("Schema: Schemas are compatible; Data: 1/3")
    assert res["no_data"].source_count is None and res["no_data"].data_status == "SKIPPED"
    det = sorted(r.issue_type for r in spark.read.table(f"{db}.det").collect())
    assert det == ["EXTRA", "MISMATCH", "MISSING"]


def test_validation_switches(spark, db):
    spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string").createOrReplaceTempView("vs")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").createOrReplaceTempView("vt")
    cfg = {
        "job": {"name": "r", "batch_id": "b", "results_table": f"{db}.res", "details_table": f"{db}.det"},
        "reconciliations": [
            {"name": "nodup", "source": {"table": "vs"}, "target": {"table": "vt"}, "keys": ["k"],
             "validations": {"duplicate_check": False, "null_check": True}},
        ],
    }
    out = JB.run_reconciliations(spark, cfg).collect()[0]
    assert (out.overall_status, out.data_status) == ("FAILED", "FAILED")  # the value of key 2 differs
    res = spark.read.table(f"{db}.res").collect()[0]
    assert res.source_duplicates is None and res.target_duplicates is None
    det = {r.issue_type: r for r in spark.read.table(f"{db}.det").collect()}
    assert "SOURCE_DUPLICATE" not in det
    assert det["NULL_DIFFERENCE"].record_keys == '{"column":"v"}'
    assert (det["NULL_DIFFERENCE"].source_values, det["NULL_DIFFERENCE"].target_values) == ("1", "0")


def test_jobs_with_clock_time_keep_types_across_runs(spark, db):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").createOrReplaceTempView("clk")
    specs = [
        {"name": "h2", "source": {"table": "clk"}, "target": {"table_name": f"{db}.h2"}, "load_type": "scd2",
         "scd": {"keys": ["k"], "columns": ["v"]}},
        {"name": "h1", "source": {"table": "clk"}, "target": {"table_name": f"{db}.h1"}, "load_type": "scd1",
         "scd": {"keys": ["k"], "columns": ["v"]}},
    ]
    JB.run_loads(spark, _cfg(db, specs)).collect()  # as_of=None: current_timestamp()
    spark.createDataFrame([(1, "z"), (3, "c")], "k int, v string").createOrReplaceTempView("clk")
    rows = {r.name: r for r in JB.run_loads(spark, _cfg(db, specs)).collect()}
    assert rows["h2"].status == "SUCCESS" and (rows["h2"].inserted, rows["h2"].updated) == (1, 1)
    assert rows["h1"].status == "SUCCESS" and (rows["h1"].inserted, rows["h1"].updated) == (1, 1)
    h2 = spark.read.table(f"{db}.h2")
    assert dict(h2.dtypes)["effective_end_date"] == "timestamp"
    closed = h2.filter("is_active = 'N'").collect()[0]
    reopened = h2.filter("k = 1 AND is_active = 'Y'").collect()[0]
    assert closed.effective_end_date == reopened.effective_start_date  # one clock reading per load


def test_reconciliation_without_detail_logging(spark, db):
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").createOrReplaceTempView("nl_s")
    spark.createDataFrame([(1, "a"), (2, "x")], "k int, v string").createOrReplaceTempView("nl_t")
    cfg = {
        "job": {"name": "r", "batch_id": "b", "results_table": f"{db}.res", "details_table": f"{db}.det"},
        "reconciliations": [{"name": "q", "source": {"table": "nl_s"}, "target": {"table": "nl_t"}, "keys": ["k"]}],
        "settings": {"enable_detailed_logging": False},
    }
    out = JB.run_reconciliations(spark, cfg).collect()[0]
    assert out.data_status == "FAILED" and out.overall_status == "FAILED"
    assert not spark.catalog.tableExists(f"{db}.res") and not spark.catalog.tableExists(f"{db}.det")


def test_audit_goes_to_the_default_table(spark, db):
    spark.createDataFrame([(1, "a")], "k int, v string").createOrReplaceTempView("aud")
    spec = {"name": "f", "source": {"table": "aud"}, "target": {"table_name": f"{db}.f"}, "load_type": "full_refresh"}
    before = spark.read.table(JB.DEFAULT_AUDIT_TABLE).count() if spark.catalog.tableExists(JB.DEFAULT_AUDIT_TABLE) else 0
    JB.run_loads(spark, _cfg(db, [spec])).collect()
    assert spark.read.table(JB.DEFAULT_AUDIT_TABLE).count() == before + 1
    cfg = _cfg(db, [spec])
    cfg["job"]["audit_table"] = f"{db}.own"
    JB.run_loads(spark, cfg).collect()
    assert spark.read.table(f"{db}.own").count() == 1
    JB.run_loads(spark, _cfg(db, [spec]), audit_table=False).collect()
    assert spark.read.table(JB.DEFAULT_AUDIT_TABLE).count() == before + 1


def test_other_hash_kind_is_refused(spark, db):
    spark.createDataFrame([(1, "a", "x")], "k int, v string, w string").createOrReplaceTempView("hk")
    spec = {"name": "h", "source": {"table": "hk"}, "target": {"table_name": f"{db}.h"}, "scd": {"keys": ["k"], "columns": ["v", "w"]}}
    assert JB.run_loads(spark, _cfg(db, [spec])).collect()[0].status == "SUCCESS"
    exact = {**spec, "scd": {**spec["scd"], "exact": True}}
    r = JB.run_loads(spark, _cfg(db, [exact])).collect()[0]
    assert r.status == "FAILED" and "plain fingerprints" in r.error_message
    r = JB.run_loads(spark, _cfg(db, [spec])).collect()[0]
    assert (r.status, r.updated, r.active_count) == ("SUCCESS", 0, 1)


def test_records_need_their_not_null_columns(spark, db):
    spark.createDataFrame([(1, "a")], "k int, v string").createOrReplaceTempView("nn")
    cfg = {"job": {"name": "r", "results_table": f"{db}.res", "details_table": f"{db}.det"},
           "reconciliations": [{"name": "q", "source": {"table": "nn"}, "target": {"table": "nn"}, "keys": ["k"]}]}
    out = JB.run_reconciliations(spark, cfg).collect()[0]
    assert out.overall_status == "FAILED" and "batch_id" in out.error_message


def test_every_issue_is_written_and_a_sample_on_request(spark, db):
    spark.range(100).selectExpr("id AS k", "'a' AS v").createOrReplaceTempView("all_s")
    spark.range(100).selectExpr("id AS k", "'b' AS v").createOrReplaceTempView("all_t")
    cfg = {"job": {"name": "r", "batch_id": "b", "results_table": f"{db}.res", "details_table": f"{db}.det"},
           "reconciliations": [{"name": "q", "source": {"table": "all_s"}, "target": {"table": "all_t"}, "keys": ["k"],
                                "validations": {"row_count_check": False}}]}
    JB.run_reconciliations(spark, cfg).collect()
    det, res = spark.read.table(f"{db}.det"), spark.read.table(f"{db}.res").collect()[0]
    assert det.count() == 100 and det.filter("source_values IS NULL OR target_values IS NULL").count() == 0
    assert (res.mismatch_count, res.source_count, res.target_count) == (100, None, None)
    cfg["settings"] = {"sample_mismatches": 7}
    JB.run_reconciliations(spark, cfg).collect()
    assert spark.read.table(f"{db}.det").count() == 107


def test_loads_leave_nothing_in_the_checkpoint_folder(spark, db):
    from pathlib import Path

    at = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(at.rglob("part-*"))
    for v in ("a", "b"):
        spark.createDataFrame([(1, v), (2, "x")], "k int, v string").createOrReplaceTempView("one")
        for kind in ("scd1", "scd2", "incremental"):
            spec = {"name": kind, "source": {"table": "one"}, "target": {"table_name": f"{db}.o_{kind}"}, "load_type": kind,
                    "scd": {"keys": ["k"], "columns": ["v"]}}
            assert JB.run_loads(spark, _cfg(db, [spec])).collect()[0].status == "SUCCESS"
    assert set(at.rglob("part-*")) == before
