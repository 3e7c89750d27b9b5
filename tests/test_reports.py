"""Report queries over result and detail rows."""

import datetime as dt

from tidemark.operators import reports as RP

RES = ("recon_id string, recon_name string, execution_time timestamp_ntz, status string, source_count long, "
       "target_count long, matched_count long, match_rate double, missing_count long, extra_count long, "
       "mismatch_count long, summary string")
DET = "recon_id string, recon_name string, execution_time timestamp_ntz, issue_type string, record_keys string"


def _res(spark):
    d = dt.datetime
    rows = [
        ("a", "x", d(2026, 1, 1, 8), "PASSED", 1, 1, 1, 100.0, 0, 0, 0, "s"),
        ("b", "x", d(2026, 1, 2, 8), "FAILED", 4, 4, 3, 75.0, 1, 0, 0, "s"),
        ("c", "x", d(2026, 1, 2, 8), "FAILED", 4, 4, 2, 50.0, 1, 0, 1, "s"),  # same time as b
        ("d", "x", d(2026, 1, 2, 9), "SKIPPED", None, None, None, None, None, None, None, "s"),
    ]
    return spark.createDataFrame(rows, RES)


def test_latest_breaks_time_ties_by_id(spark):
    got = [r.recon_id for r in RP.latest_results(_res(spark), 3).collect()]
    assert got == ["d", "c", "b"]


def test_trend_ignores_null_rates(spark):
    got = {(r.recon_name, str(r.run_date)): (r.avg_match_rate, r.run_count)
           for r in RP.match_rate_trend(_res(spark)).collect()}
    assert got == {("x", "2026-01-01"): (100.0, 1), ("x", "2026-01-02"): (62.5, 3)}


def test_details_and_issue_counts(spark):
    d = dt.datetime
    det = spark.createDataFrame([
        ("a", "x", d(2026, 1, 1, 8), "MISSING", "{}"),
        ("b", "x", d(2026, 1, 2, 8), "MISMATCH", "{1}"),
        ("b", "x", d(2026, 1, 2, 8), "MISMATCH", "{2}"),
        ("b", "y", d(2026, 1, 2, 8), "MISMATCH", "{3}"),
    ], DET)
    assert [r.record_keys for r in RP.details_for(det, "x", "MISMATCH").collect()] == ["{1}", "{2}"]
    assert RP.details_for(det, "x", "MISMATCH", 1).count() == 1
    counts = {(r.recon_name, r.issue_type): r.issue_count for r in RP.issue_counts(det, "2026-01-02").collect()}
    assert counts == {("x", "MISMATCH"): 2, ("y", "MISMATCH"): 1}
