"""The registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query runs one operator of the library over whole driver tables (or
inputs Spark derives from them, see ``inputs``).  ``oracle.ORACLE`` holds the
matching DuckDB SQL under the same names; column names agree one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import compare as C
from tidemark.plans import inputs as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _in(spark, sf, fn) -> DataFrame:
    return I.spark_input(spark, sf, fn)


# ---------------------------------------------------------------- reconciliation

CUST_KEYS = ["c_custkey"]
LI_KEYS = ["l_orderkey", "l_linenumber"]
CUST_THRESHOLDS = {"max_mismatch_percent": 5.0, "max_missing_percent": 2.0}
LI_THRESHOLDS = {"max_mismatch_percent": 10.0, "max_missing_percent": 5.0}


def customer_pair(spark, sf):
    return _in(spark, sf, I.recon_source_sql), _in(spark, sf, I.recon_target_sql)


def customer_nullkey_pair(spark, sf):
    return _in(spark, sf, I.recon_source_nullkey_sql), _in(spark, sf, I.recon_target_nullkey_sql)


def lineitem_pair(spark, sf):
    base = I.lineitem_clean_sql(I.SPARK)
    return _in(spark, sf, base), _in(spark, sf, I.lineitem_perturbed_sql(base))


def lineitem_raw_pair(spark, sf):
    base = I.lineitem_raw_sql(I.SPARK)
    return _in(spark, sf, base), _in(spark, sf, I.lineitem_perturbed_sql(base))


@query("recon_counts")
def recon_counts(spark, sf):
    s, t = customer_pair(spark, sf)
    return C.row_counts(s, t)


@query("recon_dup_source")
def recon_dup_source(spark, sf):
    s, _ = customer_nullkey_pair(spark, sf)
    return C.duplicate_keys(s, CUST_KEYS)


@query("recon_dup_target")
def recon_dup_target(spark, sf):
    _, t = customer_pair(spark, sf)
    return C.duplicate_keys(t, CUST_KEYS)


@query("recon_dup_composite")
def recon_dup_composite(spark, sf):
    s, _ = lineitem_raw_pair(spark, sf)
    return C.duplicate_keys(s, LI_KEYS)


@query("recon_missing")
def recon_missing(spark, sf):
    s, t = customer_nullkey_pair(spark, sf)
    return C.missing_keys(s, t, CUST_KEYS)


@query("recon_extra")
def recon_extra(spark, sf):
    s, t = customer_nullkey_pair(spark, sf)
    return C.extra_keys(s, t, CUST_KEYS)


def _mism(s, t, keys, include=None, exclude=None):
    cols = C.compare_columns(s.columns, t.columns, keys, include, exclude)
    return C.mismatches(s, t, keys, cols)


@query("recon_mismatch_all")
def recon_mismatch_all(spark, sf):
    s, t = customer_pair(spark, sf)
    return _mism(s, t, CUST_KEYS)


@query("recon_mismatch_subset")
def recon_mismatch_subset(spark, sf):
    s, t = customer_pair(spark, sf)
    return _mism(s, t, CUST_KEYS, include=["c_mktsegment", "no_such_column"])


@query("recon_mismatch_excluded")
def recon_mismatch_excluded(spark, sf):
    s, t = customer_pair(spark, sf)
    return _mism(s, t, CUST_KEYS, exclude=["c_mktsegment"])


@query("recon_mismatch_composite")
def recon_mismatch_composite(spark, sf):
    s, t = lineitem_pair(spark, sf)
    return _mism(s, t, LI_KEYS)


@query("recon_mismatch_fanout")
def recon_mismatch_fanout(spark, sf):
    s, t = lineitem_raw_pair(spark, sf)
    return _mism(s, t, LI_KEYS)


@query("recon_summary")
def recon_summary(spark, sf):
    s, t = customer_pair(spark, sf)
    return C.reconcile(s, t, CUST_KEYS, source_name="customer_source", target_name="customer_target")


@query("recon_summary_null_keys")
def recon_summary_null_keys(spark, sf):
    s, t = customer_nullkey_pair(spark, sf)
    return C.reconcile(s, t, CUST_KEYS, source_name="customer_source", target_name="customer_target_nk")


@query("recon_summary_composite")
def recon_summary_composite(spark, sf):
    s, t = lineitem_pair(spark, sf)
    return C.reconcile(s, t, LI_KEYS, source_name="lineitem_source", target_name="lineitem_target")


@query("recon_summary_fanout")
def recon_summary_fanout(spark, sf):
    s, t = lineitem_raw_pair(spark, sf)
    return C.reconcile(s, t, LI_KEYS, source_name="lineitem_raw", target_name="lineitem_raw_target")


@query("recon_summary_identical")
def recon_summary_identical(spark, sf):
    s, _ = customer_pair(spark, sf)
    return C.reconcile(s, s, CUST_KEYS, source_name="customer_source", target_name="customer_source")


def shift_pair(spark, sf):
    return _in(spark, sf, I.recon_shift_source_sql), _in(spark, sf, I.recon_shift_target_sql)


@query("recon_summary_shift_plain")
def recon_summary_shift_plain(spark, sf):
    """The reference's fingerprint: a value moved next to a NULL goes unseen."""
    s, t = shift_pair(spark, sf)
    return C.reconcile(s, t, CUST_KEYS, source_name="customer_shift_source", target_name="customer_shift_target")


@query("recon_summary_exact")
def recon_summary_exact(spark, sf):
    """The null-safe fingerprint sees it."""
    s, t = shift_pair(spark, sf)
    return C.reconcile(s, t, CUST_KEYS, exact=True, source_name="customer_shift_source",
                       target_name="customer_shift_target")


@query("recon_mismatch_exact")
def recon_mismatch_exact(spark, sf):
    s, t = shift_pair(spark, sf)
    return C.mismatches(s, t, CUST_KEYS, C.compare_columns(s.columns, t.columns, CUST_KEYS), exact=True)


@query("recon_mismatch_exact_timestamps")
def recon_mismatch_exact_timestamps(spark, sf):
    """Times that differ below the millisecond differ."""
    s, t = _in(spark, sf, I.events_times_sql), _in(spark, sf, I.events_shifted_times_sql)
    return C.mismatches(s, t, ["event_id"], I.EV_TIME_COLS, exact=True)


def _versions(pair, keys):
    s, t = pair
    return C.mismatch_versions(s, t, keys, C.compare_columns(s.columns, t.columns, keys))


@query("recon_mismatch_versions")
def recon_mismatch_versions(spark, sf):
    return _versions(customer_pair(spark, sf), CUST_KEYS)


@query("recon_mismatch_versions_lineitem")
def recon_mismatch_versions_lineitem(spark, sf):
    """Line items as they are: keys with several versions on either side."""
    return _versions(lineitem_raw_pair(spark, sf), LI_KEYS)


@query("recon_issues")
def recon_issues(spark, sf):
    """Every issue of the customer pair and of the pair with NULL keys."""
    a = C.issue_rows(*customer_pair(spark, sf), CUST_KEYS)
    return a.unionByName(C.issue_rows(*customer_nullkey_pair(spark, sf), CUST_KEYS))


@query("recon_issues_lineitem")
def recon_issues_lineitem(spark, sf):
    return C.issue_rows(*lineitem_raw_pair(spark, sf), LI_KEYS)


@query("recon_thresholds")
def recon_thresholds(spark, sf):
    s, t = customer_pair(spark, sf)
    a = C.with_thresholds(C.reconcile(s, t, CUST_KEYS, source_name="customer_source", target_name="customer_target"), CUST_THRESHOLDS)
    ls, lt = lineitem_pair(spark, sf)
    b = C.with_thresholds(C.reconcile(ls, lt, LI_KEYS, source_name="lineitem_source", target_name="lineitem_target"), LI_THRESHOLDS)
    c = C.with_thresholds(C.reconcile(s, s, CUST_KEYS, source_name="customer_source", target_name="customer_source"), CUST_THRESHOLDS)
    return a.unionByName(b).unionByName(c)


@query("recon_details")
def recon_details(spark, sf):
    s, t = customer_nullkey_pair(spark, sf)
    return C.issue_rows(s, t, CUST_KEYS, sample_size=10)  # the first of each type: the feature


@query("recon_null_profile")
def recon_null_profile(spark, sf):
    s, t = customer_nullkey_pair(spark, sf)
    return C.null_profile(s, t)


# ---------------------------------------------------------------- loads

from tidemark.operators import loads as L  # noqa: E402

EV_KEYS = ["event_id"]


def _stat_row(stats: DataFrame, load_type: str, table: str) -> DataFrame:
    from pyspark.sql import functions as F

    return stats.select(
        F.lit(table).alias("table_name"),
        F.lit(load_type).alias("operation_type"),
        *[F.col(c).cast("long").alias(c) for c in L_STAT_COLS],
    )


L_STAT_COLS = ["source_count", "inserted", "updated", "deleted", "active_count", "historical_count"]


def events_pair(spark, sf):
    return _in(spark, sf, I.events_target_sql), _in(spark, sf, I.events_batch_sql)


def scd1_pair(spark, sf):
    return _in(spark, sf, I.scd1_target_sql), _in(spark, sf, I.scd1_source_sql)


def scd2_pair(spark, sf):
    return _in(spark, sf, I.scd2_target_sql), _in(spark, sf, I.scd2_source_sql)


def scd2_part_pair(spark, sf):
    return _in(spark, sf, I.scd2_part_target_sql), _in(spark, sf, I.scd2_part_source_sql)


SCD2_ARGS = dict(
    keys=I.SCD2_KEYS,
    columns=I.SCD2_COLUMNS,
    as_of=I.AS_OF,
    batch_id=I.BATCH_ID,
    delete_column=I.SCD2_DELETE[0],
    delete_value=I.SCD2_DELETE[1],
)
SCD2P_ARGS = dict(keys=I.SCD2P_KEYS, columns=I.SCD2P_COLUMNS, as_of=I.AS_OF, batch_id=I.BATCH_ID)


@query("incremental_first")
def incremental_first(spark, sf):
    return L.incremental(None, _in(spark, sf, I.events_sql), EV_KEYS)


@query("incremental_keyed")
def incremental_keyed(spark, sf):
    t, b = events_pair(spark, sf)
    return L.incremental(t, b, EV_KEYS)


@query("incremental_new_rows")
def incremental_new_rows(spark, sf):
    t, b = events_pair(spark, sf)
    return L.incremental_new_rows(t, b, EV_KEYS)


@query("incremental_append")
def incremental_append(spark, sf):
    whole = _in(spark, sf, I.events_sql)
    return L.incremental(whole, whole, [])


@query("incremental_hard_batch")
def incremental_hard_batch(spark, sf):
    """A batch with repeated and NULL keys."""
    return L.incremental(_in(spark, sf, I.events_target_sql), _in(spark, sf, I.events_dup_batch_sql), EV_KEYS)


@query("scd1_first")
def scd1_first(spark, sf):
    s = _in(spark, sf, I.scd1_first_source_sql)
    return L.scd1(None, s, I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF)


@query("scd1_upsert")
def scd1_upsert(spark, sf):
    t, s = scd1_pair(spark, sf)
    return L.scd1(t, s, I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF)


@query("scd1_null_keys")
def scd1_null_keys(spark, sf):
    """A third of the rows without a key on both sides, and NULL tracked values."""
    t, s = _in(spark, sf, I.scd1_nullkey_target_sql), _in(spark, sf, I.scd1_nullkey_source_sql)
    return L.scd1(t, s, I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF)


@query("scd1_composite")
def scd1_composite(spark, sf):
    t, s = _in(spark, sf, I.scd1_line_target_sql), _in(spark, sf, I.scd2_line_source_sql)
    return L.scd1(t, s, I.LI_SCD_KEYS, I.LI_SCD_COLUMNS, as_of=I.AS_OF)


@query("scd2_null_keys")
def scd2_null_keys(spark, sf):
    t, s = _in(spark, sf, I.scd2_nullkey_target_sql), _in(spark, sf, I.scd2_nullkey_source_sql)
    return L.scd2(t, s, **SCD2_ARGS)


@query("scd2_composite")
def scd2_composite(spark, sf):
    t, s = _in(spark, sf, I.scd2_line_target_sql), _in(spark, sf, I.scd2_line_source_sql)
    return L.scd2(t, s, keys=I.LI_SCD_KEYS, columns=I.LI_SCD_COLUMNS, as_of=I.AS_OF, batch_id=I.BATCH_ID)


@query("scd2_delete_case")
def scd2_delete_case(spark, sf):
    """The delete column named in another case than the source spells it."""
    t, s = scd2_pair(spark, sf)
    return L.scd2(t, s, **{**SCD2_ARGS, "delete_column": I.SCD2_DELETE[0].upper()})


@query("scd1_change_set")
def scd1_change_set(spark, sf):
    t, s = scd1_pair(spark, sf)
    j = L.scd1_joined(t, s, I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF)
    return L.scd1_changes(j)


@query("scd1_actions")
def scd1_actions(spark, sf):
    from pyspark.sql import functions as F

    t, s = scd1_pair(spark, sf)
    j = L.scd1_joined(t, s, I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF)
    return j.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("n_keys"))


@query("scd2_first")
def scd2_first(spark, sf):
    return L.scd2(None, _in(spark, sf, I.scd2_first_source_sql), **SCD2_ARGS)


@query("scd2_full")
def scd2_full(spark, sf):
    t, s = scd2_pair(spark, sf)
    return L.scd2(t, s, **SCD2_ARGS)


def _scd2_rows_for(spark, sf, wanted: str):
    """State rows written for keys with one action (closed, kept and new rows)."""
    from pyspark.sql import functions as F

    t, s = scd2_pair(spark, sf)
    j = L.scd2_joined(t, s, **SCD2_ARGS, label_reactivated=wanted in (L.NEW, L.REACTIVATED))
    rows = L.scd2_state_from_joined(j, t, with_action=True)
    return rows.filter(F.col("action") == wanted)


@query("scd2_change")
def scd2_change(spark, sf):
    return _scd2_rows_for(spark, sf, L.CHANGED)


@query("scd2_delete")
def scd2_delete(spark, sf):
    return _scd2_rows_for(spark, sf, L.DELETED)


@query("scd2_insert")
def scd2_insert(spark, sf):
    return _scd2_rows_for(spark, sf, L.NEW)


@query("scd2_reactivate")
def scd2_reactivate(spark, sf):
    return _scd2_rows_for(spark, sf, L.REACTIVATED)


@query("scd2_change_set")
def scd2_change_set(spark, sf):
    t, s = scd2_pair(spark, sf)
    return L.scd2_changes(L.scd2_joined(t, s, **SCD2_ARGS))


@query("scd2_counts")
def scd2_counts(spark, sf):
    from pyspark.sql import functions as F

    t, s = scd2_pair(spark, sf)
    acts = L.scd2_actions(t, s, **SCD2_ARGS)
    return acts.groupBy("action").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if("has_history").alias("n_with_history")
    )


@query("scd2_no_delete")
def scd2_no_delete(spark, sf):
    t, s = scd2_part_pair(spark, sf)
    return L.scd2(t, s, **SCD2P_ARGS)


@query("full_refresh")
def full_refresh(spark, sf):
    return L.full_refresh(_in(spark, sf, I.part_source_sql))


@query("load_stats")
def load_stats(spark, sf):
    et, eb = events_pair(spark, sf)
    pt, ps = scd1_pair(spark, sf)
    ct, cs = scd2_pair(spark, sf)
    qt, qs = scd2_part_pair(spark, sf)
    parts = [
        _stat_row(L.incremental_stats(et, eb, EV_KEYS), "INCREMENTAL", "events_incremental"),
        _stat_row(L.incremental_stats(None, _in(spark, sf, I.events_sql), EV_KEYS), "INCREMENTAL", "events_first"),
        _stat_row(L.scd1_stats(pt, ps, I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF), "SCD1", "part_current"),
        _stat_row(L.scd1_stats(None, _in(spark, sf, I.scd1_first_source_sql), I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF), "SCD1", "part_first"),
        _stat_row(L.scd2_stats(ct, cs, **SCD2_ARGS), "SCD2", "customer_history"),
        _stat_row(L.scd2_stats(None, _in(spark, sf, I.scd2_first_source_sql), **SCD2_ARGS), "SCD2", "customer_first"),
        _stat_row(L.scd2_stats(qt, qs, **SCD2P_ARGS), "SCD2", "part_history"),
        _stat_row(L.full_refresh_stats(_in(spark, sf, I.part_source_sql)), "FULL_REFRESH", "part_snapshot"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- sources

from tidemark.sources import shapes as X  # noqa: E402
from tidemark.sources.tables import load_source  # noqa: E402


def _t(spark, sf, name):
    return I.table(spark, sf, name)


@query("src_table")
def src_table(spark, sf):
    I.register_tables(spark, sf, ["customer"])
    return load_source(spark, {"table": "customer"})


@query("src_sql")
def src_sql(spark, sf):
    I.register_tables(spark, sf, ["orders"])
    # SQL wins when both keys are given.
    return load_source(
        spark,
        {
            "table": "orders",
            "sql": "SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) "
            "AS DECIMAL(38,2)) AS total_price FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority",
        },
    )


@query("src_values")
def src_values(spark, sf):
    return X.segment_tiers(_t(spark, sf, "customer"))


@query("src_customer_orders")
def src_customer_orders(spark, sf):
    return X.customer_orders(_t(spark, sf, "customer"), _t(spark, sf, "orders"))


@query("src_active_tier")
def src_active_tier(spark, sf):
    return X.active_tier(_in(spark, sf, I.customer_flagged_sql), _t(spark, sf, "orders"), I.ORDERS_END, 30)


@query("src_customer_360")
def src_customer_360(spark, sf):
    return X.customer_360(
        _in(spark, sf, I.customer_flagged_sql),
        _t(spark, sf, "orders"),
        _t(spark, sf, "lineitem"),
        _t(spark, sf, "part"),
        I.ORDERS_END,
    )


@query("src_enriched_events")
def src_enriched_events(spark, sf):
    return X.enriched_events(_t(spark, sf, "events"), _t(spark, sf, "customer"), I.EVENTS_LAST_DAY)


# ---------------------------------------------------------------- schema, records, reports

from tidemark.operators import reports as RP  # noqa: E402
from tidemark.operators import schema_drift as SD  # noqa: E402
from tidemark.sinks import records as RC  # noqa: E402


@query("audit_rows")
def audit_rows(spark, sf):
    et, eb = events_pair(spark, sf)
    pt, ps = scd1_pair(spark, sf)
    ct, cs = scd2_pair(spark, sf)
    qt, qs = scd2_part_pair(spark, sf)
    loads = [
        ("events_incremental", "INCREMENTAL", L.incremental_stats(et, eb, EV_KEYS)),
        ("part_current", "SCD1", L.scd1_stats(pt, ps, I.SCD1_KEYS, I.SCD1_COLUMNS, as_of=I.AS_OF)),
        ("customer_history", "SCD2", L.scd2_stats(ct, cs, **SCD2_ARGS)),
        ("part_history", "SCD2", L.scd2_stats(qt, qs, **SCD2P_ARGS)),
        ("part_snapshot", "FULL_REFRESH", L.full_refresh_stats(_in(spark, sf, I.part_source_sql))),
    ]
    out = None
    for table, op, st in loads:
        a = RC.audit_row(
            st, I.JOB_NAME, I.BATCH_ID, table, op, I.AUDIT_START, I.AUDIT_END, "SUCCESS", None, I.AUDIT_USER
        )
        out = a if out is None else out.unionByName(a)
    return out


def _pair_frames(spark, sf, pair, clean=None):
    s_sql, t_sql = I.pair_sql(I.SPARK, pair, clean)
    return _in(spark, sf, s_sql), _in(spark, sf, t_sql)


def _clean_line_items(spark, sf, db):
    """The clean line items as a table of ``db``, grouped once for all that read them."""
    TB.create_table(spark, _in(spark, sf, I.lineitem_clean_sql), f"{db}.lineitem_clean")
    return f"{db}.lineitem_clean"


def _history_result(spark, sf, run, clean=None):
    rid, name, pair, ts, limits = run
    s, t = _pair_frames(spark, sf, pair, clean)
    keys = I.PAIR_KEYS[pair]
    sn, tn = I.PAIR_NAMES[pair]
    summ = C.with_thresholds(C.reconcile(s, t, keys, source_name=sn, target_name=tn), limits)
    sch = SD.compare_schemas(s, t)
    return RC.result_row(summ, rid, name, I.BATCH_ID, ts, sch["status"], sch["summary"], None)


def _history_details(spark, sf, run):
    rid, name, pair, ts, _ = run
    s, t = _pair_frames(spark, sf, pair)
    return RC.details_rows(C.issue_rows(s, t, I.PAIR_KEYS[pair]), rid, name, I.BATCH_ID, ts)


def result_history(spark, sf):
    out, clean = None, _clean_line_items(spark, sf, _job_database(spark))
    for run in I.HISTORY_RUNS:
        r = _history_result(spark, sf, run, clean)
        out = r if out is None else out.unionByName(r)
    return out


def details_history(spark, sf):
    out = None
    for run in I.HISTORY_RUNS:
        d = _history_details(spark, sf, run)
        out = d if out is None else out.unionByName(d)
    return out


@query("recon_result_row")
def recon_result_row(spark, sf):
    return _history_result(spark, sf, I.HISTORY_RUNS[0])


@query("recon_detail_records")
def recon_detail_records(spark, sf):
    return _history_details(spark, sf, I.HISTORY_RUNS[1])


@query("report_latest")
def report_latest(spark, sf):
    return RP.latest_results(result_history(spark, sf), 5)


@query("report_details")
def report_details(spark, sf):
    return RP.details_for(details_history(spark, sf), "customer_recon", "MISMATCH")


@query("report_match_rate_trend")
def report_match_rate_trend(spark, sf):
    return RP.match_rate_trend(result_history(spark, sf))


@query("report_issue_counts")
def report_issue_counts(spark, sf):
    return RP.issue_counts(details_history(spark, sf), I.REPORT_DAY)


# ---------------------------------------------------------------- jobs (end to end: tables written, swapped, audited)

import uuid as _uuid  # noqa: E402

from tidemark.plans import jobs as JB  # noqa: E402
from tidemark.sinks import tables as TB  # noqa: E402


def _job_database(spark) -> str:
    db = f"tidemark_job_{_uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    return db


LOAD_JOB_TABLES = ["events_incremental", "part_current", "customer_history", "part_history", "part_snapshot"]


def load_job_config(db: str) -> dict:
    S = I.SPARK
    return {
        "job": {"name": I.JOB_NAME, "batch_id": I.BATCH_ID},
        "tables": [
            {"name": "events_incremental", "source": {"sql": I.events_batch_sql(S)},
             "target": {"table_name": f"{db}.events_incremental"}, "load_type": "incremental",
             "scd": {"keys": EV_KEYS}},
            {"name": "part_current", "source": {"sql": I.scd1_source_sql(S)},
             "target": {"table_name": f"{db}.part_current"}, "load_type": "scd1",
             "scd": {"keys": I.SCD1_KEYS, "columns": I.SCD1_COLUMNS}},
            {"name": "customer_history", "source": {"sql": I.scd2_source_sql(S)},
             "target": {"table_name": f"{db}.customer_history"}, "load_type": "scd2",
             "scd": {"keys": I.SCD2_KEYS, "columns": I.SCD2_COLUMNS},
             "delete_handling": {"enabled": True, "column": I.SCD2_DELETE[0], "value": I.SCD2_DELETE[1]}},
            {"name": "part_history", "source": {"sql": I.scd2_part_source_sql(S)},
             "target": {"table_name": f"{db}.part_history"},
             "scd": {"keys": I.SCD2P_KEYS, "columns": I.SCD2P_COLUMNS}, "delete_handling": {"enabled": False}},
            {"name": "part_snapshot", "source": {"sql": I.part_source_sql(S)},
             "target": {"table_name": f"{db}.part_snapshot"}, "load_type": "full_refresh"},
            {"name": "broken_spec", "source": {}, "target": {"table_name": f"{db}.never_written"},
             "load_type": "scd1"},
        ],
    }


def run_load_job(spark, sf, parallel=None):
    """Stage the previous target states as tables, then run the job."""
    I.register_tables(spark, sf, ["events", "part", "customer"])
    db = _job_database(spark)
    for name, fn in (
        ("events_incremental", I.events_target_sql),
        ("part_current", I.scd1_target_sql),
        ("customer_history", I.scd2_target_sql),
        ("part_history", I.scd2_part_target_sql),
    ):
        TB.create_table(spark, spark.sql(fn(I.SPARK)), f"{db}.{name}")
    config = load_job_config(db)
    config["job"]["parallel_execution"] = parallel
    JB.run_loads(spark, config, as_of=I.AS_OF, audit_table=f"{db}.audit", user=I.AUDIT_USER).collect()
    return db


@query("load_job")
def load_job(spark, sf, parallel=None):
    from pyspark.sql import functions as F

    db = run_load_job(spark, sf, parallel)
    a = spark.read.table(f"{db}.audit")
    return a.select(
        F.substring_index("table_name", ".", -1).alias("table_name"),
        "operation_type",
        "status",
        F.col("source_record_count").alias("source_count"),
        F.col("records_inserted").alias("inserted"),
        F.col("records_updated").alias("updated"),
        F.col("records_deleted").alias("deleted"),
        F.col("total_active_records").alias("active_count"),
        F.col("total_historical_records").alias("historical_count"),
    )


@query("load_job_scd2_state")
def load_job_scd2_state(spark, sf):
    db = run_load_job(spark, sf)
    return spark.read.table(f"{db}.customer_history")


#: One run of every pair.
RECON_JOB_RUNS = I.HISTORY_RUNS[:5]


def recon_job_config(db: str) -> dict:
    recs = []
    for rid, name, pair, _, limits in RECON_JOB_RUNS:
        sn, tn = I.PAIR_NAMES[pair]
        recs.append({
            "name": f"{name}_{rid}", "source": {"table": f"tm_{rid}_{sn}"}, "target": {"table": f"tm_{rid}_{tn}"},
            "keys": I.PAIR_KEYS[pair], "columns_to_compare": [], "exclude_columns": ["created_at", "updated_at"],
            "validations": {"schema_check": True, "data_comparison": True}, "thresholds": limits,
        })
    return {
        "job": {"name": "data_reconciliation_job", "batch_id": I.BATCH_ID,
                "results_table": f"{db}.recon_results", "details_table": f"{db}.recon_details"},
        "reconciliations": recs,
        "settings": {"enable_detailed_logging": True},
    }


def run_recon_job(spark, sf):
    db = _job_database(spark)
    clean = _clean_line_items(spark, sf, db)
    for rid, _, pair, _, _ in RECON_JOB_RUNS:
        s, t = _pair_frames(spark, sf, pair, clean)
        sn, tn = I.PAIR_NAMES[pair]
        s.createOrReplaceTempView(f"tm_{rid}_{sn}")
        t.createOrReplaceTempView(f"tm_{rid}_{tn}")
    JB.run_reconciliations(spark, recon_job_config(db)).collect()
    return db


@query("recon_job_details")
def recon_job_details(spark, sf):
    """The details table that the job leaves: every issue, as written."""
    db = run_recon_job(spark, sf)
    return spark.read.table(f"{db}.recon_details").select("recon_name", "issue_type", "record_keys", "source_values", "target_values", "details")


@query("recon_job")
def recon_job(spark, sf):
    from pyspark.sql import functions as F

    db = run_recon_job(spark, sf)
    r = spark.read.table(f"{db}.recon_results")
    return r.select(
        "recon_name", "status", "source_count", "target_count", "matched_count", "match_rate", "missing_count",
        "extra_count", "mismatch_count", "source_duplicates", "target_duplicates", "schema_status",
        "data_status", "threshold_breached",
        F.regexp_replace("summary", "^Schema: [^;]*; Data: ", "").alias("data_summary"),
    )


SEGMENT_COLUMNS = {"c_custkey": "BIGINT", "c_mktsegment": "STRING", "c_acctbal": "DECIMAL(18,2)", "loaded_on": "DATE"}


@query("table_lifecycle")
def table_lifecycle(spark, sf):
    """Tables made, filled, replaced and dropped: typed DDL, INSERT SELECT of
    all customers and INSERT VALUES, a replacement with other columns that
    reads the table itself, and a drop that takes only its own table."""
    name = f"{_job_database(spark)}.segments"
    for x in (name, f"{name}_scratch"):
        TB.drop_table(spark, x)
        TB.create_typed(spark, x, SEGMENT_COLUMNS)
    customers = _t(spark, sf, "customer").selectExpr(
        "c_custkey", "c_mktsegment", "CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal", "DATE '2026-02-22' AS loaded_on"
    )
    TB.append_rows(customers, name)
    TB.insert_values(spark, name, [(-1, "IT'S NEW", "12.50", "2026-02-23"), (-2, None, None, None)])
    TB.append_rows(spark.read.table(name), f"{name}_scratch")
    doubled = spark.read.table(name).unionByName(spark.read.table(name))
    by_segment = doubled.groupBy("c_mktsegment", "loaded_on").agg({"c_acctbal": "sum", "c_custkey": "count"})
    TB.replace_table_as(
        spark,
        by_segment.selectExpr("c_mktsegment", "CAST(loaded_on AS STRING) AS loaded_on",
                              "CAST(`sum(c_acctbal)` AS DOUBLE) AS balance", "`count(c_custkey)` AS n_rows"),
        name,
    )
    TB.drop_table(spark, f"{name}_scratch")
    return spark.read.table(name)


# ---------------------------------------------------------------- clashing names, nested columns, digests, other ways to run

from tidemark.operators import digest as DG  # noqa: E402
from tidemark.sinks import buckets as BK  # noqa: E402


@query("incremental_clash")
def incremental_clash(spark, sf):
    """A keyed append whose columns are called like helper columns."""
    t, b = (_in(spark, sf, I.renamed_sql(f(I.SPARK), I.CLASH_EVENTS)) for f in (I.events_target_sql, I.events_batch_sql))
    return L.incremental(t, b, ["_spread"])


@query("scd1_clash")
def scd1_clash(spark, sf):
    t = _in(spark, sf, I.renamed_sql(I.scd1_target_sql(I.SPARK), I.CLASH_PART, ", created_at, updated_at"))
    s = _in(spark, sf, I.renamed_sql(I.scd1_source_sql(I.SPARK), I.CLASH_PART))
    return L.scd1(t, s, ["_spread"], list(I.CLASH_PART.values())[1:], as_of=I.AS_OF)


@query("scd2_clash")
def scd2_clash(spark, sf):
    t = _in(spark, sf, I.renamed_sql(I.scd2_target_sql(I.SPARK), I.CLASH_CUSTOMER, I.META_REST))
    s = _in(spark, sf, I.renamed_sql(I.scd2_source_sql(I.SPARK), I.CLASH_CUSTOMER))
    return L.scd2(t, s, **{**SCD2_ARGS, "keys": ["_key_rows"], "columns": ["_flag", "_rows", "_h"], "delete_column": "_sp"})


@query("recon_clash")
def recon_clash(spark, sf):
    s, t = (df.withColumnsRenamed(I.CLASH_LINE_KEYS) for df in lineitem_raw_pair(spark, sf))
    keys = list(I.CLASH_LINE_KEYS.values())
    return C.mismatch_versions(s, t, keys, C.compare_columns(s.columns, t.columns, keys))


@query("recon_mismatch_nested")
def recon_mismatch_nested(spark, sf):
    """Maps, in an array in a struct, whose entries were put in in another order."""
    s, t = customer_pair(spark, sf)
    nested = lambda df, entries: df.selectExpr("c_custkey", f"named_struct('all', array(map({entries}))) AS nested")
    entries = ["'segment', c_mktsegment", "'nation', CAST(c_nationkey AS STRING)"]
    s, t = nested(s, ", ".join(entries)), nested(t, ", ".join(reversed(entries)))
    return C.mismatches(s, t, CUST_KEYS, ["nested"]).select("c_custkey", "mismatched_pairs", "source_versions", "target_versions")


def _digest_pairs(spark, sf):
    raw, changed = lineitem_raw_pair(spark, sf)
    return [
        (*customer_pair(spark, sf), CUST_KEYS, "customer_source", "customer_target"),
        (*customer_nullkey_pair(spark, sf), CUST_KEYS, "customer_source", "customer_target_nk"),
        (raw, changed, LI_KEYS, "lineitem_raw", "lineitem_raw_target"),
        (raw, raw, LI_KEYS, "lineitem_raw", "lineitem_raw"),
    ]


@query("recon_summary_digest")
def recon_summary_digest(spark, sf):
    """Summaries by digest drill-down, of pairs that differ little, much and not at all."""
    out = None
    for s, t, keys, sn, tn in _digest_pairs(spark, sf):
        one = DG.reconcile_digest(s, t, keys, source_name=sn, target_name=tn)
        out = one if out is None else out.unionByName(one)
    return out


@query("recon_issues_digest")
def recon_issues_digest(spark, sf):
    out = None
    for s, t, keys, _, _ in _digest_pairs(spark, sf):
        one = DG.issue_rows_digest(s, t, keys)
        out = one if out is None else out.unionByName(one)
    return out


@query("load_job_parallel")
def load_job_parallel(spark, sf):
    """The load job with four specs at a time, one of which fails."""
    return load_job(spark, sf, parallel=4)


@query("load_job_rerun")
def load_job_rerun(spark, sf):
    """An append without keys, whose batch is run three times."""
    db = _job_database(spark)
    I.register_tables(spark, sf, ["events"])
    TB.create_table(spark, spark.sql(I.events_target_sql(I.SPARK)), f"{db}.events_all")
    spec = {"name": "all", "source": {"sql": I.events_batch_sql(I.SPARK)}, "target": {"table_name": f"{db}.events_all"}, "load_type": "incremental"}
    config = {"job": {"name": "appends", "batch_id": I.BATCH_ID, "rerun_safe": True}, "tables": [spec]}
    for _ in range(3):
        JB.run_loads(spark, config, as_of=I.AS_OF, audit_table=f"{db}.audit").collect()
    return spark.read.table(f"{db}.events_all")


@query("load_job_buckets")
def load_job_buckets(spark, sf):
    """The customer history kept in key buckets, of which the load rewrites those of its batch."""
    db = _job_database(spark)
    I.register_tables(spark, sf, ["customer"])
    BK.create_state(spark, spark.sql(I.scd2_target_sql(I.SPARK)), f"{db}.customer_history", I.SCD2_KEYS, 16)
    spec = load_job_config(db)["tables"][2]
    spec["target"]["key_buckets"] = 16
    JB.run_loads(spark, {"job": {"name": "buckets", "batch_id": I.BATCH_ID}, "tables": [spec]}, as_of=I.AS_OF, audit_table=f"{db}.audit").collect()
    return spark.read.table(f"{db}.customer_history")


#: Source queries that depend on a clock, with markers for it.
ACTIVE_TIER_AT = f"""
SELECT c.c_custkey, upper(c.c_name) AS c_name_upper, c.c_nationkey,
       CASE WHEN o.n > 10 THEN 'VIP' WHEN o.n > 5 THEN 'Regular' ELSE 'New' END AS customer_tier
FROM ({I.customer_flagged_sql(I.SPARK)}) c
JOIN (SELECT o_custkey, count(1) AS n, max(o_orderdate) AS latest FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
WHERE c.is_deleted = 'N' AND o.latest >= CAST(:as_of AS DATE) - INTERVAL 30 DAYS"""
ENRICHED_EVENTS_AT = """
SELECT e.event_id, e.event_type, e.ts AS event_date, e.user_id AS customer_id, c.c_name, c.c_mktsegment,
       CAST(e.value AS DECIMAL(18,2)) AS event_value
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey WHERE e.ts >= to_timestamp_ntz(:as_of)"""


def _source_at(spark, sf, tables, sql, as_of):
    from tidemark.sources.tables import load_source

    I.register_tables(spark, sf, tables)
    return load_source(spark, {"sql": sql}, {"as_of": as_of, "batch_id": I.BATCH_ID})


@query("src_active_tier_at")
def src_active_tier_at(spark, sf):
    return _source_at(spark, sf, ["customer", "orders"], ACTIVE_TIER_AT, I.ORDERS_END)


@query("src_enriched_events_at")
def src_enriched_events_at(spark, sf):
    return _source_at(spark, sf, ["customer", "events"], ENRICHED_EVENTS_AT, I.EVENTS_LAST_DAY)
