"""DuckDB SQL for every registered query, under the same names."""

from __future__ import annotations

from tidemark.plans import inputs as I
from tidemark.plans import oracle_recon as R

D = I.DUCK
ORACLE: dict[str, str] = {}

CUST_KEYS = ["c_custkey"]
LI_KEYS = ["l_orderkey", "l_linenumber"]
CUST_COLS = ["c_acctbal", "c_mktsegment", "c_name", "c_nationkey"]
LI_COLS = sorted(["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"])

cs, ct = I.recon_source_sql(D), I.recon_target_sql(D)
ns, nt = I.recon_source_nullkey_sql(D), I.recon_target_nullkey_sql(D)
_lb = I.lineitem_clean_sql(D)
ls, lt = _lb, I.lineitem_perturbed_sql(_lb)
_lr = I.lineitem_raw_sql(D)
rs, rt = _lr, I.lineitem_perturbed_sql(_lr)

ORACLE["recon_counts"] = R.counts_sql(cs, ct)
ORACLE["recon_dup_source"] = R.duplicates_sql(ns, CUST_KEYS)
ORACLE["recon_dup_target"] = R.duplicates_sql(ct, CUST_KEYS)
ORACLE["recon_dup_composite"] = R.duplicates_sql(rs, LI_KEYS)
ORACLE["recon_missing"] = R.except_sql(ns, nt, CUST_KEYS)
ORACLE["recon_extra"] = R.except_sql(nt, ns, CUST_KEYS)
ORACLE["recon_mismatch_all"] = R.mismatches_sql(cs, ct, CUST_KEYS, CUST_COLS)
ORACLE["recon_mismatch_subset"] = R.mismatches_sql(cs, ct, CUST_KEYS, ["c_mktsegment"])
ORACLE["recon_mismatch_excluded"] = R.mismatches_sql(cs, ct, CUST_KEYS, ["c_acctbal", "c_name", "c_nationkey"])
ORACLE["recon_mismatch_composite"] = R.mismatches_sql(ls, lt, LI_KEYS, LI_COLS)
ORACLE["recon_mismatch_fanout"] = R.mismatches_sql(rs, rt, LI_KEYS, LI_COLS)
ORACLE["recon_summary"] = R.reconcile_sql(cs, ct, CUST_KEYS, CUST_COLS, "customer_source", "customer_target")
ORACLE["recon_summary_null_keys"] = R.reconcile_sql(ns, nt, CUST_KEYS, CUST_COLS, "customer_source", "customer_target_nk")
ORACLE["recon_summary_composite"] = R.reconcile_sql(ls, lt, LI_KEYS, LI_COLS, "lineitem_source", "lineitem_target")
ORACLE["recon_summary_fanout"] = R.reconcile_sql(rs, rt, LI_KEYS, LI_COLS, "lineitem_raw", "lineitem_raw_target")
ORACLE["recon_summary_identical"] = R.reconcile_sql(cs, cs, CUST_KEYS, CUST_COLS, "customer_source", "customer_source")
_hs, _ht = I.recon_shift_source_sql(D), I.recon_shift_target_sql(D)
ORACLE["recon_summary_shift_plain"] = R.reconcile_sql(_hs, _ht, CUST_KEYS, CUST_COLS, "customer_shift_source", "customer_shift_target")
ORACLE["recon_summary_exact"] = R.reconcile_sql(
    _hs, _ht, CUST_KEYS, CUST_COLS, "customer_shift_source", "customer_shift_target", exact=True
)
ORACLE["recon_mismatch_exact"] = R.mismatches_sql(_hs, _ht, CUST_KEYS, CUST_COLS, exact=True)
ORACLE["recon_mismatch_exact_timestamps"] = R.mismatches_sql(
    I.events_times_sql(D), I.events_shifted_times_sql(D), ["event_id"], I.EV_TIME_COLS, exact=True
)
ORACLE["recon_mismatch_versions"] = R.mismatch_versions_sql(cs, ct, CUST_KEYS, CUST_COLS)
ORACLE["recon_mismatch_versions_lineitem"] = R.mismatch_versions_sql(rs, rt, LI_KEYS, LI_COLS)
ORACLE["recon_issues"] = "\nUNION ALL\n".join(
    f"SELECT * FROM ({R.issue_rows_sql(a, b, CUST_KEYS, CUST_COLS)})" for a, b in ((cs, ct), (ns, nt))
)
ORACLE["recon_issues_lineitem"] = R.issue_rows_sql(rs, rt, LI_KEYS, LI_COLS)
ORACLE["recon_thresholds"] = "\nUNION ALL\n".join(
    [
        R.thresholds_select(
            R.reconcile_sql(cs, ct, CUST_KEYS, CUST_COLS, "customer_source", "customer_target"),
            {"max_mismatch_percent": 5.0, "max_missing_percent": 2.0},
        ),
        R.thresholds_select(
            R.reconcile_sql(ls, lt, LI_KEYS, LI_COLS, "lineitem_source", "lineitem_target"),
            {"max_mismatch_percent": 10.0, "max_missing_percent": 5.0},
        ),
        R.thresholds_select(
            R.reconcile_sql(cs, cs, CUST_KEYS, CUST_COLS, "customer_source", "customer_source"),
            {"max_mismatch_percent": 5.0, "max_missing_percent": 2.0},
        ),
    ]
)
ORACLE["recon_details"] = R.issue_rows_sql(ns, nt, CUST_KEYS, CUST_COLS, 10)
ORACLE["recon_null_profile"] = R.null_profile_sql(ns, nt, sorted(["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))

# ---------------------------------------------------------------- loads
from tidemark.plans import oracle_loads as OL  # noqa: E402

EV_KEYS = ["event_id"]
et, eb = I.events_target_sql(D), I.events_batch_sql(D)
pt, ps = I.scd1_target_sql(D), I.scd1_source_sql(D)
ct, csrc = I.scd2_target_sql(D), I.scd2_source_sql(D)
qt, qs = I.scd2_part_target_sql(D), I.scd2_part_source_sql(D)
SCD1_TCOLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice", "created_at", "updated_at"]
SCD2_TCOLS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "is_deleted", *OL.META]
SCD2P_TCOLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_retailprice", *OL.META]
DEL = I.SCD2_DELETE

ORACLE["incremental_first"] = "SELECT * FROM events"
ORACLE["incremental_keyed"] = OL.incremental_state_sql(et, eb, EV_KEYS)
ORACLE["incremental_new_rows"] = OL.incremental_new_sql(et, eb, EV_KEYS)
ORACLE["incremental_append"] = "SELECT * FROM events UNION ALL SELECT * FROM events"
ORACLE["incremental_hard_batch"] = OL.incremental_state_sql(et, I.events_dup_batch_sql(D), EV_KEYS)
ps1, csrc1 = I.scd1_first_source_sql(D), I.scd2_first_source_sql(D)
ORACLE["scd1_first"] = OL.scd1_first_sql(ps1)
ORACLE["scd1_null_keys"] = OL.scd1_state_sql(
    I.scd1_nullkey_target_sql(D), I.scd1_nullkey_source_sql(D), I.SCD1_KEYS, I.SCD1_COLUMNS, SCD1_TCOLS
)
ORACLE["scd1_composite"] = OL.scd1_state_sql(
    I.scd1_line_target_sql(D), I.scd2_line_source_sql(D), I.LI_SCD_KEYS, I.LI_SCD_COLUMNS,
    [*I.LI_SCD_KEYS, *I.LI_SCD_COLUMNS, "created_at", "updated_at"],
)
ORACLE["scd1_upsert"] = OL.scd1_state_sql(pt, ps, I.SCD1_KEYS, I.SCD1_COLUMNS, SCD1_TCOLS)
ORACLE["scd1_change_set"] = OL.scd1_state_sql(pt, ps, I.SCD1_KEYS, I.SCD1_COLUMNS, SCD1_TCOLS, change_set=True)
ORACLE["scd1_actions"] = OL.scd1_actions_sql(pt, ps, I.SCD1_KEYS, I.SCD1_COLUMNS, SCD1_TCOLS)
ORACLE["scd2_first"] = OL.scd2_first_sql(csrc1, I.SCD2_KEYS, I.SCD2_COLUMNS, DEL)
ORACLE["scd2_full"] = OL.scd2_state_sql(ct, csrc, I.SCD2_KEYS, I.SCD2_COLUMNS, SCD2_TCOLS, DEL)
ORACLE["scd2_delete_case"] = ORACLE["scd2_full"]
ORACLE["scd2_null_keys"] = OL.scd2_state_sql(
    I.scd2_nullkey_target_sql(D), I.scd2_nullkey_source_sql(D), I.SCD2_KEYS, I.SCD2_COLUMNS, SCD2_TCOLS, DEL
)
ORACLE["scd2_composite"] = OL.scd2_state_sql(
    I.scd2_line_target_sql(D), I.scd2_line_source_sql(D), I.LI_SCD_KEYS, I.LI_SCD_COLUMNS,
    [*I.LI_SCD_KEYS, *I.LI_SCD_COLUMNS, *OL.META],
)
for _name, _wanted in (("scd2_change", "changed"), ("scd2_delete", "deleted"), ("scd2_insert", "new"), ("scd2_reactivate", "reactivated")):
    ORACLE[_name] = OL.scd2_rows_for_sql(ct, csrc, I.SCD2_KEYS, I.SCD2_COLUMNS, SCD2_TCOLS, DEL, _wanted)
_cs_rows = OL.scd2_rows_sql(I.SCD2_KEYS, I.SCD2_COLUMNS, SCD2_TCOLS, DEL, with_action=True)
ORACLE["scd2_change_set"] = (
    f"WITH {OL.scd2_cte(ct, csrc, I.SCD2_KEYS, I.SCD2_COLUMNS, SCD2_TCOLS, DEL)}, r AS ({_cs_rows}) "
    "SELECT * FROM r WHERE action IN ('changed', 'deleted', 'new')"
)
ORACLE["scd2_counts"] = OL.scd2_counts_sql(ct, csrc, I.SCD2_KEYS, I.SCD2_COLUMNS, SCD2_TCOLS, DEL)
ORACLE["scd2_no_delete"] = OL.scd2_state_sql(qt, qs, I.SCD2P_KEYS, I.SCD2P_COLUMNS, SCD2P_TCOLS, None)
ORACLE["full_refresh"] = I.part_source_sql(D)
_n = lambda sql: f"(SELECT count(*) FROM ({sql}) x)"
ORACLE["load_stats"] = "\nUNION ALL\n".join(
    [
        OL.simple_stats_select(
            "events_incremental", "INCREMENTAL", _n(eb), _n(OL.incremental_new_sql(et, eb, EV_KEYS)), 0,
            f"{_n(et)} + {_n(OL.incremental_new_sql(et, eb, EV_KEYS))}",
        ),
        OL.simple_stats_select("events_first", "INCREMENTAL", *[_n("SELECT * FROM events")] * 2, 0, _n("SELECT * FROM events")),
        f"SELECT * FROM (WITH {OL.scd1_cte(pt, ps, I.SCD1_KEYS, I.SCD1_COLUMNS, SCD1_TCOLS)} "
        + OL.simple_stats_select(
            "part_current", "SCD1", "(SELECT count(*) FROM s)", "(SELECT count(*) FROM inserted)", "(SELECT count(*) FROM matched)",
            "(SELECT count(*) FROM matched) + (SELECT count(*) FROM inserted) + (SELECT count(*) FROM target_only)",
        ) + ")",
        OL.simple_stats_select("part_first", "SCD1", _n(ps1), _n(ps1), 0, _n(ps1)),
        f"SELECT * FROM (WITH {OL.scd2_cte(ct, csrc, I.SCD2_KEYS, I.SCD2_COLUMNS, SCD2_TCOLS, DEL)} "
        f"{OL.scd2_stats_select('customer_history', 'SCD2')})",
        OL.simple_stats_select(
            "customer_first", "SCD2", _n(csrc1), _n(OL.scd2_first_sql(csrc1, I.SCD2_KEYS, I.SCD2_COLUMNS, DEL)), 0,
            _n(OL.scd2_first_sql(csrc1, I.SCD2_KEYS, I.SCD2_COLUMNS, DEL)),
        ),
        f"SELECT * FROM (WITH {OL.scd2_cte(qt, qs, I.SCD2P_KEYS, I.SCD2P_COLUMNS, SCD2P_TCOLS, None)} "
        f"{OL.scd2_stats_select('part_history', 'SCD2')})",
        OL.simple_stats_select("part_snapshot", "FULL_REFRESH", _n(I.part_source_sql(D)), _n(I.part_source_sql(D)), 0, _n(I.part_source_sql(D))),
    ]
)

# ---------------------------------------------------------------- sources (plain SQL as written in load configs)
_cf = I.customer_flagged_sql(D)
ORACLE["src_table"] = "SELECT * FROM customer"
ORACLE["src_sql"] = (
    "SELECT o_orderpriority, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) "
    "AS total_price FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"
)
ORACLE["src_values"] = (
    "SELECT c.c_custkey, c.c_mktsegment, v.segment_tier FROM customer c LEFT JOIN (VALUES "
    "('AUTOMOBILE', 'B'), ('BUILDING', 'A'), ('FURNITURE', 'C'), ('HOUSEHOLD', 'C'), ('MACHINERY', 'A')) "
    "AS v(segment, segment_tier) ON c.c_mktsegment = v.segment"
)
_x1 = """SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
  CAST(COUNT(o.o_orderkey) AS BIGINT) AS total_orders,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount,
  MAX(o.o_orderdate) AS last_order_date
FROM {c} c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
GROUP BY c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment"""
ORACLE["src_customer_orders"] = _x1.format(c="customer")
ORACLE["src_active_tier"] = f"""SELECT c_custkey, UPPER(c_name) AS c_name_upper, c_nationkey,
  CASE WHEN total_orders > 10 THEN 'VIP' WHEN total_orders > 5 THEN 'Regular' ELSE 'New' END AS customer_tier
FROM ({_x1.format(c=f"(SELECT * FROM ({_cf}) f WHERE is_deleted = 'N')")}) x
WHERE last_order_date >= DATE '{I.ORDERS_END}' - INTERVAL 30 DAYS"""
ORACLE["src_customer_360"] = f"""SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
  CAST(COUNT(DISTINCT o.o_orderkey) AS BIGINT) AS order_count,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS lifetime_value,
  CAST(COUNT(DISTINCT p.p_partkey) AS BIGINT) AS unique_products,
  MAX(o.o_orderdate) AS last_purchase_date,
  CAST(date_diff('day', CAST(MAX(o.o_orderdate) AS DATE), DATE '{I.ORDERS_END}') AS INTEGER) AS days_since_purchase,
  CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE)
    AS avg_order_value
FROM ({_cf}) c
LEFT JOIN orders o ON c.c_custkey = o.o_custkey
LEFT JOIN lineitem li ON o.o_orderkey = li.l_orderkey
LEFT JOIN part p ON li.l_partkey = p.p_partkey
WHERE c.is_deleted = 'N'
GROUP BY c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment"""
ORACLE["src_enriched_events"] = f"""SELECT e.event_id, e.event_type, e.ts AS event_date, e.user_id AS customer_id,
  c.c_name, c.c_mktsegment, CAST(e.value AS DECIMAL(18,2)) AS event_value
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
WHERE e.ts >= TIMESTAMP '{I.EVENTS_LAST_DAY}'"""

# ---------------------------------------------------------------- schema, records, reports
_AUDIT = (
    f"'{I.JOB_NAME}' AS job_name, '{I.BATCH_ID}' AS batch_id, table_name, operation_type, "
    f"{D.ts(I.AUDIT_START)} AS start_time, {D.ts(I.AUDIT_END)} AS end_time, "
    f"CAST(date_diff('microsecond', {D.ts(I.AUDIT_START)}, {D.ts(I.AUDIT_END)}) AS DOUBLE) / 1e6 AS duration_seconds, "
    "source_count AS source_record_count, inserted AS records_inserted, updated AS records_updated, "
    "deleted AS records_deleted, active_count AS total_active_records, historical_count AS total_historical_records, "
    f"'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS error_message, '{I.AUDIT_USER}' AS execution_user, "
    f"{D.ts(I.AUDIT_END)} AS created_timestamp"
)
ORACLE["audit_rows"] = (
    f"SELECT {_AUDIT} FROM ({ORACLE['load_stats']}) st "
    "WHERE table_name IN ('events_incremental', 'part_current', 'customer_history', 'part_history', 'part_snapshot')"
)


def _history_result_sql(run, spark_schema_status=("PASSED", "Schemas are compatible")):
    rid, name, pair, ts, limits = run
    src, tgt = I.pair_sql(D, pair)
    keys = I.PAIR_KEYS[pair]
    sn, tn = I.PAIR_NAMES[pair]
    cols = LI_COLS if pair.startswith("lineitem") else CUST_COLS
    summ = R.thresholds_select(R.reconcile_sql(src, tgt, keys, cols, sn, tn), limits)
    sch_status, sch_summary = spark_schema_status
    return f"""SELECT '{rid}' AS recon_id, '{name}' AS recon_name, '{I.BATCH_ID}' AS batch_id, {D.ts(ts)} AS execution_time,
  CASE WHEN '{sch_status}' = 'FAILED' OR status = 'FAILED' THEN 'FAILED' ELSE 'PASSED' END AS status,
  source_table, target_table, source_count, target_count, matched_count, match_rate, missing_count, extra_count,
  mismatch_count, source_duplicates, target_duplicates, '{sch_status}' AS schema_status, status AS data_status,
  'Schema: {sch_summary}; Data: ' || summary AS summary, CAST(NULL AS DOUBLE) AS duration_seconds, threshold_breached
FROM ({summ}) r"""


def _history_details_sql(run):
    rid, name, pair, ts, _ = run
    src, tgt = I.pair_sql(D, pair)
    keys = I.PAIR_KEYS[pair]
    cols = LI_COLS if pair.startswith("lineitem") else CUST_COLS
    header = f"'{rid}' AS recon_id, '{name}' AS recon_name, '{I.BATCH_ID}' AS batch_id, {D.ts(ts)} AS execution_time, "
    return R.issue_rows_sql(src, tgt, keys, cols, header=header)


_results_hist = "\nUNION ALL\n".join(f"SELECT * FROM ({_history_result_sql(r)})" for r in I.HISTORY_RUNS)
_details_hist = "\nUNION ALL\n".join(
    f"SELECT * FROM ({_history_details_sql(r)})" for r in I.HISTORY_RUNS
)
ORACLE["recon_result_row"] = _history_result_sql(I.HISTORY_RUNS[0])
ORACLE["recon_detail_records"] = _history_details_sql(I.HISTORY_RUNS[1])
ORACLE["report_latest"] = (
    "SELECT recon_id, recon_name, status, source_count, target_count, matched_count, match_rate, missing_count, "
    f"extra_count, mismatch_count, summary FROM ({_results_hist}) h ORDER BY execution_time DESC, recon_id DESC LIMIT 5"
)
ORACLE["report_details"] = (
    f"SELECT * FROM ({_details_hist}) d WHERE recon_name = 'customer_recon' AND issue_type = 'MISMATCH' "
    "ORDER BY execution_time DESC"
)
ORACLE["report_match_rate_trend"] = (
    "SELECT recon_name, CAST(execution_time AS DATE) AS run_date, "
    "CAST(SUM(CAST(match_rate AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(match_rate) AS DOUBLE) AS avg_match_rate, "
    f"CAST(COUNT(*) AS BIGINT) AS run_count FROM ({_results_hist}) h GROUP BY recon_name, CAST(execution_time AS DATE)"
)
ORACLE["report_issue_counts"] = (
    f"SELECT recon_name, issue_type, CAST(COUNT(*) AS BIGINT) AS issue_count FROM ({_details_hist}) d "
    f"WHERE CAST(execution_time AS DATE) = DATE '{I.REPORT_DAY}' GROUP BY recon_name, issue_type"
)

# ---------------------------------------------------------------- jobs
ORACLE["load_job"] = (
    "SELECT table_name, operation_type, 'SUCCESS' AS status, source_count, inserted, updated, deleted, "
    f"active_count, historical_count FROM ({ORACLE['load_stats']}) st "
    "WHERE table_name IN ('events_incremental', 'part_current', 'customer_history', 'part_history', 'part_snapshot') "
    "UNION ALL SELECT 'never_written', 'SCD1', 'FAILED', 0, 0, 0, 0, 0, 0"
)
ORACLE["load_job_scd2_state"] = ORACLE["scd2_full"]


def _recon_job_row(run):
    rid, name, pair, _, limits = run
    src, tgt = I.pair_sql(D, pair)
    keys = I.PAIR_KEYS[pair]
    cols = LI_COLS if pair.startswith("lineitem") else CUST_COLS
    sn, tn = I.PAIR_NAMES[pair]
    summ = R.thresholds_select(R.reconcile_sql(src, tgt, keys, cols, f"tm_{rid}_{sn}", f"tm_{rid}_{tn}"), limits)
    return f"""SELECT '{name}_{rid}' AS recon_name,
  CASE WHEN status = 'FAILED' THEN 'FAILED' ELSE 'PASSED' END AS status,
  source_count, target_count, matched_count, match_rate, missing_count, extra_count, mismatch_count,
  source_duplicates, target_duplicates, 'PASSED' AS schema_status, status AS data_status, threshold_breached,
  summary AS data_summary FROM ({summ}) r"""


ORACLE["recon_job"] = "\nUNION ALL\n".join(
    f"SELECT * FROM ({_recon_job_row(r)})" for r in I.HISTORY_RUNS[:5]
)


def _recon_job_detail(run):
    rid, name, pair, _, _ = run
    cols = LI_COLS if pair.startswith("lineitem") else CUST_COLS
    return R.issue_rows_sql(*I.pair_sql(D, pair), I.PAIR_KEYS[pair], cols, header=f"'{name}_{rid}' AS recon_name, ")


ORACLE["recon_job_details"] = "\nUNION ALL\n".join(f"SELECT * FROM ({_recon_job_detail(r)})" for r in I.HISTORY_RUNS[:5])

ORACLE["table_lifecycle"] = """WITH t AS (
  SELECT c_mktsegment, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, '2026-02-22' AS loaded_on FROM customer
  UNION ALL SELECT 'IT''S NEW', 12.50, '2026-02-23' UNION ALL SELECT NULL, NULL, NULL)
SELECT c_mktsegment, loaded_on, CAST(2 * sum(c_acctbal) AS DOUBLE) AS balance, CAST(2 * count(*) AS BIGINT) AS n_rows
FROM t GROUP BY c_mktsegment, loaded_on"""

# ---------------------------------------------------------------- clashing names, nested columns, digests, other ways to run
def _renamed(sql: str, names: dict[str, str]) -> str:
    return f"SELECT {', '.join(f'{a} AS {b}' for a, b in names.items())} FROM ({sql}) r"


ORACLE["incremental_clash"] = _renamed(ORACLE["incremental_keyed"], I.CLASH_EVENTS)
ORACLE["scd1_clash"] = _renamed(ORACLE["scd1_upsert"], I.CLASH_PART | {c: c for c in ("created_at", "updated_at")})
ORACLE["scd2_clash"] = _renamed(ORACLE["scd2_full"], I.CLASH_CUSTOMER | {c: c for c in OL.META})
ORACLE["recon_clash"] = _renamed(
    ORACLE["recon_mismatch_versions_lineitem"],
    {**I.CLASH_LINE_KEYS, "fingerprint": "fingerprint", "source_rows": "_source_rows", "target_rows": "target_rows"},
)
ORACLE["recon_mismatch_nested"] = (
    "SELECT c_custkey, mismatched_pairs, source_versions, target_versions FROM "
    f"({R.mismatches_sql(I.recon_source_sql(D), I.recon_target_sql(D), CUST_KEYS, ['c_mktsegment', 'c_nationkey'])}) m"
)
_digest_pairs = [
    (I.recon_source_sql(D), I.recon_target_sql(D), CUST_KEYS, CUST_COLS, "customer_source", "customer_target"),
    (ns, nt, CUST_KEYS, CUST_COLS, "customer_source", "customer_target_nk"),
    (rs, rt, LI_KEYS, LI_COLS, "lineitem_raw", "lineitem_raw_target"),
    (rs, rs, LI_KEYS, LI_COLS, "lineitem_raw", "lineitem_raw"),
]
ORACLE["recon_summary_digest"] = "\nUNION ALL\n".join(f"SELECT * FROM ({R.reconcile_sql(*x)})" for x in _digest_pairs)
ORACLE["recon_issues_digest"] = "\nUNION ALL\n".join(f"SELECT * FROM ({R.issue_rows_sql(*x[:4])})" for x in _digest_pairs)
ORACLE["load_job_parallel"] = ORACLE["load_job"]
ORACLE["load_job_buckets"] = ORACLE["scd2_full"]
ORACLE["load_job_rerun"] = f"SELECT * FROM ({et}) a UNION ALL SELECT * FROM ({eb}) b"
ORACLE["src_active_tier_at"] = ORACLE["src_active_tier"]
ORACLE["src_enriched_events_at"] = ORACLE["src_enriched_events"]

# ---------------------------------------------------------------- output portability
# Decimal output columns per query.  Both sides present them as DOUBLE at the
# registered-query boundary (``__spark_entry__``): the two engines convert a
# decimal to the same correctly rounded double, while their pandas / Python
# renderings of decimals differ (Decimal('1.80') vs 1.8).  Kept in sync with
# the Spark schemas by tests/test_oracle.py.
DECIMAL_OUTPUTS = {
    "scd1_first": ["p_retailprice"],
    "scd1_upsert": ["p_retailprice"],
    "scd1_change_set": ["p_retailprice"],
    "scd2_no_delete": ["p_retailprice"],
    "scd1_null_keys": ["p_retailprice"],
    "scd1_composite": ["l_quantity"],
    "scd2_composite": ["l_quantity"],
    "full_refresh": ["p_retailprice"],
    "src_sql": ["total_price"],
    "src_customer_orders": ["total_amount"],
    "src_customer_360": ["lifetime_value"],
    "src_enriched_events": ["event_value"],
    "src_enriched_events_at": ["event_value"],
    "scd1_clash": ["s__p"],
}


# Date output columns per query: presented as ISO text ('YYYY-MM-DD') on both
# sides, since pandas renders a DuckDB DATE as a timestamp and a Spark date
# as a date.
DATE_OUTPUTS = {"report_match_rate_trend": ["run_date"]}


def portable_sql(name: str, sql: str) -> str:
    repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in DECIMAL_OUTPUTS.get(name, [])]
    repl += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in DATE_OUTPUTS.get(name, [])]
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({sql}) q"
