"""DuckDB oracle SQL for the load queries.

Written from the decision tables (SURVEY 2.12) as plain joins, with no
reference to how the Spark plans are built.
"""

from __future__ import annotations

from tidemark.plans import inputs as I

D = I.DUCK
AS_OF = D.ts(I.AS_OF)
# The SCD2 metadata columns.
META = ["_hash", "batch_id", "effective_start_date", "effective_end_date", "is_active", "updated_timestamp"]


def _on(keys, a, b):
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


# ---------------------------------------------------------------- incremental

def incremental_new_sql(t, b, keys):
    return f"SELECT b.* FROM ({b}) b WHERE NOT EXISTS (SELECT 1 FROM ({t}) t WHERE {_on(keys, 't', 'b')})"


def incremental_state_sql(t, b, keys):
    return f"SELECT * FROM ({t}) t0 UNION ALL {incremental_new_sql(t, b, keys)}"


# ---------------------------------------------------------------- SCD1

def scd1_first_sql(src):
    return f"SELECT *, {AS_OF} AS created_at, {AS_OF} AS updated_at FROM ({src}) s"


# One relation per outcome, from an inner join and two anti joins.

def scd1_cte(tgt, src, keys, cols, target_cols):
    """CTEs: t, s, matched (changed or equal), inserted, target_only: rows of
    the new state with their action."""
    own = {"created_at": "t.created_at", "updated_at": AS_OF}
    both = ", ".join(f"{f's.{c}' if c in cols else own.get(c, f't.{c}')} AS {c}" for c in target_cols)
    new = ", ".join(f"{c if c in {*keys, *cols} else AS_OF if c in own else 'NULL'} AS {c}" for c in target_cols)
    differ = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in cols)
    return f"""t AS ({tgt}), s AS ({src}),
matched AS (SELECT {both}, CASE WHEN {differ} THEN 'matched_changed' ELSE 'matched_equal' END AS action
            FROM t JOIN s ON {_on(keys, 't', 's')}),
inserted AS (SELECT {new}, 'inserted' AS action FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_on(keys, 't', 's')})),
target_only AS (SELECT {', '.join(target_cols)}, 'target_only' AS action FROM t
                WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_on(keys, 't', 's')}))"""


def scd1_state_sql(tgt, src, keys, cols, target_cols, change_set=False):
    parts = ["matched", "inserted"] + ([] if change_set else ["target_only"])  # a MERGE writes the first two
    out = ", ".join(target_cols) + (", action" if change_set else "")
    return f"WITH {scd1_cte(tgt, src, keys, cols, target_cols)}\n" + " UNION ALL ".join(f"SELECT {out} FROM {p}" for p in parts)


def scd1_actions_sql(tgt, src, keys, cols, target_cols):
    rows = " UNION ALL ".join(f"SELECT action FROM {p}" for p in ("matched", "inserted", "target_only"))
    return (
        f"WITH {scd1_cte(tgt, src, keys, cols, target_cols)}\n"
        f"SELECT action, CAST(count(*) AS BIGINT) AS n_keys FROM ({rows}) a GROUP BY action"
    )


# ---------------------------------------------------------------- SCD2
# One relation per row of the decision table, from semi and anti joins: which
# active target rows have a source row, and which source rows have an active
# target row.  The state is put together from these relations.

def _matches(a, b, keys):
    return f"EXISTS (SELECT 1 FROM {b} WHERE {_on(keys, a, b)})"


def scd2_cte(tgt, src, keys, cols, target_cols, delete=None):
    """CTEs: tg (target), h (closed versions), act_t (active versions), s
    (source with hash and flag), and the outcomes deleted, changed, unchanged,
    target_only (of active versions), skipped, opened (of source rows)."""
    flag = f"({delete[0]} IS NOT DISTINCT FROM '{delete[1]}')" if delete else "FALSE"
    src_cols = ", ".join([*keys, *cols, *([delete[0]] if delete else [])])
    other_hash = f"EXISTS (SELECT 1 FROM s WHERE {_on(keys, 'act_t', 's')} AND s._hash IS DISTINCT FROM act_t._hash AND NOT s._flag)"
    flagged = f"EXISTS (SELECT 1 FROM s WHERE {_on(keys, 'act_t', 's')} AND s._flag)"
    same = f"EXISTS (SELECT 1 FROM s WHERE {_on(keys, 'act_t', 's')} AND s._hash IS NOT DISTINCT FROM act_t._hash AND NOT s._flag)"
    return f"""tg AS ({tgt}), sr AS ({src}),
s AS (SELECT {src_cols}, {D.fingerprint(cols)} AS _hash, {flag} AS _flag FROM sr),
act_t AS (SELECT * FROM tg WHERE is_active = 'Y'),
h AS (SELECT * FROM tg WHERE is_active IS DISTINCT FROM 'Y'),
deleted AS (SELECT * FROM act_t WHERE {flagged}),
changed AS (SELECT * FROM act_t WHERE {other_hash}),
unchanged AS (SELECT * FROM act_t WHERE {same}),
target_only AS (SELECT * FROM act_t WHERE NOT {_matches('act_t', 's', keys)}),
fresh AS (SELECT * FROM s WHERE NOT _flag AND NOT {_matches('s', 'act_t', keys)}),
skipped AS (SELECT * FROM s WHERE _flag AND NOT {_matches('s', 'act_t', keys)}),
successor AS (SELECT * FROM s WHERE {_matches('s', 'changed', keys)})"""


def scd2_rows_sql(keys, cols, target_cols, delete=None, with_action=False):
    """The new state, as a union of the outcomes (after scd2_cte)."""
    given = {*keys, *cols, "_hash", *([delete[0]] if delete else [])}
    closing = {"effective_end_date": AS_OF, "updated_timestamp": AS_OF, "is_active": "'N'"}
    opening = {"batch_id": f"'{I.BATCH_ID}'", "effective_start_date": AS_OF, "updated_timestamp": AS_OF,
               "effective_end_date": D.null_ts, "is_active": "'Y'"}
    closed = ", ".join(f"{closing.get(c, c)} AS {c}" for c in target_cols)
    opened = ", ".join(f"{c if c in given else opening.get(c, 'NULL')} AS {c}" for c in target_cols)
    kept = ", ".join(target_cols)
    parts = [(closed, "deleted", "deleted"), (closed, "changed", "changed"), (opened, "successor", "changed"),
             (opened, "fresh", "new"), (kept, "unchanged", "unchanged"), (kept, "target_only", "target_only"),
             (kept, "h", "history")]
    tag = lambda a: f", '{a}' AS action" if with_action else ""
    return "\nUNION ALL ".join(f"SELECT {cols_}{tag(a)} FROM {rel}" for cols_, rel, a in parts)


def scd2_state_sql(tgt, src, keys, cols, target_cols, delete=None):
    return f"WITH {scd2_cte(tgt, src, keys, cols, target_cols, delete)}\n{scd2_rows_sql(keys, cols, target_cols, delete)}"


def _reactivation(keys):
    cond = " AND ".join(f"hh.{k} = r.{k}" for k in keys)
    return f"CASE WHEN r.action = 'new' AND EXISTS (SELECT 1 FROM h hh WHERE {cond}) THEN 'reactivated' ELSE r.action END"


def scd2_rows_for_sql(tgt, src, keys, cols, target_cols, delete, wanted):
    rows = scd2_rows_sql(keys, cols, target_cols, delete, with_action=True)
    return (
        f"WITH {scd2_cte(tgt, src, keys, cols, target_cols, delete)},\nr AS ({rows}),\n"
        f"lab AS (SELECT r.* EXCLUDE (action), {_reactivation(keys)} AS action FROM r)\n"
        f"SELECT * FROM lab WHERE action = '{wanted}'"
    )


def scd2_counts_sql(tgt, src, keys, cols, target_cols, delete):
    ks = ", ".join(keys)
    cond = " AND ".join(f"hh.{k} = r.{k}" for k in keys)
    outcomes = (("deleted", "deleted"), ("changed", "changed"), ("unchanged", "unchanged"),
                ("target_only", "target_only"), ("fresh", "new"), ("skipped", "skipped"))
    rows = " UNION ALL ".join(f"SELECT {ks}, '{a}' AS action FROM {rel}" for rel, a in outcomes)
    return f"""WITH {scd2_cte(tgt, src, keys, cols, target_cols, delete)}, r AS ({rows}),
lab AS (SELECT {_reactivation(keys)} AS action, EXISTS (SELECT 1 FROM h hh WHERE {cond}) AS has_history FROM r)
SELECT action, CAST(count(*) AS BIGINT) AS n_keys, CAST(count(*) FILTER (WHERE has_history) AS BIGINT) AS n_with_history
FROM lab GROUP BY action"""


def scd2_first_sql(src, keys, cols, delete=None):
    carry = [delete[0]] if delete else []
    src_cols = [*keys, *cols, *carry]
    flag = f"({delete[0]} IS NOT DISTINCT FROM '{delete[1]}')" if delete else "FALSE"
    return (
        f"SELECT {', '.join(src_cols)}, {D.fingerprint(cols)} AS _hash, '{I.BATCH_ID}' AS batch_id, "
        f"{AS_OF} AS effective_start_date, {D.null_ts} AS effective_end_date, 'Y' AS is_active, "
        f"{AS_OF} AS updated_timestamp FROM ({src}) s WHERE NOT {flag}"
    )


def scd2_stats_select(table, op):
    n = lambda rel, where="true": f"(SELECT count(*) FROM {rel} WHERE {where})"
    return f"""SELECT '{table}' AS table_name, '{op}' AS operation_type,
  CAST({n('s')} AS BIGINT) AS source_count, CAST({n('fresh')} AS BIGINT) AS inserted,
  CAST({n('changed')} AS BIGINT) AS updated, CAST({n('deleted')} AS BIGINT) AS deleted,
  CAST({n('unchanged')} + {n('target_only')} + {n('changed')} + {n('fresh')} AS BIGINT) AS active_count,
  CAST({n('changed')} + {n('deleted')} + {n('h', "is_active = 'N'")} AS BIGINT) AS historical_count"""


def simple_stats_select(table, op, n_src, n_ins, n_upd, n_active):
    return (
        f"SELECT '{table}' AS table_name, '{op}' AS operation_type, CAST({n_src} AS BIGINT) AS source_count, "
        f"CAST({n_ins} AS BIGINT) AS inserted, CAST({n_upd} AS BIGINT) AS updated, CAST(0 AS BIGINT) AS deleted, "
        f"CAST({n_active} AS BIGINT) AS active_count, CAST(0 AS BIGINT) AS historical_count"
    )
