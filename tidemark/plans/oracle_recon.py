"""DuckDB oracle SQL for the reconciliation queries.

Written the plain way, as the reference computes each number: counts,
EXCEPT for missing / extra keys, GROUP BY ... HAVING for duplicates and an
inner join with a fingerprint inequality for mismatches.  Agreement with
the fused Spark plan is therefore a real check of the counting identity.
"""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.plans.inputs import DUCK


def _k(keys: Sequence[str], alias: str | None = None) -> str:
    return ", ".join(f"{alias}.{k}" if alias else k for k in keys)


def _on(keys: Sequence[str], a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def _summary_text(m: str, n: str, miss: str, extra: str, mism: str) -> str:
    return f"""CASE WHEN {miss} > 0 OR {extra} > 0 OR {mism} > 0
  THEN CAST({m} AS VARCHAR) || '/' || CAST({n} AS VARCHAR) || ' matched; ' || concat_ws('; ',
       CASE WHEN {miss} > 0 THEN CAST({miss} AS VARCHAR) || ' missing in target' END,
       CASE WHEN {extra} > 0 THEN CAST({extra} AS VARCHAR) || ' extra in target' END,
       CASE WHEN {mism} > 0 THEN CAST({mism} AS VARCHAR) || ' mismatched' END)
  ELSE 'Perfect match: ' || CAST({m} AS VARCHAR) || '/' || CAST({n} AS VARCHAR) || ' records' END"""


def exact_fingerprint(cols: Sequence[str]) -> str:
    """SHA-256 of every value's text behind its length, and a mark for NULL."""
    text = lambda c: f"CAST({c} AS VARCHAR)"
    return "sha256(" + " || ".join(f"coalesce(length({text(c)}) || ':' || {text(c)}, 'N;')" for c in cols) + ")"


def counts_cte(src: str, tgt: str, keys: Sequence[str], cols: Sequence[str], exact: bool = False) -> str:
    """CTEs s, t, c: c holds the seven raw counts, reference style."""
    fp = (exact_fingerprint(cols) if exact else DUCK.fingerprint(cols)) if cols else "NULL"
    ks = _k(keys)
    mism = (
        f"(SELECT count(*) FROM (SELECT {ks}, {fp} AS _h FROM s) a JOIN (SELECT {ks}, {fp} AS _h FROM t) b "
        f"ON {_on(keys, 'a', 'b')} WHERE a._h <> b._h)"
        if cols
        else "0"
    )
    return f"""s AS ({src}), t AS ({tgt}),
c AS (SELECT
  CAST((SELECT count(*) FROM s) AS BIGINT) AS source_count,
  CAST((SELECT count(*) FROM t) AS BIGINT) AS target_count,
  CAST((SELECT count(*) FROM (SELECT {ks} FROM s EXCEPT SELECT {ks} FROM t)) AS BIGINT) AS missing_count,
  CAST((SELECT count(*) FROM (SELECT {ks} FROM t EXCEPT SELECT {ks} FROM s)) AS BIGINT) AS extra_count,
  CAST({mism} AS BIGINT) AS mismatch_count,
  CAST((SELECT count(*) FROM (SELECT {ks} FROM s GROUP BY {ks} HAVING count(*) > 1)) AS BIGINT) AS source_duplicates,
  CAST((SELECT count(*) FROM (SELECT {ks} FROM t GROUP BY {ks} HAVING count(*) > 1)) AS BIGINT) AS target_duplicates)"""


def summary_select(cols: Sequence[str], source_name: str | None, target_name: str | None) -> str:
    m = "(source_count - missing_count - mismatch_count)"
    sn = f"'{source_name}'" if source_name else "CAST(NULL AS VARCHAR)"
    tn = f"'{target_name}'" if target_name else "CAST(NULL AS VARCHAR)"
    return f"""SELECT {sn} AS source_table, {tn} AS target_table, source_count, target_count,
  CAST({m} AS BIGINT) AS matched_count,
  CASE WHEN source_count > 0 THEN round_even(CAST({m} AS DOUBLE) / CAST(source_count AS DOUBLE) * 100.0, 2)
       ELSE 0.0 END AS match_rate,
  missing_count, extra_count, mismatch_count, source_duplicates, target_duplicates,
  CASE WHEN source_duplicates > 0 OR target_duplicates > 0 OR missing_count > 0 OR extra_count > 0
            OR mismatch_count > 0 THEN 'FAILED' ELSE 'PASSED' END AS status,
  {_summary_text(m, 'source_count', 'missing_count', 'extra_count', 'mismatch_count')} AS summary,
  '{",".join(cols)}' AS columns_compared
FROM c"""


def reconcile_sql(src, tgt, keys, cols, source_name=None, target_name=None, exact=False) -> str:
    return f"WITH {counts_cte(src, tgt, keys, cols, exact)}\n{summary_select(cols, source_name, target_name)}"


def thresholds_select(summary_rel: str, thresholds: dict | None, schema_status: str | None = None) -> str:
    if thresholds is None:
        breached = "false"
    else:
        mm = float(thresholds.get("max_mismatch_percent", 100))
        mi = float(thresholds.get("max_missing_percent", 100))
        breached = (
            f"CASE WHEN source_count > 0 THEN (CAST(mismatch_count AS DOUBLE) / CAST(source_count AS DOUBLE) * 100.0 > {mm}"
            f" OR CAST(missing_count AS DOUBLE) / CAST(source_count AS DOUBLE) * 100.0 > {mi}) ELSE false END"
        )
    sch = "false" if schema_status is None else f"('{schema_status}' = 'FAILED')"
    return f"""SELECT *, {breached} AS threshold_breached,
  CASE WHEN {breached} THEN 'THRESHOLD_BREACHED' WHEN {sch} OR status = 'FAILED' THEN 'FAILED' ELSE 'PASSED' END
    AS overall_status
FROM ({summary_rel}) r"""


def counts_sql(src, tgt) -> str:
    return (
        f"WITH s AS ({src}), t AS ({tgt}) SELECT CAST((SELECT count(*) FROM s) AS BIGINT) AS source_count, "
        "CAST((SELECT count(*) FROM t) AS BIGINT) AS target_count"
    )


def duplicates_sql(df_sql, keys) -> str:
    ks = _k(keys)
    return f"SELECT {ks}, CAST(count(*) AS BIGINT) AS cnt FROM ({df_sql}) d GROUP BY {ks} HAVING count(*) > 1"


def except_sql(a, b, keys) -> str:
    ks = _k(keys)
    return f"WITH a AS ({a}), b AS ({b}) SELECT {ks} FROM a EXCEPT SELECT {ks} FROM b"


def mismatches_sql(src, tgt, keys, cols, exact=False) -> str:
    fp = exact_fingerprint(cols) if exact else DUCK.fingerprint(cols)
    ks = _k(keys)
    return f"""WITH s AS ({src}), t AS ({tgt}),
sh AS (SELECT {ks}, {fp} AS _h FROM s), th AS (SELECT {ks}, {fp} AS _h FROM t),
p AS (SELECT {_k(keys, 'sh')}, CAST(count(*) AS BIGINT) AS mismatched_pairs
      FROM sh JOIN th ON {_on(keys, 'sh', 'th')} WHERE sh._h <> th._h GROUP BY {_k(keys, 'sh')}),
ss AS (SELECT {ks}, CASE WHEN count(DISTINCT _h) = 1 THEN min(_h) END AS source_hash,
             CAST(count(DISTINCT _h) AS BIGINT) AS source_versions FROM sh GROUP BY {ks}),
ts AS (SELECT {ks}, CASE WHEN count(DISTINCT _h) = 1 THEN min(_h) END AS target_hash,
             CAST(count(DISTINCT _h) AS BIGINT) AS target_versions FROM th GROUP BY {ks})
SELECT {_k(keys, 'p')}, ss.source_hash, ts.target_hash, p.mismatched_pairs, ss.source_versions, ts.target_versions
FROM p JOIN ss ON {_on(keys, 'p', 'ss')} JOIN ts ON {_on(keys, 'p', 'ts')}"""


def _json(keys, extra=()) -> str:
    return "CAST(to_json(struct_pack(" + ", ".join(f"{c} := {c}" for c in [*keys, *extra]) + ")) AS VARCHAR)"


def versions_cte(keys, cols) -> str:
    """CTEs sh, th (fingerprinted sides s, t), v (rows per side of each key and
    fingerprint) and mv: those with a differing row of the same key on the
    other side."""
    fp, ks = DUCK.fingerprint(cols), _k(keys)
    return f"""sh AS (SELECT {ks}, {fp} AS _h FROM s), th AS (SELECT {ks}, {fp} AS _h FROM t),
v AS (SELECT {ks}, _h, CAST(sum(a) AS BIGINT) AS ns, CAST(sum(b) AS BIGINT) AS nt
      FROM (SELECT *, 1 AS a, 0 AS b FROM sh UNION ALL SELECT *, 0, 1 FROM th) u GROUP BY {ks}, _h),
mv AS (SELECT * FROM v WHERE EXISTS (SELECT 1 FROM v w WHERE {_on(keys, 'w', 'v')} AND w._h <> v._h
       AND ((v.ns > 0 AND w.nt > 0) OR (v.nt > 0 AND w.ns > 0))))"""


def mismatch_versions_sql(src, tgt, keys, cols) -> str:
    return (f"WITH s AS ({src}), t AS ({tgt}), {versions_cte(keys, cols)}\n"
            f"SELECT {_k(keys)}, _h AS fingerprint, ns AS source_rows, nt AS target_rows FROM mv")


def issue_rows_sql(src, tgt, keys, cols, sample_size=None, header: str = "") -> str:
    """Issue rows (A3): all, or the first ``sample_size`` in key order of each
    type."""
    ks = _k(keys)
    kj, dj, null = _json(keys), _json(keys, ["cnt"]), "CAST(NULL AS VARCHAR)"
    order = ", ".join(f"{k} ASC NULLS FIRST" for k in keys)
    cut = f" ORDER BY {order}, source_values ASC NULLS LAST, target_values ASC NULLS FIRST LIMIT {int(sample_size)}" if sample_size else ""

    def issue(typ, rec, sv, tv, text, rel):
        return (f"SELECT issue_type, record_keys, source_values, target_values, details FROM (SELECT {ks}, '{typ}' AS issue_type, "
                f"{rec} AS record_keys, {sv} AS source_values, {tv} AS target_values, {text} AS details FROM ({rel}) x{cut})")

    parts = [
        issue("MISSING", kj, kj, null, "'Record exists in source but not in target'", f"SELECT {ks} FROM s EXCEPT SELECT {ks} FROM t"),
        issue("EXTRA", kj, null, kj, "'Record exists in target but not in source'", f"SELECT {ks} FROM t EXCEPT SELECT {ks} FROM s"),
    ]
    ctes = f"s AS ({src}), t AS ({tgt})"
    if cols:
        ctes += f", {versions_cte(keys, cols)}"
        ctes += f""",
several AS (SELECT {ks} FROM v GROUP BY {ks} HAVING count(*) FILTER (WHERE ns > 0) > 1 OR count(*) FILTER (WHERE nt > 0) > 1),
single AS (SELECT {_k(keys, 'a')}, a._h AS sv, b._h AS tv FROM mv a JOIN mv b ON {_on(keys, 'a', 'b')} AND a.ns > 0 AND b.nt > 0
           WHERE NOT EXISTS (SELECT 1 FROM several e WHERE {_on(keys, 'e', 'a')})),
apart AS (SELECT {_k(keys, 'm')}, CASE WHEN ns > 0 THEN _h END AS sv, CASE WHEN nt > 0 THEN _h END AS tv FROM mv m
          WHERE EXISTS (SELECT 1 FROM several e WHERE {_on(keys, 'e', 'm')}))"""
        parts.append(issue("MISMATCH", kj, "sv", "tv", "'Record values differ between source and target'",
                           "SELECT * FROM single UNION ALL SELECT * FROM apart"))
    for side, typ, word in (("s", "SOURCE_DUPLICATE", "source"), ("t", "TARGET_DUPLICATE", "target")):
        text = f"'Duplicate key found in {word} (count: ' || CAST(cnt AS VARCHAR) || ')'"
        rel = duplicates_sql(f"SELECT * FROM {side}", keys)
        parts.append(issue(typ, dj, dj if side == "s" else null, null if side == "s" else dj, text, rel))
    body = "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)
    return f"WITH {ctes}, issues AS ({body})\nSELECT {header}issue_type, record_keys, source_values, target_values, details FROM issues"


def null_profile_sql(src, tgt, cols) -> str:
    rows = []
    for c in cols:
        rows.append(
            f"SELECT '{c}' AS column_name, (SELECT CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM s) AS source_nulls, "
            f"(SELECT CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) FROM t) AS target_nulls"
        )
    body = " UNION ALL ".join(rows)
    return (
        f"WITH s AS ({src}), t AS ({tgt}), n AS ({body}) SELECT column_name, source_nulls, target_nulls, "
        "CAST(target_nulls - source_nulls AS BIGINT) AS null_difference FROM n"
    )
