"""Load strategies as functions from (target state, source) to new state.

``target=None`` means the target does not exist yet (first load).  Each
strategy is one lazy plan; the ``*_joined`` helpers expose the per-key
action tag the plan is built on, so statistics come from the same plan as
the rows (no second pass over the source, no before/after counts).

Scale notes
-----------
* SCD1 and SCD2 join only the *active* target rows with the source, on the
  keys (one exchange per side).  Closed history is passed through without a
  shuffle, so a key with a long history never weighs on the join.
* The duplicate-source-key check numbers the rows of each source key.  It
  needs the same hash partitioning and key order the sort-merge join needs,
  so it adds no exchange and no sort of its own.
* Rows with a NULL key never match, yet plain hashing of the keys would deal
  all of them to one task.  A further join column, 0 for complete keys and a
  hash of the row for others, spreads them (``_spread``).
* A changed key emits two rows (closed + new version) from one joined row
  via ``explode``; the join is computed once.
* Columns of the two sides are renamed ``t__x`` / ``s__x`` before any helper
  column is added, and joined frames carry rows in structs, so that no column
  of a table can be taken for a helper's, whatever it is called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fingerprint import (
    all_not_null,
    change_hash_sql,
    column_types,
    quote,
    resolve,
    sql_string,
    ts_literal,
    ts_sql,
    ts_type,
    unused,
)

# SCD2 metadata columns and flag values.
HASH = "_hash"
BATCH = "batch_id"
START = "effective_start_date"
END = "effective_end_date"
ACTIVE = "is_active"
UPDATED = "updated_timestamp"
SCD2_META = [HASH, BATCH, START, END, ACTIVE, UPDATED]
YES, NO = "Y", "N"
CREATED_AT, UPDATED_AT = "created_at", "updated_at"

# Action tags.
UNCHANGED, CHANGED, DELETED, NEW, REACTIVATED, TARGET_ONLY, SKIPPED, HISTORY = (
    "unchanged",
    "changed",
    "deleted",
    "new",
    "reactivated",
    "target_only",
    "skipped",
    "history",
)
MATCHED_CHANGED, MATCHED_EQUAL, INSERTED, EXISTING = "matched_changed", "matched_equal", "inserted", "existing"

DUPLICATE_KEY_MESSAGE = "DUPLICATE_SOURCE_KEY: the source holds more than one row for a key"


class DuplicateKeyError(ValueError):
    """Several source rows share one non-NULL key in an SCD1/SCD2 load."""


def _validate(keys: Sequence[str], columns: Sequence[str] | None, source: DataFrame) -> None:
    if not keys:
        raise ValueError("keys must be a non-empty list of column names")
    missing = [c for c in [*keys, *(columns or [])] if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")


SPREAD = "_spread"
T_PREFIX, S_PREFIX = "t__", "s__"


def _prefixed(df: DataFrame, prefix: str, columns: Sequence[str] | None = None, *more: str) -> DataFrame:
    """The columns (all of them by default), renamed, and further SQL expressions."""
    return df.selectExpr(*[f"{quote(c)} AS {quote(prefix + c)}" for c in (df.columns if columns is None else columns)], *more)


def _plain(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    """The columns under their own names again."""
    return df.selectExpr(*[f"{quote(prefix + c)} AS {quote(c)}" for c in columns])


def _with_spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``_spread`` to a frame of renamed columns: 0 where every key is set,
    else a hash of the row.  As a join and window column it leaves what matches
    as it is (a NULL key matches nothing) and deals the rows with NULL keys to
    all tasks."""
    row = ", ".join(quote(f.name) for f in df.schema.fields if not _holds_map(f.dataType))
    complete = " AND ".join(f"{quote(k)} IS NOT NULL" for k in keys)
    return df.withColumn(SPREAD, F.expr(f"CASE WHEN {complete} THEN 0L ELSE xxhash64({row}) END"))


def _holds_map(dtype: T.DataType) -> bool:
    return "map<" in dtype.simpleString()


def guard_unique_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, a frame of renamed columns, with ``_spread``; fails the query
    (``raise_error``) at the second row of a complete key.

    The row number is partitioned by the keys and ``_spread``, which is what
    the following sort-merge join on them requires, so Spark reuses the
    exchange and the sort.  NULL keys never match and are inserted as they
    come (MERGE semantics), so they are not checked.
    """
    kc = [F.col(quote(k)) for k in keys]
    n = F.row_number().over(Window.partitionBy(*kc, SPREAD).orderBy(*kc, SPREAD))
    bad = (F.col("_key_rows") > 1) & all_not_null(keys)
    checked = _with_spread(source, keys).withColumn("_key_rows", n)
    return checked.filter(F.when(bad, F.raise_error(F.lit(DUPLICATE_KEY_MESSAGE))).otherwise(F.lit(True))).drop(
        "_key_rows"
    )


def _cast_sql(expr: str, dtype: T.DataType | None) -> str:
    return f"CAST({expr} AS {dtype.simpleString()})" if dtype is not None else expr


def _on_keys(keys: Sequence[str], right_prefix: str) -> str:
    """The join condition of renamed sides ``l`` (source) and ``r``: plain ``=``,
    so that NULL keys never match, and ``_spread``."""
    pairs = [(S_PREFIX + k, right_prefix + k) for k in keys] + [(SPREAD, SPREAD)]
    return " AND ".join(f"l.{quote(a)} = r.{quote(b)}" for a, b in pairs)


def _join_flat(t: DataFrame, s: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Renamed target ``t`` FULL OUTER JOIN renamed source ``s`` (which has
    ``_spread``), without ``_spread``."""
    t = _with_spread(t, [T_PREFIX + k for k in keys])
    j = s.alias("l").join(t.alias("r"), F.expr(_on_keys(keys, T_PREFIX)), "full_outer")
    return j.selectExpr(*[f"{side}.{quote(c)}" for side, df in (("r", t), ("l", s)) for c in df.columns if c != SPREAD])


def _keys_in(rows: DataFrame, batch: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """The distinct keys (``k__x``) of ``rows`` that ``batch`` has, with ``flag``
    (true) and ``_spread`` (0).  When the planner's size estimate of the
    batch's distinct keys is under the broadcast threshold the (large) other
    side's keys stream through a hash lookup without being shuffled; otherwise
    it is a sort-merge join."""
    some = _prefixed(batch, "k__", keys).dropDuplicates()
    found = _prefixed(rows, "k__", keys).join(some, ["k__" + k for k in keys], "left_semi").dropDuplicates()
    return found.selectExpr("*", f"true AS {flag}", f"0L AS {SPREAD}")


# ---------------------------------------------------------------- full refresh


def full_refresh(source: DataFrame) -> DataFrame:
    """The new state is the source as it is."""
    return source


# ---------------------------------------------------------------- incremental


def incremental_new_rows(target: DataFrame | None, source: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows to append.  First load: all.  No keys: all.  Keys: source rows
    whose key matches no target row (plain ``=``: NULL keys are always new;
    duplicates inside the batch are all appended)."""
    if target is None or not keys:
        return source
    tagged = _tagged(target, source, keys).filter("_hit IS NULL")
    return _plain(tagged, S_PREFIX, source.columns)


def _tagged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The renamed source with ``_hit``: true where the target has the key."""
    s = _with_spread(_prefixed(source, S_PREFIX), [S_PREFIX + k for k in keys])
    hits = _keys_in(target, source, keys, "_hit")
    return s.alias("l").join(hits.alias("r"), F.expr(_on_keys(keys, "k__")), "left").selectExpr("l.*", "r._hit")


def incremental_tagged(target: DataFrame | None, source: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every source row, as the struct ``_row``, with ``_new``: true when it
    would be appended.  One plan gives both the rows to append and the counters."""
    fields = lambda prefix: ", ".join(f"{sql_string(c)}, {quote(prefix + c)}" for c in source.columns)
    if target is None or not keys:
        return source.selectExpr(f"named_struct({fields('')}) AS _row", "true AS _new")
    return _tagged(target, source, keys).selectExpr(f"named_struct({fields(S_PREFIX)}) AS _row", "_hit IS NULL AS _new")


def incremental(target: DataFrame | None, source: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """New state: target plus the new rows (append by column name)."""
    new = incremental_new_rows(target, source, keys)
    return new if target is None else target.unionByName(new)


def incremental_stats(target: DataFrame | None, source: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    new = incremental_new_rows(target, source, keys)
    tagged = source.select(F.lit("source").alias("_a")).unionByName(new.select(F.lit(INSERTED).alias("_a")))
    if target is not None:
        tagged = tagged.unionByName(target.select(F.lit(EXISTING).alias("_a")))
    a = F.col("_a")
    return tagged.agg(
        F.count_if(a == "source").alias("source_count"),
        F.count_if(a == INSERTED).alias("inserted"),
        F.lit(0).cast("long").alias("updated"),
        F.lit(0).cast("long").alias("deleted"),
        F.count_if(a.isin(INSERTED, EXISTING)).alias("active_count"),
        F.lit(0).cast("long").alias("historical_count"),
    )


# ---------------------------------------------------------------- SCD type 1


def _scd1_source(source: DataFrame, keys, columns, as_of) -> DataFrame:
    ts = ts_literal(as_of)
    out = source
    if CREATED_AT not in out.columns:
        out = out.withColumn(CREATED_AT, ts)
    if UPDATED_AT not in out.columns:
        out = out.withColumn(UPDATED_AT, ts)
    return out


def scd1_joined(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str], as_of=None
) -> DataFrame:
    """Full outer join of target and source on the keys: ``_action``
    (matched_changed / matched_equal / inserted / target_only), ``_sp`` (the
    source has the key) and ``_row``, the row of the new state as a struct."""
    _validate(keys, columns, source)
    ts = ts_sql(as_of)
    src = _scd1_source(source, keys, columns, as_of)
    ins_cols = list(dict.fromkeys([*keys, *columns, CREATED_AT, UPDATED_AT]))
    s = guard_unique_keys(_prefixed(src, S_PREFIX, ins_cols, "true AS _sp"), [S_PREFIX + k for k in keys])
    t = _prefixed(target, T_PREFIX, None, "true AS _tp")
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    absent = [c for c in [*keys, *columns] if c not in ttypes]
    if absent:
        raise ValueError(f"target lacks key or tracked columns {absent}")
    j = _join_flat(t, s, keys)
    T_, S_ = (lambda c: quote(T_PREFIX + c)), (lambda c: quote(S_PREFIX + c))
    tp, sp = "_tp IS NOT NULL", "_sp IS NOT NULL"
    differ = " OR ".join(f"NOT ({T_(c)} <=> {_cast_sql(S_(c), ttypes[c])})" for c in columns) or "false"
    action = (
        f"CASE WHEN {tp} AND {sp} AND ({differ}) THEN '{MATCHED_CHANGED}' WHEN {tp} AND {sp} THEN '{MATCHED_EQUAL}' "
        f"WHEN {sp} THEN '{INSERTED}' ELSE '{TARGET_ONLY}' END"
    )
    outs = []
    for c in target.columns:
        dt = ttypes[c]
        if c in keys:
            v = f"CASE WHEN {tp} THEN {T_(c)} ELSE {_cast_sql(S_(c), dt)} END"
        elif c in columns:
            v = f"CASE WHEN {sp} THEN {_cast_sql(S_(c), dt)} ELSE {T_(c)} END"
        elif c == CREATED_AT:
            v = f"CASE WHEN {tp} THEN {T_(c)} ELSE {_cast_sql(S_(c), dt)} END"
        elif c == UPDATED_AT:
            v = (f"CASE WHEN {tp} AND {sp} THEN {_cast_sql(ts, dt)} WHEN {sp} THEN {_cast_sql(S_(c), dt)} "
                 f"ELSE {T_(c)} END")
        else:
            v = f"CASE WHEN {tp} THEN {T_(c)} ELSE {_cast_sql('NULL', dt)} END"
        outs.append(f"{sql_string(c)}, {v}")
    return j.selectExpr(f"{action} AS _action", f"{sp} AS _sp", f"named_struct({', '.join(outs)}) AS _row")


def scd1_changes(joined: DataFrame) -> DataFrame:
    """Only the rows an SCD1 load writes: every matched key (its update
    time moves even when nothing else changed) and every inserted key, with
    their action in a last column, ``action`` unless a column is called that.
    What a table format with MERGE needs: O(batch) to write."""
    return _with_action(joined.filter(F.col("_action") != TARGET_ONLY))


def _with_action(rows: DataFrame) -> DataFrame:
    """The fields of ``_row``, and its action."""
    label = unused("action", rows.schema["_row"].dataType.fieldNames())
    return rows.selectExpr("_row.*", f"_action AS {quote(label)}")


def scd1(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], columns: Sequence[str], as_of=None
) -> DataFrame:
    """SCD type 1 upsert.  First load: the source plus ``created_at`` /
    ``updated_at`` (= ``as_of``) when it lacks them."""
    if target is None:
        _validate(keys, columns, source)
        rows = _scd1_source(source, keys, columns, as_of)
        return _plain(guard_unique_keys(_prefixed(rows, S_PREFIX), [S_PREFIX + k for k in keys]), S_PREFIX, rows.columns)
    return scd1_joined(target, source, keys, columns, as_of).select("_row.*")


def scd1_stats(target, source, keys, columns, as_of=None) -> DataFrame:
    if target is None:
        n = source.agg(F.count(F.lit(1)).alias("n"))
        return n.select(
            F.col("n").alias("source_count"),
            F.col("n").alias("inserted"),
            F.lit(0).cast("long").alias("updated"),
            F.lit(0).cast("long").alias("deleted"),
            F.col("n").alias("active_count"),
            F.lit(0).cast("long").alias("historical_count"),
        )
    j = scd1_joined(target, source, keys, columns, as_of)
    return stats_from_actions(j.select("_action", "_sp"), "scd1")


# ---------------------------------------------------------------- SCD type 2


def _scd2_source(source, keys, columns, delete_column, delete_value, exact) -> tuple[DataFrame, list[str]]:
    """Keys, tracked columns and the delete column, renamed; ``_new_hash`` and
    ``_flag``.  The delete column is resolved as the session resolves names; a
    name that the source lacks is an error, not a load without deletes.  So is
    a key or tracked column that is called like one of the target's own."""
    _validate(keys, columns, source)
    carry = [resolve(source, delete_column)] if delete_column else []
    src_cols = list(dict.fromkeys([*keys, *columns, *carry]))
    if clash := [c for c in src_cols if c.lower() in SCD2_META]:
        raise ValueError(f"columns {clash} are called like columns that an SCD2 table has for itself")
    flag = f"{quote(carry[0])} <=> {sql_string(delete_value)}" if carry and delete_value is not None else "false"
    return _prefixed(source, S_PREFIX, src_cols, f"{change_hash_sql(columns, exact, types=column_types(source, columns))} AS _new_hash", f"{flag} AS _flag"), src_cols


def _new_version(src_cols, out_types, ts, batch_id):
    """SQL expressions (name, text) of a fresh active version built from renamed source columns."""
    vals = {c: quote(S_PREFIX + c) for c in src_cols}
    vals.update(
        {
            HASH: "_new_hash",
            BATCH: f"CAST({sql_string(batch_id)} AS STRING)",
            START: ts,
            END: "NULL",
            ACTIVE: f"'{YES}'",
            UPDATED: ts,
        }
    )
    return [(c, _cast_sql(vals.get(c, "NULL"), out_types.get(c))) for c in out_types]

def scd2_joined(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    as_of=None,
    batch_id: str | None = None,
    delete_column: str | None = None,
    delete_value=None,
    exact: bool = False,
    label_reactivated: bool = False,
    with_rows: bool = True,
) -> DataFrame:
    """Active target rows FULL OUTER JOIN source on the keys.

    One row per joined pair: ``_keys`` (a struct), ``_action``, ``_sp`` (the
    source has the key) and ``_rows``: the 0-2 output rows of the new state for
    that pair (closed or kept target row; new version), as an array of structs
    in the target's column order.

    With ``label_reactivated`` a new key that has a closed version is tagged
    ``reactivated``: the source is left-joined with the history keys, first
    reduced to the source's keys by a semi join (broadcast when the planner's
    size estimate allows), on the same key partitioning as the main join.
    """
    ts = ts_sql(as_of)
    s, src_cols = _scd2_source(source, keys, columns, delete_column, delete_value, exact)
    s = guard_unique_keys(s, [S_PREFIX + k for k in keys]).withColumn("_sp", F.lit(True))
    if label_reactivated:
        hk = _keys_in(_history(target), source, keys, "_h")
        s = s.alias("l").join(hk.alias("r"), F.expr(_on_keys(keys, "k__")), "left").selectExpr("l.*", "r._h")
    else:
        s = s.withColumn("_h", F.lit(None).cast("boolean"))
    out_types = {f.name: f.dataType for f in target.schema.fields}
    active = _prefixed(target.filter(F.col(ACTIVE) == F.lit(YES)), T_PREFIX, None, "true AS _tp")
    j = _join_flat(active, s, keys)
    T_, S_ = (lambda c: quote(T_PREFIX + c)), (lambda c: quote(S_PREFIX + c))
    tp, sp = "_tp IS NOT NULL", "_sp IS NOT NULL"
    flag = "coalesce(_flag, false)"
    differ = f"NOT ({T_(HASH)} <=> _new_hash)"
    action = (
        f"CASE WHEN {tp} AND {sp} AND {flag} THEN '{DELETED}' "
        f"WHEN {tp} AND {sp} AND {differ} THEN '{CHANGED}' "
        f"WHEN {tp} AND {sp} THEN '{UNCHANGED}' "
        f"WHEN {sp} AND {flag} THEN '{SKIPPED}' "
        f"WHEN {sp} AND _h IS NOT NULL THEN '{REACTIVATED}' "
        f"WHEN {sp} THEN '{NEW}' ELSE '{TARGET_ONLY}' END"
    )
    j = j.selectExpr("*", f"{action} AS _action")
    closing = f"_action IN ('{CHANGED}', '{DELETED}')"
    kept = []
    for c, dt in out_types.items():
        v = T_(c)
        if c in (END, UPDATED):
            v = f"CASE WHEN {closing} THEN {_cast_sql(ts, dt)} ELSE {v} END"
        elif c == ACTIVE:
            v = f"CASE WHEN {closing} THEN '{NO}' ELSE {v} END"
        kept.append(f"{sql_string(c)}, {v}")
    first = f"CASE WHEN {tp} THEN named_struct({', '.join(kept)}) END"
    new = [f"{sql_string(c)}, {v}" for c, v in _new_version(src_cols, out_types, ts, batch_id)]
    second = f"CASE WHEN _action IN ('{CHANGED}', '{NEW}', '{REACTIVATED}') THEN named_struct({', '.join(new)}) END"
    key_out = ", ".join(f"{sql_string(k)}, coalesce({T_(k)}, {S_(k)})" for k in keys)
    out = [f"named_struct({key_out}) AS _keys", "_action", f"{sp} AS _sp"]
    if with_rows:  # else actions and counters only: no output rows are built
        out.append(f"filter(array({first}, {second}), x -> x IS NOT NULL) AS _rows")
    return j.selectExpr(*out)


def scd2_changes(joined: DataFrame) -> DataFrame:
    """Only the rows a load changes: active versions it closes and versions
    it opens, each with its action in a last column (``action``, unless a
    column is called that).  This is what a table format with
    MERGE needs (match closed rows on keys + ``effective_start_date``, insert
    the rest): O(batch) to write instead of the whole state."""
    touched = joined.filter(F.col("_action").isin(CHANGED, DELETED, NEW, REACTIVATED))
    return _with_action(touched.selectExpr("explode(_rows) AS _row", "_action"))


def _history(target: DataFrame) -> DataFrame:
    return target.filter(~F.col(ACTIVE).eqNullSafe(F.lit(YES)))


def closed_rows(target: DataFrame) -> DataFrame:
    """The versions of an SCD2 target that no load touches."""
    return _history(target)


def scd2_first(source, keys, columns, as_of=None, batch_id=None, delete_column=None, delete_value=None, exact=False):
    """First load: every unflagged source row becomes an active version
    (a flagged row is skipped, as it would be when loading into an empty
    target)."""
    s, src_cols = _scd2_source(source, keys, columns, delete_column, delete_value, exact)
    s = guard_unique_keys(s, [S_PREFIX + k for k in keys]).filter("NOT _flag")
    types = {c: None for c in [*src_cols, *SCD2_META]}
    types[END] = ts_type(as_of)
    return s.selectExpr(*[f"{v} AS {quote(c)}" for c, v in _new_version(src_cols, types, ts_sql(as_of), batch_id)])

def scd2(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    as_of=None,
    batch_id: str | None = None,
    delete_column: str | None = None,
    delete_value=None,
    exact: bool = False,
) -> DataFrame:
    """SCD type 2: the new full state (history + current versions)."""
    if target is None:
        return scd2_first(source, keys, columns, as_of, batch_id, delete_column, delete_value, exact)
    j = scd2_joined(target, source, keys, columns, as_of, batch_id, delete_column, delete_value, exact)
    return scd2_state_from_joined(j, target)


def scd2_state_from_joined(
    joined: DataFrame, target: DataFrame, with_action: bool = False, history: DataFrame | None = None
) -> DataFrame:
    """History (``history``: the closed rows of ``target``, if they are at
    hand) and the rows that the joined pairs give; with their action as
    ``scd2_changes`` gives it, if it is asked for."""
    closed = history if history is not None else _history(target)
    emitted = joined.selectExpr("explode(_rows) AS _row", "_action")
    if not with_action:
        return emitted.selectExpr("_row.*").unionByName(closed)
    label = unused("action", target.columns)
    return _with_action(emitted).unionByName(closed.selectExpr("*", f"'{HISTORY}' AS {quote(label)}"))


def scd2_actions(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    as_of=None,
    batch_id=None,
    delete_column=None,
    delete_value=None,
    exact=False,
    label_reactivated: bool = True,
) -> DataFrame:
    """One row per key touched by the load: keys, ``action`` and, with
    ``label_reactivated``, ``has_history`` (the key has a closed version);
    a new key that has history is then labelled ``reactivated``.  A key that is
    called like one of these gives it an underscore."""
    j = scd2_joined(target, source, keys, columns, as_of, batch_id, delete_column, delete_value, exact,
                    label_reactivated=label_reactivated, with_rows=False)
    acts = j.select("_keys.*", F.col("_action").alias(unused("action", keys)))
    if not label_reactivated:
        return acts
    return with_history_flag(acts, target, keys)


def with_history_flag(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``has_history``: the key has a closed version.  History keys are
    first reduced to the keys in ``rows`` by a semi join, so long histories
    are not shuffled whole."""
    hk = _keys_in(_history(target), rows, keys, "_h")
    s = _with_spread(_prefixed(rows, S_PREFIX), [S_PREFIX + k for k in keys])
    flagged = s.alias("l").join(hk.alias("r"), F.expr(_on_keys(keys, "k__")), "left")
    names = [f"l.{quote(S_PREFIX + c)} AS {quote(c)}" for c in rows.columns]
    return flagged.selectExpr(*names, f"coalesce(r._h, false) AS {quote(unused('has_history', rows.columns))}")


def counter_exprs(kind: str) -> list[str]:
    """The load counters as aggregates over ``_action`` and ``_sp``; for SCD2
    without the closed versions that were there before (``history_exprs``)."""
    if kind == "scd1":
        return [
            "count_if(_sp) AS source_count",
            f"count_if(_action = '{INSERTED}') AS inserted",
            f"count_if(_action IN ('{MATCHED_CHANGED}', '{MATCHED_EQUAL}')) AS updated",
            "CAST(0 AS BIGINT) AS deleted",
            "count(1) AS active_count",
            "CAST(0 AS BIGINT) AS historical_count",
        ]
    return [
        "count_if(_sp) AS source_count",
        f"count_if(_action IN ('{NEW}', '{REACTIVATED}')) AS inserted",
        f"count_if(_action = '{CHANGED}') AS updated",
        f"count_if(_action = '{DELETED}') AS deleted",
        f"count_if(_action IN ('{UNCHANGED}', '{TARGET_ONLY}', '{CHANGED}', '{NEW}', '{REACTIVATED}')) AS active_count",
        f"count_if(_action IN ('{CHANGED}', '{DELETED}')) AS historical_count",
    ]


HISTORY_EXPR = f"count_if({ACTIVE} = '{NO}') AS closed_before"


def stats_from_actions(tagged: DataFrame, kind: str) -> DataFrame:
    """The six load counters from a frame of (_action, _sp[, _hist_n])."""
    exprs = counter_exprs(kind)
    if kind == "scd2":
        closed = exprs.pop().rsplit(" AS ", 1)[0]
        exprs.append(f"CAST({closed} + coalesce(sum(_hist_n), 0) AS BIGINT) AS historical_count")
    return tagged.selectExpr(*exprs)


def scd2_stats_from_joined(joined: DataFrame, target: DataFrame | None) -> DataFrame:
    tagged = joined.selectExpr("_action", "_sp", "CAST(0 AS BIGINT) AS _hist_n")
    if target is not None:
        hist = _history(target).selectExpr(
            f"'{HISTORY}' AS _action", "false AS _sp",
            f"CAST(CASE WHEN {ACTIVE} = '{NO}' THEN 1 ELSE 0 END AS BIGINT) AS _hist_n",
        )
        tagged = tagged.unionByName(hist)
    return stats_from_actions(tagged, "scd2")


def scd2_stats(target, source, keys, columns, as_of=None, batch_id=None, delete_column=None, delete_value=None, exact=False):
    if target is None:
        first = scd2_first(source, keys, columns, as_of, batch_id, delete_column, delete_value, exact)
        n_src = source.select(F.lit(True).alias("_sp"), F.lit(None).cast("string").alias("_action"), F.lit(0).cast("long").alias("_hist_n"))
        n_new = first.select(F.lit(False).alias("_sp"), F.lit(NEW).alias("_action"), F.lit(0).cast("long").alias("_hist_n"))
        return stats_from_actions(n_src.unionByName(n_new), "scd2")
    j = scd2_joined(target, source, keys, columns, as_of, batch_id, delete_column, delete_value, exact,
                    with_rows=False)
    return scd2_stats_from_joined(j, target)


def full_refresh_stats(source: DataFrame) -> DataFrame:
    n = source.agg(F.count(F.lit(1)).alias("n"))
    return n.select(
        F.col("n").alias("source_count"),
        F.col("n").alias("inserted"),
        F.lit(0).cast("long").alias("updated"),
        F.lit(0).cast("long").alias("deleted"),
        F.col("n").alias("active_count"),
        F.lit(0).cast("long").alias("historical_count"),
    )
