"""Reconciliation of two DataFrames by key.

Every number the reconciliation reports comes out of one *key profile*:

1. both sides are projected to (keys, fingerprint) and tagged with their side;
2. ``groupBy(keys, fingerprint)`` counts rows per side (``n_s``, ``n_t``);
3. ``groupBy(keys)`` sums them to ``N_s``, ``N_t`` and ``sum(n_s * n_t)``.

Both aggregations combine map-side before their exchange, so a key that
holds a third of all rows is collapsed to one partial row per task before
it is shuffled; nothing collects a group into one task.  Grouping treats
NULL as a value, which is the rule for duplicate, missing and extra keys
(EXCEPT semantics).  Value mismatches follow inner-join semantics (NULL keys
never match) and are counted as pairs without forming them:

    pairs(k) = N_s(k) * N_t(k) - sum_h n_s(k, h) * n_t(k, h)

i.e. all source x target pairs of a key minus those whose fingerprints are
equal.  That equals the row count of ``src JOIN tgt ON keys WHERE hash <>
hash`` without the quadratic fan-out on duplicated keys.

The issue listings (missing, extra, duplicates, mismatches) are filters
over the same profile; the summary is one global aggregate over it.

Inside, a key column ``x`` is called ``k__x``, so that no key can be taken for
a helper column, whatever it is called.  Where a result names its keys and a
key is called like one of the result's own columns, that one gets an
underscore.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fingerprint import case_sensitive, change_hash_sql, column_types, quote, sql_string, unused

# Status words and texts of the reconciliation report.
PASSED = "PASSED"
FAILED = "FAILED"
SKIPPED = "SKIPPED"
THRESHOLD_BREACHED = "THRESHOLD_BREACHED"
MISSING = "MISSING"
EXTRA = "EXTRA"
MISMATCH = "MISMATCH"
SOURCE_DUPLICATE = "SOURCE_DUPLICATE"
TARGET_DUPLICATE = "TARGET_DUPLICATE"
TEXT_MISSING = "Record exists in source but not in target"
TEXT_EXTRA = "Record exists in target but not in source"
TEXT_MISMATCH = "Record values differ between source and target"
TEXT_SOURCE_DUPLICATE = "Duplicate key found in source (count: {n})"
TEXT_TARGET_DUPLICATE = "Duplicate key found in target (count: {n})"

# What happens to a column in a comparison.
COMPARED, KEY, ONE_SIDED, NOT_INCLUDED, EXCLUDED, UNKNOWN = (
    "compared",
    "key",
    "one_sided",
    "not_included",
    "excluded",
    "unknown",
)
#: A 64-bit count's largest value: counts of pairs are computed in 38 digits
#: and reported as this when they are larger.
LONG_MAX = 9223372036854775807


def column_decisions(
    source_columns: Iterable[str],
    target_columns: Iterable[str],
    keys: Sequence[str],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    match_case: bool = True,
) -> dict[str, str]:
    """What the comparison does with every name that it is given, and why.

    A name is looked at once, in this order: a key; on one side only (or, when
    it is merely asked for, ``unknown``); excluded; left out of a non-empty
    ``include``; else compared.  ``match_case=False`` takes names that differ
    in case as one, reported as the source spells it."""
    fold = (lambda x: x) if match_case else str.lower
    sides = [{fold(c): c for c in reversed(list(cols))} for cols in (source_columns, target_columns)]
    asked = {fold(c): c for c in [*(include or []), *(exclude or [])]}
    is_key, left_out, wanted = ({fold(c) for c in names or []} for names in (keys, exclude, include))

    def decide(name: str) -> str:
        if name in is_key:
            return KEY
        held = sum(name in side for side in sides)
        if held < 2:
            return ONE_SIDED if held else UNKNOWN
        if name in left_out:
            return EXCLUDED
        return NOT_INCLUDED if wanted and name not in wanted else COMPARED

    spelled = {**asked, **sides[1], **sides[0]}
    return {spelling: decide(name) for name, spelling in spelled.items()}


def compare_columns(
    source_columns: Iterable[str],
    target_columns: Iterable[str],
    keys: Sequence[str],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    match_case: bool = True,
) -> list[str]:
    """The compared columns of ``column_decisions``, sorted."""
    made = column_decisions(source_columns, target_columns, keys, include, exclude, match_case)
    return sorted(name for name, decision in made.items() if decision == COMPARED)


def _fingerprint_sql(df: DataFrame, columns: Sequence[str], exact: bool) -> str:
    # 32 raw bytes instead of 64 hex characters halves what the first exchange moves.
    if not columns:
        return "CAST(NULL AS BINARY)"
    return f"unhex({change_hash_sql(columns, exact=exact, types=column_types(df, columns))})"


KEY_PREFIX = "k__"


def _names(keys: Sequence[str]) -> list[str]:
    """The key columns' names inside a profile, quoted."""
    if not keys:
        raise ValueError("reconciliation needs at least one key column")
    return [quote(KEY_PREFIX + k) for k in keys]


def _keyed(df: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    return df.selectExpr(*[f"{quote(k)} AS {n}" for k, n in zip(keys, _names(keys), strict=True)], *more)


def _out(df: DataFrame, keys: Sequence[str], **more: str) -> DataFrame:
    """The keys under their own names, and further columns by name."""
    own = [f"{n} AS {quote(k)}" for k, n in zip(keys, _names(keys), strict=True)]
    return df.selectExpr(*own, *[f"{expr} AS {quote(unused(name, keys))}" for name, expr in more.items()])


def side_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], exact: bool = False) -> DataFrame:
    """Both sides' rows: key (``k__x``), fingerprint (``_h``, 32 bytes) and how
    many rows of either side each stands for (``_ns``, ``_nt``)."""
    sides = [_keyed(df, keys, f"{_fingerprint_sql(df, columns, exact)} AS _h", f"{s} AS _ns", f"{1 - s} AS _nt") for df, s in ((source, 1), (target, 0))]
    return sides[0].unionByName(sides[1])


def _hashes(rows: DataFrame) -> list[str]:
    """The columns of a fingerprint: its bytes (``_h``), or two numbers."""
    return [c for c in ("_h", "_h0", "_h1") if c in rows.columns]


def counts_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per side of every key and fingerprint."""
    return rows.groupBy(*[F.col(k) for k in _names(keys)], *_hashes(rows)).agg(
        F.expr("CAST(sum(_ns) AS BIGINT) AS _ns"), F.expr("CAST(sum(_nt) AS BIGINT) AS _nt")
    )


def fingerprint_counts(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], exact: bool = False
) -> DataFrame:
    """Rows per side (``_ns``, ``_nt``) of every key (``k__x``) and fingerprint
    (``_h``, 32 bytes)."""
    return counts_of(side_rows(source, target, keys, columns, exact), keys)


# ---------------------------------------------------------------- one exchange by key
#
# Dealt by key, each row is exchanged once, and its key's numbers and issues are
# worked out where it lands.  Keys in buckets that hold far more than their part of
# the rows are left out of that: they are combined before each exchange, by
# fingerprint and then by key (``fingerprint_counts``, ``profile_from_counts``).

#: Key buckets whose rows are counted; a crowded one holds more than one part in
#: CROWD_PART of all rows, and at least CROWD_LEAST.
CROWD_BUCKETS, CROWD_PART, CROWD_LEAST = 4096, 256, 100_000
#: One that holds more than this is crowded, too: without, pairs of rows that have the
#: same key are counted in 64 bits.
CROWD_MOST = 2**31
#: Rows of a task that groups counted rows by key in a table.
TASK_ROWS = 1_000_000


def _bucket_sql(keys: Sequence[str], buckets: int) -> str:
    kq = _names(keys)
    return f"pmod(xxhash64({', '.join([f'{k} IS NULL' for k in kq] + kq)}), {buckets})"


def crowded(rows: dict[int, int], bucket: str) -> str | None:
    """The keys of buckets that hold far more rows than others, as a predicate
    (None: there are none), from the rows of every bucket."""
    most = min(max(CROWD_LEAST, sum(rows.values()) / CROWD_PART), CROWD_MOST)
    found = sorted(b for b, n in rows.items() if n > most)
    return f"{bucket} IN ({', '.join(map(str, found))})" if found else None


def crowded_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> str | None:
    """``crowded`` from one pass over the keys: a task sends a count per bucket,
    and so many reach the driver."""
    bucket = _bucket_sql(keys, CROWD_BUCKETS)
    rows = _keyed(source, keys).unionByName(_keyed(target, keys))
    return crowded(dict(rows.groupBy(F.expr(bucket).alias("_b")).count().collect()), bucket)


def _parted(rows: DataFrame, keys: Sequence[str], inside: str | None, total: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Fingerprint counts of keys that are not crowded, dealt by key, and of
    those that are (``inside``).

    The first hold an aggregate of bytes, so that Spark sorts rows by key and
    fingerprint, and what groups them by key then reads them as they lie: a task
    needs the memory of one sort.  Where no more than ``total`` rows are known to
    come, they are dealt to so many tasks that each can group its own in a table,
    several times as fast, and hold no bytes."""
    kq = [F.col(k) for k in _names(keys)]
    rest = rows.filter(f"NOT ({inside})") if inside else rows
    sums = ["sum(_ns) AS _ns", "sum(_nt) AS _nt"]
    if total is None:
        dealt = rest.repartition(*kq)
        sums.append("max(_h) AS _held")
    else:
        spark, tasks = rows.sparkSession, math.ceil(total / TASK_ROWS)
        many = tasks > min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = rest.repartition(tasks, *kq) if many else rest.repartition(*kq)
    few = dealt.groupBy(*kq, *_hashes(rows)).agg(*[F.expr(e) for e in sums])
    return few, counts_of(rows.filter(inside), keys) if inside else None


def _pairs_sql(a: str, b: str) -> str:
    return f"CAST({a} AS DECIMAL(19,0)) * CAST({b} AS DECIMAL(19,0))"


def _mismatched_sql(keys: Sequence[str], source_rows: str, target_rows: str, same: str) -> str:
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in _names(keys))
    return f"CASE WHEN {keyed} THEN {_pairs_sql(source_rows, target_rows)} - {same} ELSE CAST(0 AS DECIMAL(38,0)) END"


def summary_of_rows(rows: DataFrame, keys: Sequence[str], with_columns: bool, inside: str | None, total: int | None = None) -> DataFrame:
    """The one-row numeric summary of ``side_rows``, no more than ``total`` of
    them, if that is known.  ``inside`` holds all crowded keys: those of the others
    have so few rows that their pairs fit 64 bits."""
    few, many = _parted(rows, keys, inside, total)
    sums = ["sum(_ns) AS source_rows", "sum(_nt) AS target_rows", "sum(_ns * _nt) AS _same"]
    needed = ["source_rows", "target_rows"]
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in _names(keys))
    pairs = f"CASE WHEN {keyed} AND source_rows * target_rows <> _same THEN CAST(source_rows * target_rows - _same AS DECIMAL(38,0)) END"
    if total is None:
        sums.append("max(_held) AS _held")
        # the bytes are looked at, or they and the order that they bring would be left out
        pairs = f"CASE WHEN _held IS NULL OR length(_held) >= 0 THEN {pairs} END"
    prof = few.groupBy(*[F.col(k) for k in _names(keys)]).agg(*[F.expr(e) for e in sums])
    prof = prof.selectExpr(*needed, f"{pairs} AS mismatched_pairs")
    if many is not None:
        sums = [*sums[:2], f"sum({_pairs_sql('_ns', '_nt')}) AS _same"]
        crowds = many.groupBy(*[F.col(k) for k in _names(keys)]).agg(*[F.expr(e) for e in sums])
        prof = prof.unionByName(crowds.selectExpr(*needed, f"{_mismatched_sql(keys, *needed, '_same')} AS mismatched_pairs"))
    return summarize_profile(prof, keys, with_columns)


def issues_of_rows(rows: DataFrame, keys: Sequence[str], inside: str | None, watch: Callable[[DataFrame], DataFrame] = lambda prof: prof) -> DataFrame:
    """``issue_rows`` from ``side_rows``.  ``watch`` sees frames over which
    ``summary_exprs`` are to be observed: together they hold each key's numbers
    once, and NULL in rows beside."""
    few, many = _parted(rows, keys, inside)
    totals = {
        "_N": "sum(_ns)", "_M": "sum(_nt)", "_vs": "count_if(_ns > 0)", "_vt": "count_if(_nt > 0)", "_first": "min(_held)",
        "_hs": "max(CASE WHEN _ns > 0 THEN _held END)", "_ht": "max(CASE WHEN _nt > 0 THEN _held END)",
        "_same": f"sum({_pairs_sql('_ns', '_nt')})",
    }
    few = few.selectExpr("*", *[f"{e} OVER (PARTITION BY {', '.join(_names(keys))}) AS {c}" for c, e in totals.items()])
    few = few.selectExpr("*", f"{_mismatched_sql(keys, '_N', '_M', '_same')} AS _mism")
    once = {
        "source_rows": "_N", "target_rows": "_M", "source_versions": "_vs", "target_versions": "_vt", "mismatched_pairs": "_mism",
        "source_hash": "CASE WHEN _vs = 1 THEN lower(hex(_hs)) END", "target_hash": "CASE WHEN _vt = 1 THEN lower(hex(_ht)) END",
    }
    few = few.selectExpr("*", *[f"CASE WHEN _h <=> _first THEN {e} END AS {c}" for c, e in once.items()])
    wrong, keep = _key_issues(keys, True)
    version = "_mism > 0 AND NOT (_vs = 1 AND _vt = 1) AND ((_ns > 0 AND _M > _nt) OR (_nt > 0 AND _N > _ns))"
    side = lambda n: f"CASE WHEN {n} > 0 THEN lower(hex(_h)) END"
    wrong.append(_issue(version, MISMATCH, _keys_json_sql(keys), side("_ns"), side("_nt"), sql_string(TEXT_MISMATCH)))
    out = watch(few).filter(f"{keep} OR ({version})").selectExpr(f"inline(filter(array({', '.join(wrong)}), x -> x IS NOT NULL))")
    if many is None:
        return out
    prof = profile_from_counts(many, keys)
    return out.unionByName(issue_rows_from_profile(watch(prof), many, keys, totals=prof))


def key_profile(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
    exact: bool = False,
) -> DataFrame:
    """One row per key seen on either side.

    Columns: keys (``k__x``), ``source_rows``, ``target_rows`` and, when ``columns`` is
    given, ``same_pairs`` (source x target pairs with equal fingerprints; 0 for
    NULL keys), ``source_versions`` / ``target_versions`` (distinct
    fingerprints per side), ``source_hash`` / ``target_hash`` (the hex
    fingerprint when the side holds one version of the key, else NULL) and
    ``mismatched_pairs``.  Pairs are counted in 38 digits: a key may hold
    billions of rows on both sides.

    Expressions are handed to Spark as SQL text: each is parsed once on the
    JVM instead of being assembled call by call from Python.
    """
    kq = _names(keys)
    if not columns:
        tagged = _keyed(source, keys, "1 AS _s", "0 AS _t").unionByName(_keyed(target, keys, "0 AS _s", "1 AS _t"))
        return tagged.groupBy(*[F.col(k) for k in kq]).agg(
            F.expr("CAST(sum(_s) AS BIGINT) AS source_rows"), F.expr("CAST(sum(_t) AS BIGINT) AS target_rows")
        )
    return profile_from_counts(fingerprint_counts(source, target, keys, columns, exact), keys)


def profile_from_counts(per_hash: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``key_profile`` from the rows per side of every key and fingerprint."""
    kq = _names(keys)
    # The fingerprint of a side's only version is carried as four 64-bit
    # chunks under XOR: with one version that is the chunk itself, and the
    # fixed-width buffers keep this a hash aggregation.
    chunk = lambda i: f"CAST(conv(hex(substring(_h, {8 * i + 1}, 8)), 16, -10) AS BIGINT)"
    keyed = " AND ".join(f"{k} IS NOT NULL" for k in kq)
    pairs = lambda a, b: f"CAST({a} AS DECIMAL(19,0)) * CAST({b} AS DECIMAL(19,0))"
    parts = [
        "sum(_ns) AS source_rows",
        "sum(_nt) AS target_rows",
        f"sum(CASE WHEN {keyed} THEN {pairs('_ns', '_nt')} ELSE CAST(0 AS DECIMAL(38,0)) END) AS same_pairs",
        "count_if(_ns > 0) AS source_versions",
        "count_if(_nt > 0) AS target_versions",
        *[f"bit_xor(CASE WHEN _ns > 0 THEN {chunk(i)} END) AS _s{i}" for i in range(4)],
        *[f"bit_xor(CASE WHEN _nt > 0 THEN {chunk(i)} END) AS _t{i}" for i in range(4)],
    ]
    prof = per_hash.groupBy(*[F.col(k) for k in kq]).agg(*[F.expr(e) for e in parts])

    def hex_of(side):
        return "lower(concat(" + ", ".join(f"lpad(hex(_{side}{i}), 16, '0')" for i in range(4)) + "))"

    return prof.selectExpr(
        *kq,
        "source_rows",
        "target_rows",
        "same_pairs",
        "source_versions",
        "target_versions",
        f"CASE WHEN source_versions = 1 THEN {hex_of('s')} END AS source_hash",
        f"CASE WHEN target_versions = 1 THEN {hex_of('t')} END AS target_hash",
        f"CASE WHEN {keyed} THEN {pairs('source_rows', 'target_rows')} - same_pairs "
        "ELSE CAST(0 AS DECIMAL(38,0)) END AS mismatched_pairs",
    )


def _as_long(expr: str) -> str:
    return f"CAST(least({expr}, CAST({LONG_MAX} AS DECIMAL(38,0))) AS BIGINT)"


# ---------------------------------------------------------------- issue lists


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (NULL is a key value); column ``cnt``."""
    counts = _keyed(df, keys).groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("_n"))
    return _out(counts.filter("_n > 1"), keys, cnt="_n")


def missing_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct source keys absent from the target (NULL matches NULL)."""
    prof = key_profile(source, target, keys)
    return _out(prof.filter("source_rows > 0 AND target_rows = 0"), keys)


def extra_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct target keys absent from the source (NULL matches NULL)."""
    prof = key_profile(source, target, keys)
    return _out(prof.filter("target_rows > 0 AND source_rows = 0"), keys)


def mismatches(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    exact: bool = False,
) -> DataFrame:
    """Keys present on both sides (non-NULL) whose compared values differ.

    One row per key: keys, ``source_hash``, ``target_hash`` and
    ``mismatched_pairs`` (the number of source x target row pairs with
    different fingerprints; 1 for a key that is unique on both sides).  When a
    side holds several distinct versions of a key its hash is NULL and
    ``source_versions`` / ``target_versions`` say how many there are;
    ``mismatch_versions`` lists them.
    """
    if not columns:
        none = key_profile(source, target, keys).filter(F.lit(False))
        types = {"source_hash": "STRING", "target_hash": "STRING", "mismatched_pairs": "BIGINT",
                 "source_versions": "BIGINT", "target_versions": "BIGINT"}
        return _out(none, keys, **{c: f"CAST(NULL AS {t})" for c, t in types.items()})
    prof = key_profile(source, target, keys, columns, exact).filter("mismatched_pairs > 0")
    same = {c: c for c in ("source_versions", "target_versions")}
    return _out(prof, keys, source_hash="source_hash", target_hash="target_hash", mismatched_pairs=_as_long("mismatched_pairs"), **same)


def _versions_of(per_hash: DataFrame, prof: DataFrame, keys: Sequence[str], only: str) -> DataFrame:
    """Fingerprints of the mismatched keys (``k__x``) in ``prof`` that fulfil
    ``only``, with a differing row on the other side.

    Mismatched keys have no NULL.  They are joined null-safely all the same:
    a plain join would filter NULL keys in this reading of both sides and not
    in the profile's, and the two could not share their first exchange."""
    kq = _names(keys)
    held = [f"_k{i}" for i in range(len(kq))]
    picked = prof.filter(f"mismatched_pairs > 0 AND ({only})").selectExpr(
        *[f"{k} AS {h}" for k, h in zip(kq, held)], "source_rows AS _N", "target_rows AS _M"
    )
    on = " AND ".join(f"{k} <=> {h}" for k, h in zip(kq, held))
    return per_hash.join(picked, F.expr(on)).filter("(_ns > 0 AND _M > _nt) OR (_nt > 0 AND _N > _ns)").selectExpr(
        *kq, "lower(hex(_h)) AS fingerprint", "_ns AS source_rows", "_nt AS target_rows"
    )


def mismatch_versions(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], exact: bool = False
) -> DataFrame:
    """The mismatch relation in linear size: one row per key with mismatched
    pairs and fingerprint that differs from a row of the other side, with the
    number of ``source_rows`` and ``target_rows`` that have it.  Every
    mismatched pair is one of these rows' fingerprints against another's.

    The rows of a key are joined with its totals, never gathered, so that the
    planner can split a hot key."""
    per_hash = fingerprint_counts(source, target, keys, columns, exact)
    found = _versions_of(per_hash, key_profile(source, target, keys, columns, exact), keys, "true")
    return _out(found, keys, **{c: c for c in ("fingerprint", "source_rows", "target_rows")})


def row_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """``source_count``, ``target_count`` in one scan of each side, no join."""
    tagged = source.select(F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    )
    return tagged.agg(
        F.coalesce(F.sum("_s"), F.lit(0)).cast("long").alias("source_count"),
        F.coalesce(F.sum("_t"), F.lit(0)).cast("long").alias("target_count"),
    )


# ---------------------------------------------------------------- summary


def summary_text_sql(matched: str, source_count: str, missing: str, extra: str, mismatch: str) -> str:
    """'Perfect match: m/n records' or 'm/n matched; x missing in target; ...'."""
    ratio = f"CAST({matched} AS STRING), '/', CAST({source_count} AS STRING)"
    issues = (
        f"concat_ws('; ', "
        f"CASE WHEN {missing} > 0 THEN concat(CAST({missing} AS STRING), ' missing in target') END, "
        f"CASE WHEN {extra} > 0 THEN concat(CAST({extra} AS STRING), ' extra in target') END, "
        f"CASE WHEN {mismatch} > 0 THEN concat(CAST({mismatch} AS STRING), ' mismatched') END)"
    )
    return (
        f"CASE WHEN {missing} > 0 OR {extra} > 0 OR {mismatch} > 0 "
        f"THEN concat({ratio}, ' matched; ', {issues}) "
        f"ELSE concat('Perfect match: ', {ratio}, ' records') END"
    )


def match_rate_sql(matched: str, source_count: str) -> str:
    """matched / source * 100, half-even to 2 places; 0.0 for an empty source."""
    return (
        f"CASE WHEN {source_count} > 0 THEN bround(CAST({matched} AS DOUBLE) / CAST({source_count} AS DOUBLE) "
        f"* CAST(100 AS DOUBLE), 2) ELSE CAST(0 AS DOUBLE) END"
    )


SUMMARY_COUNTS = (
    "source_count long, target_count long, missing_count long, extra_count long, mismatch_count long, "
    "source_duplicates long, target_duplicates long"
)


def summary_exprs(with_columns: bool) -> list[str]:
    """The numbers of the summary as aggregates over a key profile."""
    mism = _as_long("coalesce(sum(mismatched_pairs), 0)") if with_columns else "CAST(0 AS BIGINT)"
    return [
        "CAST(coalesce(sum(source_rows), 0) AS BIGINT) AS source_count",
        "CAST(coalesce(sum(target_rows), 0) AS BIGINT) AS target_count",
        "CAST(count_if(source_rows > 0 AND target_rows = 0) AS BIGINT) AS missing_count",
        "CAST(count_if(target_rows > 0 AND source_rows = 0) AS BIGINT) AS extra_count",
        f"{mism} AS mismatch_count",
        "CAST(count_if(source_rows > 1) AS BIGINT) AS source_duplicates",
        "CAST(count_if(target_rows > 1) AS BIGINT) AS target_duplicates",
    ]


def summarize_profile(prof: DataFrame, keys: Sequence[str], with_columns: bool) -> DataFrame:
    """Global aggregate of a key profile -> the one-row numeric summary."""
    return prof.selectExpr(*summary_exprs(with_columns))


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    exact: bool = False,
    source_name: str | None = None,
    target_name: str | None = None,
    check_duplicates: bool = True,
) -> DataFrame:
    """Full reconciliation as one lazy plan -> one summary row.

    Columns: source_table, target_table, source_count, target_count,
    matched_count, match_rate, missing_count, extra_count, mismatch_count,
    source_duplicates, target_duplicates, status, summary, columns_compared.
    """
    cols = compare_columns(source.columns, target.columns, keys, include, exclude, case_sensitive(source))
    prof = key_profile(source, target, keys, cols or None, exact)
    agg = summarize_profile(prof, keys, bool(cols))
    return finish_summary(agg, cols, source_name, target_name, check_duplicates)


def finish_summary(
    agg: DataFrame,
    cols: Sequence[str],
    source_name: str | None = None,
    target_name: str | None = None,
    check_duplicates: bool = True,
) -> DataFrame:
    """Rate, status and summary text from the raw counts.  With
    ``check_duplicates=False`` (the ``duplicate_check: false`` validation)
    the duplicate counts are NULL and do not fail the status."""
    m = "(source_count - missing_count - mismatch_count)"
    if check_duplicates:
        sd, td = "source_duplicates", "target_duplicates"
        dups = "source_duplicates > 0 OR target_duplicates > 0"
    else:
        sd, td, dups = "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)", "false"
    issues = f"{dups} OR missing_count > 0 OR extra_count > 0 OR mismatch_count > 0"
    return agg.selectExpr(
        f"CAST({sql_string(source_name)} AS STRING) AS source_table",
        f"CAST({sql_string(target_name)} AS STRING) AS target_table",
        "source_count",
        "target_count",
        f"CAST({m} AS BIGINT) AS matched_count",
        f"{match_rate_sql(m, 'source_count')} AS match_rate",
        "missing_count",
        "extra_count",
        "mismatch_count",
        f"{sd} AS source_duplicates",
        f"{td} AS target_duplicates",
        f"CASE WHEN {issues} THEN '{FAILED}' ELSE '{PASSED}' END AS status",
        f"{summary_text_sql(m, 'source_count', 'missing_count', 'extra_count', 'mismatch_count')} AS summary",
        f"{sql_string(','.join(cols))} AS columns_compared",
    )


def with_thresholds(summary: DataFrame, thresholds: dict | None = None, schema_status: str | None = None) -> DataFrame:
    """Adds ``threshold_breached`` and ``overall_status``.

    A threshold is breached when the mismatch or missing share of source rows
    is strictly greater than its limit (limits default to 100).  No
    thresholds, or an empty source, is never a breach.  Overall status:
    THRESHOLD_BREACHED over FAILED (schema or data) over PASSED.
    """
    if thresholds is None:
        breached = "false"
    else:
        max_mm = sql_string(float(thresholds.get("max_mismatch_percent", 100)))
        max_miss = sql_string(float(thresholds.get("max_missing_percent", 100)))

        def pct(c):
            return f"CAST({c} AS DOUBLE) / CAST(source_count AS DOUBLE) * CAST(100 AS DOUBLE)"

        breached = (
            f"CASE WHEN source_count > 0 THEN {pct('mismatch_count')} > {max_mm} "
            f"OR {pct('missing_count')} > {max_miss} ELSE false END"
        )
    schema_failed = "false" if schema_status is None else f"({sql_string(schema_status)} = '{FAILED}')"
    return summary.selectExpr(
        "*",
        f"{breached} AS threshold_breached",
        f"CASE WHEN {breached} THEN '{THRESHOLD_BREACHED}' "
        f"WHEN {schema_failed} OR coalesce(status = '{FAILED}', false) THEN '{FAILED}' "
        f"ELSE '{PASSED}' END AS overall_status",
    )


# ---------------------------------------------------------------- issues


def _keys_json_sql(keys: Sequence[str], extra: dict[str, str] | None = None) -> str:
    """The keys (and ``extra``: name -> column) as a JSON object: NULL fields
    kept, times to the microsecond."""
    named = [*((k, KEY_PREFIX + k) for k in keys), *(extra or {}).items()]
    fields = ", ".join(f"{sql_string(n)}, {quote(c)}" for n, c in named)
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    return f"to_json(named_struct({fields}), map({', '.join(sql_string(x) for kv in options.items() for x in kv)}))"


def _issue(when: str, typ: str, rec: str, src_v: str, tgt_v: str, text: str) -> str:
    row = ", ".join(
        f"'{n}', {v}"
        for n, v in (("issue_type", sql_string(typ)), ("record_keys", rec), ("source_values", src_v),
                     ("target_values", tgt_v), ("details", text))
    )
    return f"CASE WHEN {when} THEN named_struct({row}) END"


def _key_issues(keys: Sequence[str], compared: bool) -> tuple[list[str], str]:
    """What can be wrong with a key of a profile, but for rows of several
    versions: each an issue or NULL; and a filter of keys with any of it."""
    kj = _keys_json_sql(keys)
    none = "CAST(NULL AS STRING)"

    def repeated(side, typ, template):
        cnt = f"{side}_rows"
        rec = _keys_json_sql(keys, {"cnt": cnt})
        head, tail = template.split("{n}")
        text = f"concat({sql_string(head)}, CAST({cnt} AS STRING), {sql_string(tail)})"
        return _issue(f"{cnt} > 1", typ, rec, rec if side == "source" else none, none if side == "source" else rec, text)

    wrong = [
        _issue("source_rows > 0 AND target_rows = 0", MISSING, kj, kj, none, sql_string(TEXT_MISSING)),
        _issue("target_rows > 0 AND source_rows = 0", EXTRA, kj, none, kj, sql_string(TEXT_EXTRA)),
        repeated("source", SOURCE_DUPLICATE, TEXT_SOURCE_DUPLICATE),
        repeated("target", TARGET_DUPLICATE, TEXT_TARGET_DUPLICATE),
    ]
    keep = "source_rows <> 1 OR target_rows <> 1"
    if compared:
        wrong.append(_issue("mismatched_pairs > 0 AND source_versions = 1 AND target_versions = 1", MISMATCH, kj, "source_hash",
                            "target_hash", sql_string(TEXT_MISMATCH)))
        keep += " OR mismatched_pairs > 0"
    return wrong, keep


def issue_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    sample_size: int | dict[str, int] | None = None,
    exact: bool = False,
) -> DataFrame:
    """Every issue as a row: issue_type, record_keys, source_values,
    target_values, details.

    A key gives one row for each thing that is wrong with it.  A mismatched key
    with one version on either side is one row with both fingerprints; one with
    several versions is a row per fingerprint, on the side or sides that have
    it.  Keys are rendered with ``to_json`` (NULL fields kept).
    ``sample_size`` asks for the first so many rows of each type in key order
    instead, or of the types that it names."""
    cols = compare_columns(source.columns, target.columns, keys, include, exclude, case_sensitive(source))
    prof = key_profile(source, target, keys, cols or None, exact)
    per_hash = fingerprint_counts(source, target, keys, cols, exact) if cols else None
    return issue_rows_from_profile(prof, per_hash, keys, sample_size)


def issue_rows_from_profile(
    prof: DataFrame,
    per_hash: DataFrame | None,
    keys: Sequence[str],
    sample_size: int | dict[str, int] | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """``issue_rows`` from a key profile and its fingerprint counts (None:
    nothing is compared).  ``totals`` is the profile again, for the rows of
    keys with several versions, where ``prof`` is observed and so may be read
    only once."""
    kq = _names(keys)
    kj = _keys_json_sql(keys)
    wrong, keep = _key_issues(keys, per_hash is not None)
    single = "source_versions = 1 AND target_versions = 1"
    # one pass over the keys with an issue: each gives its rows from one expression
    order = [f"_order{i}" for i in range(len(kq))]
    ordered = [f"{k} AS {o}" for k, o in zip(kq, order)]
    out = prof.filter(keep).selectExpr(*ordered, f"inline(filter(array({', '.join(wrong)}), x -> x IS NOT NULL))")
    if per_hash is not None:
        several = _versions_of(per_hash, prof if totals is None else totals, keys, f"NOT ({single})")
        side = lambda n: f"CASE WHEN {n}_rows > 0 THEN fingerprint END AS {n}_values"
        out = out.unionByName(
            several.selectExpr(*ordered, f"'{MISMATCH}' AS issue_type", f"{kj} AS record_keys", side("source"),
                               side("target"), f"{sql_string(TEXT_MISMATCH)} AS details")
        )
    if sample_size is not None:
        out = _sampled(out, order, sample_size)
    return out.select("issue_type", "record_keys", "source_values", "target_values", "details")


def _sampled(rows: DataFrame, order: Sequence[str], size: int | dict[str, int]) -> DataFrame:
    """The first rows of each issue type in key order: a top-n per task merged
    on one task, never a full sort."""
    types = [MISSING, EXTRA, MISMATCH, SOURCE_DUPLICATE, TARGET_DUPLICATE]
    sizes = size if isinstance(size, dict) else dict.fromkeys(types, size)
    by = [F.col(k).asc_nulls_first() for k in order] + [F.col("source_values").asc_nulls_last(), F.col("target_values")]
    out = rows.filter(~F.col("issue_type").isin(list(sizes)))
    for typ, n in sizes.items():
        out = out.unionByName(rows.filter(F.col("issue_type") == typ).orderBy(*by).limit(int(n)))
    return out


def null_profile(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per common column: NULL counts on each side and their difference.

    The ``null_check`` validation the reference declares but never runs.  One
    aggregate per side (no join); the result has one row per column.
    """
    cols = columns or sorted(set(source.columns) & set(target.columns))

    def counts(df, side):
        row = df.agg(*[F.count_if(F.col(quote(c)).isNull()).alias(c) for c in cols])
        stack = ", ".join(f"{sql_string(c)}, {quote(c)}" for c in cols)
        return row.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, {side}_nulls)")

    s = counts(source, "source")
    t = counts(target, "target")
    # Both sides are one row per column (bounded by the schema width).
    return s.join(t, "column_name").select(
        "column_name",
        F.col("source_nulls").cast("long").alias("source_nulls"),
        F.col("target_nulls").cast("long").alias("target_nulls"),
        (F.col("target_nulls") - F.col("source_nulls")).cast("long").alias("null_difference"),
    )


NULL_DIFFERENCE = "NULL_DIFFERENCE"


def null_difference_rows(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Issue rows (details shape) for columns whose NULL counts differ."""
    prof = null_profile(source, target, columns)
    return prof.filter(F.col("null_difference") != 0).select(
        F.lit(NULL_DIFFERENCE).alias("issue_type"),
        F.to_json(F.struct(F.col("column_name").alias("column"))).alias("record_keys"),
        F.col("source_nulls").cast("string").alias("source_values"),
        F.col("target_nulls").cast("string").alias("target_values"),
        F.concat(F.lit("NULL count differs for column "), F.col("column_name")).alias("details"),
    )
