"""Reconciliation by digests: rows of key buckets that agree are not shuffled.

Keys are dealt to buckets by a hash.  A bucket's digest is a few numbers that
add up: its rows, sums of pieces of their hashes, and the XOR of the hashes,
source rows counted plus and target rows minus.  They are summed before the
shuffle, so that a task sends a row per bucket, whatever it has read, and a
bucket whose digest is 0 holds the same rows on both sides.  Buckets that
differ are cut finer and digested again; only the rows of buckets that still
differ are shuffled by key, and give the same profile as a reconciliation of
everything (``compare.key_profile``).

Rows that agree can still hold repeated keys, which a reconciliation counts.
So the source's rows in agreeing buckets (the target's are the same) are
grouped by key as well, unless ``unique_keys`` vouches that neither side has
repeated keys.  Then two equal sides exchange nothing but digests.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fingerprint import SEPARATOR, case_sensitive, change_text_sql, column_types, quote
from tidemark.operators import compare as C

#: Buckets, and the parts that a bucket is cut into at each further level.
#: Their product bounds the list of differing buckets, which is broadcast.
LEVELS = (1024, 64)
#: Hashes are summed in pieces of 24 bits: a long holds the sum of 2^39 of them.
PIECES = [(h, shift) for h in ("_h1", "_h2") for shift in (0, 24)]


#: Types whose equal values have equal texts: where both sides have the same one, a
#: digest hashes the values, without rendering them.
PLAIN = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


#: Types of these whose different values have different texts, too, none of them with
#: the sign that a fingerprint's separator is made of, but for strings.  (A time with a
#: zone is not one: its text may stand for two times when clocks go back.)
TOLD = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampNTZType)
BAR = SEPARATOR[0]


def _hashed_sql(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> list[str] | None:
    """What a digest hashes of a row, if that needs no text."""
    kinds = [column_types(df, columns) for df in (source, target)]
    if not columns or any(kinds[0][c] != kinds[1][c] or not isinstance(kinds[0][c], PLAIN) for c in columns):
        return None
    return [e for c in columns for e in (f"{quote(c)} IS NULL", quote(c))]


def _barred_sql(source: DataFrame, columns: Sequence[str], exact: bool) -> str | None:
    """Of plain columns (``_hashed_sql``): whether a row has a text whose place
    among the columns its fingerprint's text may not show (None: this can't be told
    from single rows).

    Without such rows, the texts of two rows are equal where their values are, or
    where both have NULLs and their other values' texts are the same, one by one: a
    text shows how many values it is made of, and exact ones show all."""
    kinds = column_types(source, columns)
    if any(k != T.StringType() and not isinstance(k, TOLD) for k in kinds.values()) or (len(kinds) < 2 and not exact):
        return None
    strings = [] if exact else [quote(c) for c, k in kinds.items() if k == T.StringType()]
    return " OR ".join(f"coalesce(contains({c}, '{BAR}'), false)" for c in strings) or "false"


def _told_sql(df: DataFrame, plain: Sequence[str], columns: Sequence[str], exact: bool) -> list[str]:
    """A fingerprint in two numbers of 64 bits, as a digest has them, where no row
    is barred: of the values and, with NULLs among them, of the text."""
    values, text = ", ".join(plain), change_text_sql(columns, exact, types=column_types(df, columns))
    gap = "false" if exact else " OR ".join(plain[::2])
    hashes = [(f"xxhash64({values})", f"xxhash64({text})"), (f"xxhash64('digest', {', '.join(reversed(plain))})", f"xxhash64('digest', {text})")]
    return [f"CASE WHEN {gap} THEN {b} ELSE {a} END AS _h{i}" for i, (a, b) in enumerate(hashes)]


def _bucketed(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], exact: bool, levels: Sequence[int], told: bool = False
) -> DataFrame:
    """Both sides' rows: keys (``k__x``), ``_text`` (what a fingerprint hashes),
    ``_v0`` and on (what a digest hashes: as equal as the text, or more so),
    ``_side`` (1: source, -1: target), ``_barred`` (``_barred_sql``) and ``_b``, the
    finest bucket.  With ``told``, ``_told_sql`` stands in place of texts and values."""
    text = lambda df: change_text_sql(columns, exact, types=column_types(df, columns)) if columns else "''"
    plain = _hashed_sql(source, target, columns)
    barred = _barred_sql(source, columns, exact) if plain else None
    values = lambda df: [f"{e} AS _v{i}" for i, e in enumerate(plain or [text(df)])]
    whole = lambda df: [f"{text(df)} AS _text", *values(df), f"{barred or 'true'} AS _barred"]
    held = lambda df: _told_sql(df, plain, columns, exact) if told else whole(df)
    sides = [C._keyed(df, keys, *held(df), f"{sign} AS _side") for df, sign in ((source, 1), (target, -1))]
    n = 1
    for k in levels:
        n *= k
    rows = sides[0].unionByName(sides[1])
    return rows.selectExpr("*", f"{C._bucket_sql(keys, n)} AS _b")


def bucket_digests(rows: DataFrame, keys: Sequence[str], bucket: str) -> DataFrame:
    """One row per ``bucket`` (an expression of ``_b``): ``bucket``, whether its
    sides ``differ``, its ``rows``, and whether one of them is ``barred``."""
    kq = ", ".join([f"{k} IS NULL" for k in C._names(keys)] + C._names(keys))
    values = ", ".join(c for c in rows.columns if c.startswith("_v"))
    hashed = rows.selectExpr(f"{bucket} AS bucket", "_side", "_barred", f"xxhash64({kq}, {values}) AS _h1", f"xxhash64({values}, 'digest', {kq}) AS _h2")
    sums = [f"sum(_side * (shiftrightunsigned({h}, {shift}) & 16777215)) AS _s{i}" for i, (h, shift) in enumerate(PIECES)]
    summed = hashed.groupBy("bucket").agg(F.expr("sum(_side) AS _n"), F.expr("count(1) AS rows"), F.expr("bit_xor(_h1) AS _x"), F.expr("bool_or(_barred) AS barred"), *[F.expr(e) for e in sums])
    nought = " AND ".join(f"{c} = 0" for c in ["_n", "_x", *[f"_s{i}" for i in range(len(sums))]])
    return summed.selectExpr("bucket", f"NOT ({nought}) AS differ", "rows", "barred")


def digest_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    exact: bool = False,
    unique_keys: bool = False,
    levels: Sequence[int] = LEVELS,
) -> tuple[DataFrame, str | None]:
    """``compare.side_rows`` of the keys in buckets that differ and, unless
    ``unique_keys``, of those in the others: read from the source, where a row
    stands for one of either side.  With them, ``compare.crowded`` keys.

    The first level's digests reach the driver, a row per bucket.  Where most of
    the buckets differ, finer digests would set hardly a row apart and are left
    out; where all do, or none, each row's side says whether it is read.  The lists
    of differing buckets are bounded by the levels, too."""
    return _digest_rows(source, target, keys, columns, exact, unique_keys, levels)[:2]


def _digest_rows(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], exact: bool, unique_keys: bool, levels: Sequence[int], counted: bool = False
) -> tuple[DataFrame, str | None, int]:
    """``digest_rows``, and how many rows they are at most.

    ``counted`` rows are only to be counted: where values tell as much as their
    text, a fingerprint is two hashes of them (``_told_sql``), not the SHA-256 of
    the text, which takes several times as long to make."""
    rows = _bucketed(source, target, keys, columns, exact, levels)
    total = finer = math.prod(levels)
    finer //= levels[0]
    at = f"(_b div {finer})" if finer > 1 else "_b"
    found = bucket_digests(rows, keys, at).collect()
    inside = C.crowded({d["bucket"]: d["rows"] for d in found}, at.replace("_b", C._bucket_sql(keys, total)))
    fingerprint = ["unhex(sha2(_text, 256)) AS _h" if columns else "CAST(NULL AS BINARY) AS _h"]
    apart, told = rows, counted and bool(columns and found) and not any(d["barred"] for d in found)
    if told:
        rows, fingerprint = _bucketed(source, target, keys, columns, exact, levels, told=True), ["_h0", "_h1"]
    sides, held = ["int(_side = 1) AS _ns", "int(_side = -1) AS _nt"], sum(d["rows"] for d in found)
    differ = [d["bucket"] for d in found if d["differ"]]
    if len(differ) == len(found):
        return rows.selectExpr(*C._names(keys), *fingerprint, *sides), inside, held
    if not differ and not unique_keys:
        return rows.filter("_side = 1").selectExpr(*C._names(keys), *fingerprint, "1 AS _ns", "1 AS _nt"), inside, held // 2
    listed = f"SELECT explode(array({', '.join(f'{b}L' for b in differ)})) AS bucket" if differ else "SELECT 0L AS bucket WHERE false"
    differing = F.broadcast(rows.sparkSession.sql(listed))
    for k in levels[1:] if len(differ) <= len(found) / 2 else []:
        apart = apart.join(differing, F.expr(at) == F.col("bucket"), "left_semi")
        finer //= k
        at = f"(_b div {finer})" if finer > 1 else "_b"
        differing = F.broadcast(bucket_digests(apart, keys, at).filter("differ").select("bucket"))
    on = F.expr(at) == F.col("bucket")
    if not unique_keys:  # a row of the source in buckets that agree stands for the target's, too
        rows, sides[1] = rows.join(differing, on, "left").filter("_side = 1 OR bucket IS NOT NULL"), "int(_side = -1 OR bucket IS NULL) AS _nt"
    else:
        rows = (rows if told else apart).join(differing, on, "left_semi")
    return rows.selectExpr(*C._names(keys), *fingerprint, *sides), inside, held


def digest_counts(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    exact: bool = False,
    unique_keys: bool = False,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """``compare.fingerprint_counts`` of ``digest_rows``."""
    return C.counts_of(digest_rows(source, target, keys, columns, exact, unique_keys, levels)[0], keys)


def reconcile_digest(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    exact: bool = False,
    source_name: str | None = None,
    target_name: str | None = None,
    check_duplicates: bool = True,
    unique_keys: bool = False,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """The one-row summary of ``compare.reconcile``."""
    cols = C.compare_columns(source.columns, target.columns, keys, include, exclude, case_sensitive(source))
    rows, inside, held = _digest_rows(source, target, keys, cols, exact, unique_keys, levels, counted=True)
    counts = C.summary_of_rows(rows, keys, bool(cols), inside, held)
    return C.finish_summary(digest_summary(counts, source, target, unique_keys), cols, source_name, target_name, check_duplicates)


def digest_summary(counts: DataFrame, source: DataFrame, target: DataFrame, unique_keys: bool) -> DataFrame:
    """The numbers of the summary from those of ``digest_rows``; with
    ``unique_keys`` these lack the rows that agree, and the sides are counted by
    themselves."""
    if not unique_keys:
        return counts
    names = [c for c in counts.columns if c not in ("source_count", "target_count")]
    both = counts.selectExpr("CAST(0 AS BIGINT) AS source_count", "CAST(0 AS BIGINT) AS target_count", *names).unionByName(
        C.row_counts(source, target).selectExpr("source_count", "target_count", *[f"CAST(0 AS BIGINT) AS {c}" for c in names])
    )
    return both.agg(*[F.sum(c).alias(c) for c in counts.columns])


def issue_rows_digest(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    include: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    exact: bool = False,
    unique_keys: bool = False,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """The rows of ``compare.issue_rows``."""
    cols = C.compare_columns(source.columns, target.columns, keys, include, exclude, case_sensitive(source))
    rows, inside = digest_rows(source, target, keys, cols, exact, unique_keys, levels)
    if cols:
        return C.issues_of_rows(rows, keys, inside)
    return C.issue_rows_from_profile(C.profile_from_counts(C.counts_of(rows, keys), keys), None, keys)
