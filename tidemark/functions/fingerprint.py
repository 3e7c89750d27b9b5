"""Row fingerprints and change tests.

A fingerprint is the hex SHA-256 of the compared columns, each cast to
string and joined with ``||``.  ``concat_ws`` skips NULLs, so the default
fingerprint cannot tell (a, NULL, b) from (a, b, NULL), nor ('a||b', 'c')
from ('a', 'b||c').  ``exact=True`` hashes each value's string cast behind its length, and a marker
for NULL, so that neither NULLs nor separators can move between columns and
every digit of a value counts.

Everything here returns a ``Column``: the work stays inside whole-stage
codegen, no Python per row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the separator the fingerprint joins columns with.
SEPARATOR = "||"


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def case_sensitive(df: DataFrame) -> bool:
    """Whether the session tells names apart by case."""
    return str(df.sparkSession.conf.get("spark.sql.caseSensitive")).lower() == "true"


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` that the session resolves ``name`` to; ValueError
    when there is none, or more than one."""
    fold = (lambda x: x) if case_sensitive(df) else str.lower
    found = [c for c in df.columns if fold(c) == fold(name)]
    if len(found) != 1:
        raise ValueError(f"column {name!r} is {'ambiguous' if found else 'absent'} among {df.columns}")
    return found[0]


def sql_string(value) -> str:
    """A Python value as a SQL literal (strings escaped, None as NULL)."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return f"CAST({value!r} AS DOUBLE)" if isinstance(value, float) else str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def unused(name: str, columns: Sequence[str]) -> str:
    """``name``, with underscores before it until no column is called that."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def column_types(df: DataFrame, columns: Sequence[str]) -> dict[str, T.DataType]:
    """The types of the columns, under the names they are asked by."""
    return {c: df.schema[resolve(df, c)].dataType for c in columns}


def canonical_sql(ref: str, kind: T.DataType, depth: int = 0) -> str:
    """A value of any type as text that is equal for equal values and differs
    for others: NULL is ``N;``, anything else its length, ``:`` and its text,
    at every level.  Structs are their fields in order, arrays their elements,
    maps their entries by the order of their keys' texts, however they were
    put in."""
    mark = lambda text: f"coalesce(concat(length({text}), ':', {text}), 'N;')"
    x, y = f"x{depth}", f"y{depth}"
    if isinstance(kind, T.StructType):
        fields = [canonical_sql(f"{ref}.{quote(f.name)}", f.dataType, depth) for f in kind.fields] or ["''"]
        return mark(f"CASE WHEN {ref} IS NOT NULL THEN concat({', '.join(fields)}) END")
    if isinstance(kind, T.ArrayType):
        return mark(f"array_join(transform({ref}, {x} -> {canonical_sql(x, kind.elementType, depth + 1)}), '')")
    if isinstance(kind, T.MapType):
        entry = f"{canonical_sql(x, kind.keyType, depth + 1)}, {canonical_sql(y, kind.valueType, depth + 1)}"
        entries = f"map_values(transform_values({ref}, ({x}, {y}) -> concat({entry})))"
        return mark(f"array_join(sort_array({entries}), '')")
    return mark(f"CAST({ref} AS STRING)")


def _text_sql(ref: str, kind: T.DataType | None) -> str:
    """A value's text in a plain fingerprint: its cast, but for types that hold
    a map, whose entries have no order."""
    if kind is not None and "map<" in kind.simpleString():
        return f"CASE WHEN {ref} IS NOT NULL THEN {canonical_sql(ref, kind)} END"
    return f"CAST({ref} AS STRING)"


def change_text_sql(columns: Sequence[str], exact: bool = False, prefix: str | None = None, types: dict[str, T.DataType] | None = None) -> str:
    """What a fingerprint hashes, as SQL text: one expression, parsed once by
    Spark.  ``prefix`` qualifies the names (``"s"`` -> ``s.col``).  With
    ``types``, maps are equal whatever the order of their entries, and an exact
    fingerprint marks lengths and NULLs inside nested values, too."""
    refs = {c: f"{prefix}.{quote(c)}" if prefix else quote(c) for c in columns}
    kind = (types or {}).get
    if exact:
        flat = lambda c: not isinstance(kind(c), T.StructType | T.ArrayType | T.MapType)
        return "concat(" + ", ".join(canonical_sql(r, T.StringType() if flat(c) else kind(c)) for c, r in refs.items()) + ")"
    return "concat_ws('" + SEPARATOR + "', " + ", ".join(_text_sql(r, kind(c)) for c, r in refs.items()) + ")"


def change_hash_sql(columns: Sequence[str], exact: bool = False, prefix: str | None = None, types: dict[str, T.DataType] | None = None) -> str:
    """Hex SHA-256 of ``change_text_sql``."""
    return f"sha2({change_text_sql(columns, exact, prefix, types)}, 256)"


def keys_equal(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Join condition over aliased sides; plain ``=`` never matches NULL keys."""
    cond = None
    for k in keys:
        lc, rc = F.col(f"{left}.{quote(k)}"), F.col(f"{right}.{quote(k)}")
        c = lc.eqNullSafe(rc) if null_safe else (lc == rc)
        cond = c if cond is None else cond & c
    return cond if cond is not None else F.lit(True)


def all_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(quote(k)).isNotNull()
    return cond


def ts_type(value):
    """Spark type of ``ts_literal(value)``."""
    if value is None or (isinstance(value, _dt.datetime) and value.tzinfo is not None):
        return T.TimestampType()
    return T.TimestampNTZType()


def ts_sql(value) -> str:
    """SQL text of ``ts_literal(value)``."""
    if value is None:
        return "current_timestamp()"
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            return f"TIMESTAMP {sql_string(value.isoformat(sep=' '))}"
        value = value.isoformat(sep=" ")
    return f"to_timestamp_ntz({sql_string(str(value))})"


def ts_literal(value) -> Column:
    """A deterministic timestamp literal.

    ``None`` -> ``current_timestamp()`` (one value per query); a string or a
    naive ``datetime`` -> ``timestamp_ntz``; an aware ``datetime`` ->
    ``timestamp`` (LTZ).  Parquet timestamps without zone load as NTZ, so NTZ
    literals keep loads and oracle SQL on one type.
    """
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            return F.lit(value)
        value = value.isoformat(sep=" ")
    return F.to_timestamp_ntz(F.lit(str(value)))
