"""Schema comparison: the gate before a reconciliation.

Schemas are metadata, bounded by the table width and known from the analyzed
plan; no data is read.  The two schemas are laid side by side as one map from
column path to its two fields, nested struct fields included, and each entry
of the map yields its issue, if it has one.  Counts, status and text follow
from the issues.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Issue names, statuses and summary fragments of the schema check.
MISSING_IN_TARGET = "missing_in_target"
EXTRA_IN_TARGET = "extra_in_target"
TYPE_MISMATCH = "type_mismatch"
NULLABLE_MISMATCH = "nullable_mismatch"
COMPATIBLE = "Schemas are compatible"
PASSED, FAILED = "PASSED", "FAILED"
TEXTS = {
    MISSING_IN_TARGET: "{n} columns missing in target",
    EXTRA_IN_TARGET: "{n} extra columns in target",
    TYPE_MISMATCH: "{n} type mismatches",
    NULLABLE_MISMATCH: "{n} nullable mismatches",
}


@dataclass(frozen=True)
class SchemaIssue:
    """One difference; a nested field's column is its path (``a.b``)."""

    column: str
    kind: str
    source_value: object = None
    target_value: object = None


def _struct(dtype: T.DataType) -> T.StructType | None:
    """The struct inside a column type: itself, or an array's elements."""
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype if isinstance(dtype, T.StructType) else None


def schema_issues(source: T.StructType, target: T.StructType, path: str = "") -> Iterator[SchemaIssue]:
    """The differences in order of name (case-sensitive, positions ignored).
    A column whose type differs is one issue; when both sides are structs the
    fields that make them differ follow under it."""
    pairs: dict[str, list] = {}
    for side, schema in enumerate((source, target)):
        for field in schema.fields:
            pairs.setdefault(field.name, [None, None])[side] = field
    for name, (s, t) in sorted(pairs.items()):
        column = path + name
        if s is None or t is None:
            yield SchemaIssue(column, EXTRA_IN_TARGET if s is None else MISSING_IN_TARGET)
            continue
        if str(s.dataType) != str(t.dataType):
            yield SchemaIssue(column, TYPE_MISMATCH, str(s.dataType), str(t.dataType))
            if (a := _struct(s.dataType)) and (b := _struct(t.dataType)):
                yield from schema_issues(a, b, column + ".")
        if s.nullable != t.nullable:
            yield SchemaIssue(column, NULLABLE_MISMATCH, s.nullable, t.nullable)


def compare_schemas(source: DataFrame, target: DataFrame) -> dict:
    """Status, counts, the columns by kind of issue, and a summary text.

    Status is FAILED on missing, extra or differing types; nullability alone
    does not fail.  The lists and counts are of top-level columns;
    ``nested_issues`` holds what was found inside structs."""
    issues = list(schema_issues(source.schema, target.schema))
    top = [i for i in issues if i.column in source.columns or i.column in target.columns]
    kinds = {kind: [i for i in top if i.kind == kind] for kind in TEXTS}
    said = [text.format(n=len(kinds[kind])) for kind, text in TEXTS.items() if kinds[kind]]
    values = lambda kind: [(i.column, i.source_value, i.target_value) for i in kinds[kind]]
    return {
        "status": FAILED if any(i.kind != NULLABLE_MISMATCH for i in top) else PASSED,
        "source_column_count": len(source.columns),
        "target_column_count": len(target.columns),
        "common_columns": sorted(set(source.columns).intersection(target.columns)),
        "missing_in_target": [i.column for i in kinds[MISSING_IN_TARGET]],
        "extra_in_target": [i.column for i in kinds[EXTRA_IN_TARGET]],
        "type_mismatches": values(TYPE_MISMATCH),
        "nullable_mismatches": values(NULLABLE_MISMATCH),
        "nested_issues": [i for i in issues if i not in top],
        "summary": "; ".join(said) or COMPATIBLE,
    }
