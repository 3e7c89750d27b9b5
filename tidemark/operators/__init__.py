from tidemark.operators.compare import (
    compare_columns,
    duplicate_keys,
    extra_keys,
    issue_rows,
    key_profile,
    mismatches,
    missing_keys,
    null_profile,
    reconcile,
    row_counts,
    with_thresholds,
)

__all__ = [
    "compare_columns",
    "duplicate_keys",
    "extra_keys",
    "issue_rows",
    "key_profile",
    "mismatches",
    "missing_keys",
    "null_profile",
    "reconcile",
    "row_counts",
    "with_thresholds",
]
