from tidemark.functions.fingerprint import (
    SEPARATOR,
    all_not_null,
    change_hash_sql,
    keys_equal,
    resolve,
    ts_literal,
)

__all__ = ["SEPARATOR", "all_not_null", "change_hash_sql", "keys_equal", "resolve", "ts_literal"]
