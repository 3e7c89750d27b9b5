"""Reading sources: SQL text, or a catalog table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.tables import finish_replacement

#: How each kind of source is read; SQL text wins where a spec has both.
READERS: dict[str, Callable[[SparkSession, str, dict], DataFrame]] = {
    "sql": lambda spark, text, args: spark.sql(text, args=args) if args else spark.sql(text),
    "table": lambda spark, name, args: spark.read.table(name),
}


def load_source(spark: SparkSession, spec: dict, given: dict | None = None) -> DataFrame:
    """The DataFrame that a source spec names; ValueError for a spec without
    a known kind of source.

    SQL text may hold named markers (``:as_of``): their values are the spec's
    ``args``, over ``given`` (a job's clock and batch), so that a source that
    depends on a clock gives the same rows when its batch runs again."""
    kinds = [kind for kind in READERS if spec.get(kind)]
    if not kinds:
        raise ValueError(f"a source needs one of {sorted(READERS)}, this one has {sorted(spec)}")
    return READERS[kinds[0]](spark, spec[kinds[0]], {**(given or {}), **(spec.get("args") or {})})


def table_exists(spark: SparkSession, name: str) -> bool:
    return finish_replacement(spark, name)


def read_table(spark: SparkSession, name: str) -> DataFrame | None:
    """The table as a DataFrame, or None when it does not exist (first load)."""
    return spark.read.table(name) if table_exists(spark, name) else None
