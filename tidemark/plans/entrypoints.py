"""Entry points with the reference toolkit's names and parameters.

They take table names (and config dicts or YAML paths) and return
DataFrames, so existing calls keep working:

    run_scd_job(spark, "configs/scd_tables.yaml", ["product_current"])
    run_reconciliation(spark, "configs/recon_config.yaml", ["customer_recon"])
    reconcile_tables(spark, "db.customer_source", "db.customer_target", ["customer_id"])
    compare_table_schemas(spark, "db.customer_source", "db.customer_target")
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import compare as C
from tidemark.operators.schema_drift import compare_schemas
from tidemark.plans.jobs import run_loads, run_reconciliations


def load_config(config) -> dict:
    """A config dict as is, or a YAML file path (needs PyYAML)."""
    if isinstance(config, dict):
        return config
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - depends on the environment
        raise ImportError("reading a YAML path needs PyYAML; pass the parsed dict instead") from e
    with open(config) as f:
        return yaml.safe_load(f)


def run_scd_job(spark: SparkSession, config, table_names: Sequence[str] | None = None, **kw) -> dict:
    """Run the load specs; returns the tally (processed / succeeded / failed)
    plus one result dict per spec (status, error, the six counters)."""
    rows = [r.asDict() for r in run_loads(spark, load_config(config), table_names, **kw).collect()]
    ok = sum(r["status"] == "SUCCESS" for r in rows)
    return {"tables_processed": len(rows), "tables_succeeded": ok, "tables_failed": len(rows) - ok, "results": rows}


def run_reconciliation(spark: SparkSession, config, recon_names: Sequence[str] | None = None, **kw) -> dict:
    """Run the reconciliations; returns job name, batch id, total / passed /
    failed (anything not PASSED is failed) and one result dict per run."""
    cfg = load_config(config)
    rows = [r.asDict() for r in run_reconciliations(spark, cfg, recon_names, **kw).collect()]
    passed = sum(r["overall_status"] == C.PASSED for r in rows)
    job = cfg["job"]
    return {"job_name": job.get("name"), "batch_id": job.get("batch_id"), "total": len(rows), "passed": passed,
            "failed": len(rows) - passed, "results": rows}


def reconcile_tables(
    spark: SparkSession,
    source_table: str,
    target_table: str,
    keys: Sequence[str],
    columns_to_compare: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    sample_size: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(summary row, issue rows) for two catalog tables; ``sample_size`` asks
    for the first so many issues of each type instead of all."""
    s, t = spark.read.table(source_table), spark.read.table(target_table)
    summary = C.reconcile(s, t, keys, columns_to_compare, exclude_columns,
                          source_name=source_table, target_name=target_table)
    issues = C.issue_rows(s, t, keys, columns_to_compare, exclude_columns, sample_size)
    return summary, issues


def compare_table_schemas(spark: SparkSession, source_table: str, target_table: str) -> dict:
    r = compare_schemas(spark.read.table(source_table), spark.read.table(target_table))
    return {**r, "source_table": source_table, "target_table": target_table}
