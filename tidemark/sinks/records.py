"""Audit, result and detail records, in their declared schemas.

Rows are projections of the one-row statistics / summary DataFrames (so the
numbers never pass through the driver) plus literal metadata columns.
Counts are ``long`` (an int column overflows past 2^31 - 1 rows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fingerprint import ts_literal
from tidemark.sinks.tables import ensure_table

# The schemas of the audit, result and detail tables.
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("operation_type", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("source_record_count", T.LongType()),
        T.StructField("records_inserted", T.LongType()),
        T.StructField("records_updated", T.LongType()),
        T.StructField("records_deleted", T.LongType()),
        T.StructField("total_active_records", T.LongType()),
        T.StructField("total_historical_records", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("execution_user", T.StringType()),
        T.StructField("created_timestamp", T.TimestampType()),
    ]
)

RESULTS_SCHEMA = T.StructType(
    [
        T.StructField("recon_id", T.StringType(), False),
        T.StructField("recon_name", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("execution_time", T.TimestampType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("source_table", T.StringType(), True),
        T.StructField("target_table", T.StringType(), True),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("matched_count", T.LongType()),
        T.StructField("match_rate", T.DoubleType()),
        T.StructField("missing_count", T.LongType()),
        T.StructField("extra_count", T.LongType()),
        T.StructField("mismatch_count", T.LongType()),
        T.StructField("source_duplicates", T.LongType()),
        T.StructField("target_duplicates", T.LongType()),
        T.StructField("schema_status", T.StringType()),
        T.StructField("data_status", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("threshold_breached", T.BooleanType()),
    ]
)

DETAILS_SCHEMA = T.StructType(
    [
        T.StructField("recon_id", T.StringType(), False),
        T.StructField("recon_name", T.StringType(), False),
        T.StructField("batch_id", T.StringType(), False),
        T.StructField("execution_time", T.TimestampType(), False),
        T.StructField("issue_type", T.StringType(), False),
        T.StructField("record_keys", T.StringType()),
        T.StructField("source_values", T.StringType()),
        T.StructField("target_values", T.StringType()),
        T.StructField("details", T.StringType()),
    ]
)

STAT_COLUMNS = {
    "source_record_count": "source_count",
    "records_inserted": "inserted",
    "records_updated": "updated",
    "records_deleted": "deleted",
    "total_active_records": "active_count",
    "total_historical_records": "historical_count",
}


def require_not_null(values: dict, schema: T.StructType) -> None:
    """ValueError for a declared NOT NULL column that would be written NULL."""
    absent = [f.name for f in schema.fields if not f.nullable and f.name in values and values[f.name] is None]
    if absent:
        raise ValueError(f"NOT NULL columns without a value: {absent}")


def _seconds(start, end) -> float | None:
    def parse(v):
        return dt.datetime.fromisoformat(v) if isinstance(v, str) else v

    s, e = parse(start), parse(end)
    if isinstance(s, dt.datetime) and isinstance(e, dt.datetime):
        return (e - s).total_seconds()
    return None


def _lit_str(v) -> Column:
    return F.lit(v).cast("string")


def audit_row(
    stats: DataFrame,
    job_name: str,
    batch_id: str,
    table_name: str,
    operation_type: str,
    start_time,
    end_time,
    status: str,
    error_message: str | None = None,
    user: str | None = None,
    created=None,
) -> DataFrame:
    """One 17-column audit row.  ``stats`` is a one-row frame of the six load
    counters (all 0 for a load that failed)."""
    return stats.select(
        _lit_str(job_name).alias("job_name"),
        _lit_str(batch_id).alias("batch_id"),
        _lit_str(table_name).alias("table_name"),
        _lit_str(operation_type).alias("operation_type"),
        ts_literal(start_time).alias("start_time"),
        ts_literal(end_time).alias("end_time"),
        F.lit(_seconds(start_time, end_time)).cast("double").alias("duration_seconds"),
        *[F.col(src).cast("long").alias(dst) for dst, src in STAT_COLUMNS.items()],
        _lit_str(status).alias("status"),
        _lit_str(error_message).alias("error_message"),
        (_lit_str(user) if user is not None else F.current_user()).alias("execution_user"),
        ts_literal(created if created is not None else end_time).alias("created_timestamp"),
    )


def result_row(
    summary: DataFrame,
    recon_id: str,
    recon_name: str,
    batch_id: str,
    execution_time,
    schema_status: str,
    schema_summary: str,
    duration_seconds: float | None = None,
) -> DataFrame:
    """One results row from a reconcile summary (optionally with thresholds).

    ``status`` is FAILED when the schema or the data check failed, else
    PASSED; a threshold breach is kept in ``threshold_breached``."""
    require_not_null({"recon_id": recon_id, "recon_name": recon_name, "batch_id": batch_id,
                      "execution_time": execution_time}, RESULTS_SCHEMA)
    data_status = F.col("status")
    failed = (F.lit(schema_status) == F.lit("FAILED")) | (data_status == F.lit("FAILED"))
    breached = F.col("threshold_breached") if "threshold_breached" in summary.columns else F.lit(False)
    return summary.select(
        _lit_str(recon_id).alias("recon_id"),
        _lit_str(recon_name).alias("recon_name"),
        _lit_str(batch_id).alias("batch_id"),
        ts_literal(execution_time).alias("execution_time"),
        F.when(failed, F.lit("FAILED")).otherwise(F.lit("PASSED")).alias("status"),
        "source_table",
        "target_table",
        *[
            F.col(c).cast("long").alias(c)
            for c in ("source_count", "target_count", "matched_count")
        ],
        F.col("match_rate").cast("double").alias("match_rate"),
        *[
            F.col(c).cast("long").alias(c)
            for c in ("missing_count", "extra_count", "mismatch_count", "source_duplicates", "target_duplicates")
        ],
        _lit_str(schema_status).alias("schema_status"),
        data_status.alias("data_status"),
        F.concat(F.lit(f"Schema: {schema_summary}; Data: "), F.col("summary")).alias("summary"),
        F.lit(duration_seconds).cast("double").alias("duration_seconds"),
        breached.alias("threshold_breached"),
    )


def skipped_result_row(spark, recon_id, recon_name, batch_id, execution_time, schema_status, schema_summary,
                       source_table, target_table, duration_seconds=None) -> DataFrame:
    """Result row when the data comparison is switched off: counts NULL,
    data status SKIPPED."""
    row = spark.range(1).select(
        F.lit("SKIPPED").alias("status"),
        _lit_str(source_table).alias("source_table"),
        _lit_str(target_table).alias("target_table"),
        *[F.lit(None).cast("long").alias(c) for c in ("source_count", "target_count", "matched_count")],
        F.lit(None).cast("double").alias("match_rate"),
        *[F.lit(None).cast("long").alias(c) for c in ("missing_count", "extra_count", "mismatch_count",
                                                       "source_duplicates", "target_duplicates")],
        F.lit("Data comparison disabled").alias("summary"),
    )
    return result_row(row, recon_id, recon_name, batch_id, execution_time, schema_status, schema_summary,
                      duration_seconds)


def details_rows(issues: DataFrame, recon_id: str, recon_name: str, batch_id: str, execution_time) -> DataFrame:
    """Issue rows (``compare.issue_rows``) under the run's identity."""
    return issues.select(
        _lit_str(recon_id).alias("recon_id"),
        _lit_str(recon_name).alias("recon_name"),
        _lit_str(batch_id).alias("batch_id"),
        ts_literal(execution_time).alias("execution_time"),
        "issue_type",
        "record_keys",
        "source_values",
        "target_values",
        "details",
    )


#: The column that record tables partitioned by day have besides their own.
DAY = "execution_day"


def ensure_records(spark, table: str, schema: T.StructType, root: str | None = None, days: bool = False) -> bool:
    """Makes a record table unless it exists; with ``days`` it is partitioned
    by the day of ``execution_time``, so that a report of some days reads
    their files alone.  Records are packed with zstd: fingerprints in hex take
    half of their letters' space."""
    full = T.StructType([*schema.fields, T.StructField(DAY, T.DateType())]) if days else schema
    return ensure_table(spark, table, full, root, DAY if days else None, compression="zstd")
