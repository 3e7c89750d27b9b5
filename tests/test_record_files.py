"""Files of record tables."""

import pytest

from tidemark.sinks import records as RC
from tidemark.sinks import tables as TB


@pytest.mark.parametrize("days", [False, True])
def test_appended_records_are_packed(spark, tmp_path, days):
    name = f"packed_records_{int(days)}"
    RC.ensure_records(spark, name, RC.DETAILS_SCHEMA, str(tmp_path), days)
    rows = spark.sql("SELECT 'MISSING' AS issue_type, 'k' AS record_keys, 'v' AS source_values, 'w' AS target_values, 'd' AS details")
    rows = RC.details_rows(rows, "r", "n", "b", "2026-02-22 08:00:00")
    rows = rows.select(*[rows[f.name].cast(f.dataType) for f in RC.DETAILS_SCHEMA.fields])
    TB.append_rows(rows.selectExpr("*", "to_date(execution_time) AS execution_day") if days else rows, name, RC.DAY if days else None)
    assert spark.read.table(name).count() == 1
    written = [f.name for f in tmp_path.rglob("*.parquet")]
    assert written and all(".zstd." in f for f in written), written
    spark.sql(f"DROP TABLE {name}")
