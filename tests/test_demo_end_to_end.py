"""The reference's demo, end to end: four small tables, the job configs,
results and details tables, then the report queries over them."""

import json
import uuid

from tidemark.operators import reports as RP
from tidemark.plans.entrypoints import compare_table_schemas, reconcile_tables, run_reconciliation
from tidemark.sinks.tables import create_table, table_location
from test_golden import CUST_SCHEMA, PROD, PROD_SCHEMA, SRC, TGT, _frames


def _recon_job(db):
    """Only what this test needs; everything else is left to the defaults."""
    def run(what, target, key, **limits):
        return {"name": f"{what}_recon", "source": {"table": f"{db}.{what}_source"}, "target": {"table": f"{db}.{target}"},
                "keys": [key], "thresholds": limits}

    return {
        "job": {"name": "demo", "batch_id": "b1", "results_table": f"{db}.recon_results", "details_table": f"{db}.recon_details"},
        "reconciliations": [
            run("customer", "customer_target", "customer_id", max_mismatch_percent=5.0),
            run("product", "product_current", "product_id", max_missing_percent=0.5),
        ],
    }


def test_reference_demo(spark):
    db = f"demo_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    cs, ct = _frames(spark, SRC, TGT, CUST_SCHEMA)
    ps, _ = _frames(spark, PROD, PROD, PROD_SCHEMA)
    create_table(spark, cs, f"{db}.customer_source")
    create_table(spark, ct, f"{db}.customer_target")
    create_table(spark, ps, f"{db}.product_source")
    create_table(spark, spark.read.table(f"{db}.product_source"), f"{db}.product_current")  # CTAS copy
    out = run_reconciliation(spark, _recon_job(db))
    assert (out["total"], out["passed"], out["failed"]) == (2, 1, 1)
    runs = {r["recon_name"]: r for r in out["results"]}
    assert runs["customer_recon"]["overall_status"] == "THRESHOLD_BREACHED"
    assert runs["product_recon"]["overall_status"] == "PASSED"

    res = {r.recon_name: r for r in spark.read.table(f"{db}.recon_results").collect()}
    c = res["customer_recon"]
    assert (c.source_count, c.target_count, c.matched_count, c.match_rate) == (4, 4, 2, 50.0)
    assert (c.missing_count, c.extra_count, c.mismatch_count) == (1, 1, 1)
    assert c.status == "FAILED" and c.threshold_breached
    assert c.summary == ("Schema: Schemas are compatible; Data: 2/4 matched; 1 missing in target; "
                         "1 extra in target; 1 mismatched")
    assert res["product_recon"].summary == "Schema: Schemas are compatible; Data: Perfect match: 4/4 records"

    details = spark.read.table(f"{db}.recon_details")
    assert sorted(r.issue_type for r in details.collect()) == ["EXTRA", "MISMATCH", "MISSING"]
    latest = RP.latest_results(spark.read.table(f"{db}.recon_results"), 10).collect()
    assert len(latest) == 2
    counts = RP.issue_counts(details, "2100-01-01").collect()
    assert counts == []

    # running only one reconciliation adds one more result row
    assert run_reconciliation(spark, _recon_job(db), ["customer_recon"])["total"] == 1
    assert spark.read.table(f"{db}.recon_results").count() == 3

    # the components on their own
    summary, issues = reconcile_tables(spark, f"{db}.customer_source", f"{db}.customer_target", ["customer_id"])
    assert summary.collect()[0].match_rate == 50.0 and issues.count() == 3
    sch = compare_table_schemas(spark, f"{db}.customer_source", f"{db}.customer_target")
    assert sch["status"] == "PASSED" and sch["summary"] == "Schemas are compatible"


def _load_job(db, batch):
    history = {"name": "customer_history", "source": {"table": f"{db}.customer"}, "target": {"table_name": f"{db}.customer_target"},
               "scd": {"keys": ["customer_id"], "columns": ["customer_name", "email", "city"]},
               "delete_handling": {"enabled": True, "column": "is_deleted", "value": "Y"}}
    current = {"name": "product_current", "source": {"table": f"{db}.product_source"}, "target": {"table_name": f"{db}.product_current"},
               "load_type": "scd1", "scd": {"keys": ["product_id"], "columns": ["price", "category"]}}
    return {"job": {"name": "demo", "batch_id": batch}, "tables": [history, current]}


def test_reference_load_demo(spark, tmp_path):
    from tidemark.plans.entrypoints import run_scd_job

    db = f"scd_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    cust = spark.createDataFrame([r + ("N",) for r in SRC], CUST_SCHEMA + ", is_deleted string")
    ps, _ = _frames(spark, PROD, PROD, PROD_SCHEMA)
    create_table(spark, cust, f"{db}.customer")
    create_table(spark, ps, f"{db}.product_source")
    path = tmp_path / "scd.yaml"
    path.write_text(json.dumps(_load_job(db, "d1")))  # JSON is YAML
    job = run_scd_job(spark, str(path), as_of="2026-02-22 00:00:00", audit_table=f"{db}.scd_job_audit")
    assert (job["tables_processed"], job["tables_succeeded"], job["tables_failed"]) == (2, 2, 0)
    out = {r["name"]: r for r in job["results"]}
    assert out["customer_history"]["inserted"] == 4 and out["product_current"]["active_count"] == 4

    # next day: Bob moves, David is deleted, Eve arrives; one product changes price
    day2 = [(1, "Alice", "alice@example.com", "LA", "N"), (2, "Bob", "bob@example.com", "NYC", "N"),
            (3, "Charlie", "charlie@example.com", "LA", "N"), (4, "David", "david@example.com", "Chicago", "Y"),
            (5, "Eve", "eve@example.com", "Boston", "N")]
    create_table(spark, spark.createDataFrame(day2, CUST_SCHEMA + ", is_deleted string"), f"{db}.customer_day2")
    spark.sql(f"ALTER TABLE {db}.customer SET LOCATION '{table_location(spark, f'{db}.customer_day2')}'")
    spark.catalog.refreshTable(f"{db}.customer")
    job = run_scd_job(spark, _load_job(db, "d2"), ["customer_history"], as_of="2026-02-23 00:00:00",
                      audit_table=f"{db}.scd_job_audit")
    c = job["results"][0]
    assert (c["inserted"], c["updated"], c["deleted"], c["active_count"], c["historical_count"]) == (1, 1, 1, 4, 2)
    hist = spark.read.table(f"{db}.customer_target")
    assert hist.filter("customer_id = 2").count() == 2 and hist.filter("customer_id = 2 AND is_active = 'Y'").collect()[0].city == "NYC"
    assert hist.filter("customer_id = 4 AND is_active = 'Y'").count() == 0
    audit = spark.read.table(f"{db}.scd_job_audit")
    assert audit.count() == 3 and {r.operation_type for r in audit.collect()} == {"SCD2", "SCD1"}
