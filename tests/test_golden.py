"""The two demo pairs of the reference, with their expected results."""

from tidemark.operators import compare as C
from tidemark.operators.schema_drift import compare_schemas

CUST_SCHEMA = "customer_id int, customer_name string, email string, city string"
SRC = [
    (1, "Alice", "alice@example.com", "LA"),
    (2, "Bob", "bob@example.com", "SF"),
    (3, "Charlie", "charlie@example.com", "LA"),
    (4, "David", "david@example.com", "Chicago"),
]
TGT = [
    (1, "Alice", "alice@example.com", "LA"),
    (2, "Bob", "bob@example.com", "NYC"),
    (3, "Charlie", "charlie@example.com", "LA"),
    (5, "Eve", "eve@example.com", "Boston"),
]
PROD_SCHEMA = "product_id int, product_name string, category string, price decimal(5,2), description string"
PROD = [
    (101, "Laptop", "Electronics", 999.99, "High-performance laptop"),
    (102, "Mouse", "Electronics", 29.99, "Wireless mouse"),
    (103, "Keyboard", "Electronics", 79.99, "Mechanical keyboard"),
    (104, "Monitor", "Electronics", 299.99, "27-inch monitor"),
]


def _frames(spark, rows_a, rows_b, schema):
    from decimal import Decimal

    def fix(rows):
        return [tuple(Decimal(str(v)) if isinstance(v, float) else v for v in r) for r in rows]

    return spark.createDataFrame(fix(rows_a), schema), spark.createDataFrame(fix(rows_b), schema)


def test_customer_pair(spark):
    s, t = _frames(spark, SRC, TGT, CUST_SCHEMA)
    r = C.with_thresholds(
        C.reconcile(s, t, ["customer_id"]), {"max_mismatch_percent": 5.0, "max_missing_percent": 2.0}
    ).collect()[0]
    assert (r.source_count, r.target_count, r.missing_count, r.extra_count, r.mismatch_count) == (4, 4, 1, 1, 1)
    assert (r.source_duplicates, r.target_duplicates, r.matched_count, r.match_rate) == (0, 0, 2, 50.0)
    assert r.status == "FAILED" and r.overall_status == "THRESHOLD_BREACHED" and r.threshold_breached
    assert r.summary == "2/4 matched; 1 missing in target; 1 extra in target; 1 mismatched"
    assert r.columns_compared == "city,customer_name,email"
    assert compare_schemas(s, t)["status"] == "PASSED"


def test_customer_pair_details(spark):
    s, t = _frames(spark, SRC, TGT, CUST_SCHEMA)
    rows = {r.issue_type: r for r in C.issue_rows(s, t, ["customer_id"]).collect()}
    assert set(rows) == {"MISSING", "EXTRA", "MISMATCH"}
    assert rows["MISSING"].record_keys == '{"customer_id":4}' and rows["MISSING"].target_values is None
    assert rows["EXTRA"].record_keys == '{"customer_id":5}' and rows["EXTRA"].source_values is None
    assert rows["MISMATCH"].record_keys == '{"customer_id":2}'
    assert len(rows["MISMATCH"].source_values) == 64 and rows["MISMATCH"].source_values != rows["MISMATCH"].target_values
    assert rows["MISMATCH"].details == "Record values differ between source and target"


def test_product_pair_identical(spark):
    s, t = _frames(spark, PROD, PROD, PROD_SCHEMA)
    r = C.with_thresholds(C.reconcile(s, t, ["product_id"]), {"max_mismatch_percent": 1.0}).collect()[0]
    assert (r.matched_count, r.match_rate, r.status, r.overall_status) == (4, 100.0, "PASSED", "PASSED")
    assert r.summary == "Perfect match: 4/4 records"
    assert C.issue_rows(s, t, ["product_id"]).count() == 0
