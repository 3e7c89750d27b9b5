"""Schema comparison (V1-V5), including nullability, which DuckDB cannot oracle."""

from pyspark.sql import types as T

from tidemark.operators import schema_drift as SD


def _df(spark, fields):
    return spark.createDataFrame([], T.StructType(fields))


def test_nullability_is_reported_but_does_not_fail(spark):
    s = _df(spark, [T.StructField("k", T.IntegerType(), False), T.StructField("v", T.StringType(), True)])
    t = _df(spark, [T.StructField("k", T.IntegerType(), True), T.StructField("v", T.StringType(), True)])
    r = SD.compare_schemas(s, t)
    assert r["status"] == "PASSED" and r["nullable_mismatches"] == [("k", False, True)]
    assert r["summary"] == "1 nullable mismatches"
    assert list(SD.schema_issues(s.schema, t.schema)) == [SD.SchemaIssue("k", SD.NULLABLE_MISMATCH, False, True)]


def test_missing_extra_and_type_fail(spark):
    s = _df(spark, [T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType()),
                    T.StructField("Case", T.StringType())])
    t = _df(spark, [T.StructField("a", T.LongType()), T.StructField("case", T.StringType()),
                    T.StructField("c", T.ArrayType(T.StringType(), False))])
    r = SD.compare_schemas(s, t)
    assert r["status"] == "FAILED"
    assert r["missing_in_target"] == ["Case", "b"] and r["extra_in_target"] == ["c", "case"]  # case-sensitive
    assert r["type_mismatches"] == [("a", "IntegerType()", "LongType()")]
    assert r["summary"] == "2 columns missing in target; 2 extra columns in target; 1 type mismatches"
    assert (r["source_column_count"], r["target_column_count"]) == (3, 3)


def test_nested_fields_are_named(spark):
    inner = lambda *f: T.StructType([T.StructField(n, k) for n, k in f])
    s = _df(spark, [T.StructField("a", T.ArrayType(inner(("x", T.LongType()), ("y", T.StringType()))))])
    t = _df(spark, [T.StructField("a", T.ArrayType(inner(("x", T.IntegerType()))))])
    r = SD.compare_schemas(s, t)
    assert r["status"] == "FAILED" and r["summary"] == "1 type mismatches"
    assert [(i.column, i.kind) for i in r["nested_issues"]] == [("a.x", "type_mismatch"), ("a.y", "missing_in_target")]
