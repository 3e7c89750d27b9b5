"""The customer profile over rows with repeated and null keys, and what its tasks hold."""


def _sorted(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


def test_customer_360_of_repeated_and_null_keys(spark):
    from tidemark.sources import shapes as X

    c = spark.sql("SELECT * FROM VALUES (1, 'a', 1, 's', 'N'), (1, 'a', 1, 's', 'N'), (2, 'b', 1, 's', 'N'), (3, 'c', 1, 's', 'Y'), "
                  "(CAST(NULL AS INT), 'd', 1, 's', 'N') AS t(c_custkey, c_name, c_nationkey, c_mktsegment, is_deleted)")
    o = spark.sql("SELECT o_orderkey, o_custkey, o_totalprice, TIMESTAMP_NTZ '2001-01-01' AS o_orderdate FROM VALUES (10, 1, 5.5D), (10, 1, 2.5D), "
                  "(11, 1, NULL), (CAST(NULL AS INT), 1, 3.0D), (12, 2, 1.0D), (13, NULL, 1.0D) AS t(o_orderkey, o_custkey, o_totalprice)")
    li = spark.sql("SELECT * FROM VALUES (10, 7), (10, 7), (10, 8), (10, CAST(NULL AS INT)), (11, 9), (CAST(NULL AS INT), 7), (13, 8) AS t(l_orderkey, l_partkey)")
    p = spark.sql("SELECT * FROM VALUES (7), (7), (9), (CAST(NULL AS INT)) AS t(p_partkey)")
    for name, df in (("c", c), ("o", o), ("li", li), ("p", p)):
        df.createOrReplaceTempView(f"t360_{name}")
    plain = spark.sql(
        "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, count(DISTINCT o_orderkey) AS order_count, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS lifetime_value, "
        "count(DISTINCT p_partkey) AS unique_products, max(o_orderdate) AS last_purchase_date FROM t360_c LEFT JOIN t360_o ON c_custkey = o_custkey "
        "LEFT JOIN t360_li ON o_orderkey = l_orderkey LEFT JOIN t360_p ON l_partkey = p_partkey WHERE is_deleted = 'N' GROUP BY ALL"
    )
    got = X.customer_360(c, o, li, p, "2001-08-01")
    assert _sorted(got.select(*plain.columns)) == _sorted(plain)
    plan = got._jdf.queryExecution().executedPlan().toString()
    for group in ("l_orderkey", "o_custkey"):  # groups of orders, parts and lines are sorted, not held in a table
        assert f"SortAggregate(key=[{group}" in plan
    assert " HashAggregate(keys=[l_orderkey" not in plan
