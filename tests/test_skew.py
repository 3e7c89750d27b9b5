"""A key that holds a third of all rows, on both sides.

The reference counts mismatches with an inner join, which for this key
alone would form (n/3)^2 pairs.  The key profile counts them from per-hash
row counts instead, so the work stays linear in the input."""

from pyspark.sql import functions as F

from tidemark.operators import compare as C


def test_hot_key_pairs_counted_without_fanout(spark):
    n = 90_000
    ids = spark.range(n)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k")
    val = (F.col("id") % 5).cast("string")
    src = ids.select(key, val.alias("v"))
    tgt = ids.select(key, F.when(F.col("id") % 7 == 0, F.lit("x")).otherwise(val).alias("v"))
    r = C.reconcile(src, tgt, ["k"]).collect()[0]
    hot = n // 3
    # hot key: per-value counts on each side give the equal pairs exactly
    s_counts = {str(v): 0 for v in range(5)}
    t_counts = {**{str(v): 0 for v in range(5)}, "x": 0}
    for i in range(0, n, 3):
        s_counts[str(i % 5)] += 1
        t_counts["x" if i % 7 == 0 else str(i % 5)] += 1
    same = sum(s_counts[v] * t_counts.get(v, 0) for v in s_counts)
    cold_mismatch = sum(1 for i in range(n) if i % 3 != 0 and i % 7 == 0)
    assert r.mismatch_count == hot * hot - same + cold_mismatch
    assert (r.source_duplicates, r.target_duplicates) == (1, 1)
    assert r.mismatch_count > 700_000_000  # pairs an inner join would have had to form (D16: matched < 0)


def test_hot_key_listing_is_one_row(spark):
    n = 30_000
    base = spark.range(n).select(F.lit(7).alias("k"), (F.col("id") % 3).cast("string").alias("v"))
    tgt = base.withColumn("v", F.concat(F.col("v"), F.lit("!")))
    rows = C.mismatches(base, tgt, ["k"], ["v"]).collect()
    assert len(rows) == 1 and rows[0].mismatched_pairs == n * n
    assert (rows[0].source_versions, rows[0].target_versions) == (3, 3)
    assert rows[0].source_hash is None and rows[0].target_hash is None  # several versions: no single hash


def test_null_keys_are_dealt_to_all_tasks(spark):
    """A third of the rows have no key: they never match, so nothing needs
    them in one place."""
    from tidemark.operators import loads as L

    n, parts = 90_000, 8
    rows = spark.range(n).selectExpr("CASE WHEN id % 3 <> 0 THEN id END AS k", "CAST(id AS STRING) AS v")
    guarded = L.guard_unique_keys(rows, ["k"])
    dealt = L._with_spread(rows, ["k"]).repartition(parts, "k", L.SPREAD)
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == parts and max(sizes) < 2 * n / parts
    assert guarded.count() == n
