"""Snapshot commits: a failed write leaves the table as it was; readers see
the old or the new state."""

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import tables as TB


def test_snapshot_swap(spark):
    db = f"tb_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db}")
    name = f"{db}.t"
    TB.create_table(spark, spark.range(3).withColumnRenamed("id", "k"), name)
    before = spark.read.table(name)  # planned against the first snapshot

    # a write that fails mid-way does not move the table
    bad = spark.read.table(name).select(F.when(F.col("k") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("k")).alias("k"))
    with pytest.raises(Exception, match="boom"):
        TB.replace_state(spark, bad, name)
    assert sorted(r.k for r in spark.read.table(name).collect()) == [0, 1, 2]

    # a state computed from the table itself replaces it
    TB.replace_state(spark, spark.read.table(name).select((F.col("k") * 10).alias("k")), name)
    assert sorted(r.k for r in spark.read.table(name).collect()) == [0, 10, 20]
    assert before.count() == 3  # the earlier snapshot is still there for readers that planned on it
