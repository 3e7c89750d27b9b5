"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def let_workers_import(spark: SparkSession) -> None:
    """Python workers of this session find this package where the driver found it (an
    installed package, or one sent with the job, needs no help)."""
    home = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if home not in (had := env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))).split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [home, had]))


def map_batches(df: DataFrame, fn, schema) -> DataFrame:
    """mapInPandas() with workers that can import this package, and with nullable longs that
    stay exact: pandas would make them floating point where a batch has a null; here they
    are nullable integers then."""
    let_workers_import(df.sparkSession)
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType) and f.nullable]
    if not longs:
        return df.mapInPandas(fn, schema)
    nulls = sum((F.when(F.col(q(c)).isNull(), 1 << i).otherwise(0) for i, c in enumerate(longs)), F.lit(0))
    filled = [F.coalesce(F.col(q(c)), F.lit(0)).alias(c) if c in longs else F.col(q(c)) for c in df.columns]

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            which = pdf.pop("__nulls").to_numpy()
            for i, c in enumerate(longs):
                if (gone := (which >> i & 1).astype(bool)).any():
                    column = pd.array(pdf[c].to_numpy(), dtype="Int64")
                    column[gone] = pd.NA
                    pdf[c] = column
            yield pdf

    return df.select(*filled, nulls.cast("int").alias("__nulls")).mapInPandas(lambda batches: fn(exact(batches)), schema)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """mapInArrow() with workers that can import this package."""
    let_workers_import(df.sparkSession)
    return df.mapInArrow(fn, schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.  Only a local session may go without
    that setting; it gets a temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        at = spark.conf.get("spark.checkpoint.dir", None)
        if not at and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(at or tempfile.mkdtemp(prefix="tidemark-checkpoints-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder, and forget its lineage.

    A table has its real size.  checkpoint() would keep the planner's estimate, and over
    rounds of joins, each estimated as the product of its sides, that number alone grows
    beyond the driver's memory."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/table-{uuid.uuid4()}"
    df.write.parquet(at, compression=compression)
    out = spark.read.schema(df.schema).parquet(at)
    out._folder = at
    return out


def dropped(table: DataFrame) -> None:
    """Deletes the files of a table that cut() made and that nothing will read again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table._folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_go(spark: SparkSession):
    """Each query's shuffle files go when it ends, and not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if had is None else spark.conf.set(name, had)


def ordered_offsets(df: DataFrame, order: list[str], size: str, out: str) -> DataFrame:
    """Adds ``out``, the sum of ``size`` over all rows that come earlier by ``order``, which
    must tell rows apart: the same however the rows lie in partitions.

    Rows are range-partitioned and materialised, each range is summed in a window, and the
    ranges' totals (one row a partition) give each range its offset."""
    ranged = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    upto = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(size).alias("_s")).select(F.col("_range").alias("_of"), F.coalesce(F.sum("_s").over(upto), F.lit(0)).alias("_s0"))
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn(out, F.coalesce(F.sum(size).over(before), F.lit(0)))
    return summed.join(totals, summed["_range"] == totals["_of"]).withColumn(out, F.col(out) + F.col("_s0")).drop("_range", "_of", "_s0")


def q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def prefix_sums(df: DataFrame, by: list[str], order: list[str], n_rows: int, size: str | None = None, rows_per_bucket: int = 20_000) -> DataFrame:
    """Adds ``_pos`` (gapless from 0 within ``by``) and, with ``size``, ``_before``
    (sum of the sizes of all earlier rows), without a task that holds a whole group.

    Rows are dealt to hash buckets of ``order``; a window runs in each bucket, and the
    bucket totals (one row a bucket) give each bucket its offset.  The order is that of
    (bucket, ``order``): arbitrary but the same in every run.  ``df`` must be
    materialised, and ``order`` must tell its rows apart."""
    buckets = max(1, ceil(n_rows / rows_per_bucket))
    df = df.withColumn("_bucket", F.expr(f"pmod(xxhash64({', '.join(map(q, order))}), {buckets})"))
    w = Window.partitionBy(*by, "_bucket").orderBy(*order)
    total = [F.count(F.lit(1)).alias("_n")] + ([F.sum(size).alias("_s")] if size else [])
    upto = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = df.groupBy(*by, "_bucket").agg(*total).select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        F.col("_bucket").alias("_ob"),
        F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n0"),
        *([F.coalesce(F.sum("_s").over(upto), F.lit(0)).alias("_s0")] if size else []),
    )
    ranked = df.withColumn("_pos", F.row_number().over(w) - 1)
    if size:
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        ranked = ranked.withColumn("_before", F.coalesce(F.sum(size).over(before), F.lit(0)))
    on = ranked["_bucket"] == offsets["_ob"]
    for i, c in enumerate(by):
        on = on & ranked[c].eqNullSafe(offsets[f"_by{i}"])
    out = ranked.join(offsets, on).withColumn("_pos", F.col("_pos") + F.col("_n0"))
    if size:
        out = out.withColumn("_before", F.col("_before") + F.col("_s0"))
    return out.drop("_bucket", "_ob", "_n0", "_s0", *[f"_by{i}" for i in range(len(by))])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long, not null): the smallest node
    that links reach.

    Alternating large-star and small-star rounds: each node's larger, then smaller
    neighbours are linked to the smallest one, until all links are from a node to its
    root; that takes about as many rounds as the logarithm of the longest chain.  A hub's
    neighbours are rows of a join, never one task's list; minima are taken before the
    shuffle."""

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("x").alias("nodes"), F.bit_xor(F.xxhash64("x", "y")).alias("h")).first()

    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    while True:
        # a materialised table of minima, so that a hub's join partition can be split
        both = now.unionByName(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = cut(both.groupBy(F.col("x").alias("_k")).agg(F.min("y").alias("_m")).select("_k", F.least("_k", "_m").alias("_m")))
        large = both.join(low, both["x"] == low["_k"]).where("y > x").select(F.col("y").alias("x"), F.col("_m").alias("y")).distinct()
        large = cut(large)
        made = state(large)
        if made["n"] == made["nodes"] and made == state(now):
            break  # every node has one link, and that is to the smallest of its neighbours' neighbours
        least = large.groupBy(F.col("x").alias("_k")).agg(F.min("y").alias("_m"))
        small = large.join(least, large["x"] == least["_k"]).where("y <> _m").select(F.col("y").alias("x"), F.col("_m").alias("y"))
        now = cut(small.unionByName(least.select(F.col("_k").alias("x"), F.col("_m").alias("y"))).distinct())
    nodes = now.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return nodes.unionByName(now.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())


def cells(members: DataFrame, key: str, id_col: str, per_block: int = 256) -> DataFrame:
    """Deals the members of each ``key`` to cells in which every pair of them meets, once.

    A key's members are cut by a hash of their id into blocks of about ``per_block``; a
    cell holds two blocks (or one, with itself), and a member goes to as many cells as its
    key has blocks.  Adds ``_cell`` and ``_block`` (0 or 1: the cell's first or second);
    keys of one member are left out.  ``members`` must be materialised."""
    sizes = cut(members.groupBy(F.col(key).alias("_ck")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"))
    sized = members.join(sizes, members[key] == sizes["_ck"]).drop("_ck").withColumn("_of", F.ceil(F.col("_n") / per_block).cast("int"))
    mine = sized.withColumn("_b", F.pmod(F.xxhash64(id_col, F.lit("block")), F.col("_of")).cast("int"))
    each = mine.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
    return each.select(
        *members.columns,
        F.xxhash64(key, F.least("_b", "_j"), F.greatest("_b", "_j")).alias("_cell"),
        F.when(F.col("_b") > F.col("_j"), 1).otherwise(0).alias("_block"),
        (F.col("_b") == F.col("_j")).alias("_own"),
    )
