"""Benchmark the headline queries and jobs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_RUNS=3 BENCH_ONLY=recon_fused,scd2_one_plan python bench.py   # fewer runs / a subset

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query runs fully (noop sink for table states; collect for one-row
summaries and counters); the
time is the median of BENCH_RUNS runs after one warm-up.  ``recon_plain`` is
the plain SQL of the reconciliation (one job per number), kept only as the
comparator for the fused one-plan reconciliation.  The ``job_*`` cases run
whole jobs, tables written; ``written_mb`` holds the bytes that they write.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators import compare as C  # noqa: E402
from tidemark.plans import inputs as I  # noqa: E402
from tidemark.plans import jobs as JB  # noqa: E402
from tidemark.plans import named as N  # noqa: E402
from tidemark.plans import oracle_recon as R  # noqa: E402
from tidemark.sinks import tables as TB  # noqa: E402
from tidemark.session import get_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
DB = "tidemark_bench"


def run_plain(spark, src, tgt, keys, cols):
    """The comparator: the oracle's plain SQL (counts, EXCEPT per side, duplicate
    groups, an inner join of fingerprints), run by Spark."""
    sql = R.reconcile_sql(src, tgt, keys, cols).replace("sha256(", "sha2_256(").replace("round_even(", "bround(")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION sha2_256(x STRING) RETURNS STRING RETURN sha2(x, 256)")
    return spark.sql(sql.replace("AS VARCHAR", "AS STRING")).collect()


def run_noop(df):
    """Run a plan whose output is a table state: nothing comes to the driver."""
    df.write.format("noop").mode("overwrite").save()


def run_collect(df):
    """Run a plan whose output is a handful of rows (a summary, counters)."""
    return df.collect()


def main():
    spark = get_session(
        f"local[{CPUS}]",
        **{
            "spark_sql_shuffle_partitions": str(max(8, 2 * CPUS)),
            "spark_driver_memory": "16g",
            "spark_sql_warehouse_dir": tempfile.mkdtemp(prefix="tidemark-bench-"),
            "spark_ui_enabled": "false",
            "spark_ui_showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB}")
    written = {}

    def plain(pair):
        src, tgt = I.pair_sql(I.SPARK, pair)
        N.I.register_tables(spark, SF_DIR)
        cols = C.compare_columns(spark.sql(src).columns, spark.sql(tgt).columns, I.PAIR_KEYS[pair])
        return lambda: run_plain(spark, src, tgt, I.PAIR_KEYS[pair], cols)

    def size(table):
        files = spark.read.table(table).inputFiles()
        return sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in files) / 1e6

    def load(name, spec, target, source):
        """A load job over a freshly staged target."""
        table = f"{DB}.{name}"

        def run():
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            if target is not None:
                TB.create_table(spark, target(), table)
            t0 = time.perf_counter()
            JB.run_load(spark, {**spec, "target": {"table_name": table}}, source(), I.BATCH_ID, I.AS_OF)
            written[name] = round(size(table), 2)
            return time.perf_counter() - t0

        return run

    def recon_job():
        s, t = N.lineitem_raw_pair(spark, SF_DIR)
        s.createOrReplaceTempView("bench_s")
        t.createOrReplaceTempView("bench_t")
        for x in ("res", "det"):
            spark.sql(f"DROP TABLE IF EXISTS {DB}.{x}")
        cfg = {"name": "li", "source": {"table": "bench_s"}, "target": {"table": "bench_t"}, "keys": N.LI_KEYS}
        t0 = time.perf_counter()
        JB.run_reconciliation(spark, cfg, "b", None, f"{DB}.res", f"{DB}.det")
        written["job_recon_lineitem"] = round(size(f"{DB}.det"), 2)
        return time.perf_counter() - t0

    derive = lambda fn: lambda: I.spark_input(spark, SF_DIR, fn)
    scd2 = {"load_type": "scd2", "scd": {"keys": I.SCD2_KEYS, "columns": I.SCD2_COLUMNS},
            "delete_handling": {"enabled": True, "column": I.SCD2_DELETE[0], "value": I.SCD2_DELETE[1]}}
    recon_plain, recon_plain_lineitem = plain("customer"), plain("lineitem_raw")

    cases = {
        "recon_fused": lambda: run_collect(N.QUERIES["recon_summary"](spark, SF_DIR)),
        "recon_plain": recon_plain,
        "recon_fused_lineitem": lambda: run_collect(N.QUERIES["recon_summary_fanout"](spark, SF_DIR)),
        "recon_plain_lineitem": recon_plain_lineitem,
        "recon_details": lambda: run_collect(N.QUERIES["recon_details"](spark, SF_DIR)),
        "scd2_one_plan": lambda: run_noop(N.QUERIES["scd2_full"](spark, SF_DIR)),
        "scd2_stats": lambda: run_collect(N.QUERIES["load_stats"](spark, SF_DIR)),
        "scd1_upsert": lambda: run_noop(N.QUERIES["scd1_upsert"](spark, SF_DIR)),
        "incremental_keyed": lambda: run_noop(N.QUERIES["incremental_keyed"](spark, SF_DIR)),
        "full_refresh": lambda: run_noop(N.QUERIES["full_refresh"](spark, SF_DIR)),
        "src_customer_360": lambda: run_noop(N.QUERIES["src_customer_360"](spark, SF_DIR)),
        "job_scd2": load("job_scd2", scd2, derive(I.scd2_target_sql), derive(I.scd2_source_sql)),
        "job_scd2_null_keys": load("job_scd2_null_keys", scd2, derive(I.scd2_nullkey_target_sql), derive(I.scd2_nullkey_source_sql)),
        "job_incremental_first": load("job_incremental_first", {"load_type": "incremental", "scd": {"keys": ["event_id"]}}, None, derive(I.events_sql)),
        "job_recon_lineitem": recon_job,
        "src_customer_orders": lambda: run_noop(N.QUERIES["src_customer_orders"](spark, SF_DIR)),
    }
    only = [x for x in os.environ.get("BENCH_ONLY", "").split(",") if x]
    times = {}
    for name, fn in cases.items():
        if only and name not in only:
            continue
        fn()  # warm-up
        samples = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            took = fn()  # a job tells the time without the staging of its target
            samples.append(took if name.startswith("job_") else time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)
    headline = [k for k in times if k not in ("recon_plain", "recon_plain_lineitem")]
    result = {
        "metric": "sum_of_median_seconds_headline_queries",
        "value": round(sum(times[k] for k in headline), 4),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "cpus": CPUS,
        "runs": RUNS,
        "written_mb": written,
    }
    if "recon_plain" in times and "recon_fused" in times:
        result["fused_vs_plain_speedup"] = round(times["recon_plain"] / times["recon_fused"], 2)
    if "recon_plain_lineitem" in times and "recon_fused_lineitem" in times:
        result["fused_vs_plain_speedup_lineitem"] = round(times["recon_plain_lineitem"] / times["recon_fused_lineitem"], 2)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
