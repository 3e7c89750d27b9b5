"""Run every registered query against its DuckDB oracle: python tests/run_oracle.py [sf_dir] [name...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck_connection  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from tidemark.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
if os.environ.get("VANILLA"):
    # the driver's plain session: no settings of ours
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
else:
    spark = get_session("local[8]", **{"spark_sql_shuffle_partitions": "8", "spark_ui_enabled": "false",
                                       "spark_ui_showConsoleProgress": "false"})
spark.sparkContext.setLogLevel("ERROR")
con = duck_connection(sf)
qs, orc = E.queries(), E.oracle_sql()
print("entry rows:", len(E.entry(spark).collect()), flush=True)
bad = 0
for name, fn in qs.items():
    if names and name not in names:
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in orc:
            ok, msg = compare(df, con, orc[name])
        else:
            ok, msg = True, f"no oracle, {df.count()} rows"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name:32s} {time.time() - t:6.2f}s {msg}", flush=True)
print("failures:", bad)
