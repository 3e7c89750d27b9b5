"""Derived inputs for the registered queries.

The driver's parquet tables have unique, non-NULL keys and no history, so
the reconciliation and load queries run on inputs derived from them by
fixed rules (see FIXTURES.md part B).  Each rule is written once as SQL text
that Spark and DuckDB both accept; the few spelling differences (timestamp
literals, SHA-256) are filled in per engine.  Spark runs these derivations
over temp views of the parquet files, DuckDB over its pre-registered views,
so the two engines feed identical inputs to the operator under test and
only the operator differs.

All derived inputs scale with the tables they read: every rule is a filter
or projection over whole tables, never a row cap.
"""

from __future__ import annotations

import re
import weakref
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Batch times and ids used by every load query.
T_HIST = "2025-06-01 00:00:00"  # start of closed versions
T0 = "2026-01-01 00:00:00"  # time of the previous load
AS_OF = "2026-02-22 00:00:00"  # time of the load under test
BATCH_PREV = "2026-01-01"
BATCH_ID = "2026-02-22"
ORDERS_END = "2001-08-01"  # last order date in the driver's data
EVENTS_LAST_DAY = "2024-01-30 00:00:00"  # events run 2024-01-01 .. 2024-01-30


@dataclass(frozen=True)
class Dialect:
    name: str

    def ts(self, s: str) -> str:
        return f"to_timestamp_ntz('{s}')" if self.name == "spark" else f"CAST('{s}' AS TIMESTAMP)"

    @property
    def null_ts(self) -> str:
        return "CAST(NULL AS TIMESTAMP_NTZ)" if self.name == "spark" else "CAST(NULL AS TIMESTAMP)"

    def sha(self, expr: str) -> str:
        return f"sha2({expr}, 256)" if self.name == "spark" else f"sha256({expr})"

    def fingerprint(self, cols) -> str:
        return self.sha("concat_ws('||', " + ", ".join(f"CAST({c} AS STRING)" if self.name == "spark" else f"CAST({c} AS VARCHAR)" for c in cols) + ")")

    def date(self, s: str) -> str:
        return f"DATE '{s}'"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


# ---------------------------------------------------------------- B1 / B2: customer pair

def recon_source_sql(d: Dialect) -> str:
    return (
        "SELECT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment "
        "FROM customer"
    )


def recon_target_sql(d: Dialect) -> str:
    s = recon_source_sql(d)
    return f"""
SELECT c_custkey, c_name,
       CASE WHEN c_custkey % 11 = 4 THEN c_nationkey + 1 ELSE c_nationkey END AS c_nationkey,
       c_acctbal,
       CASE WHEN c_custkey % 13 = 5 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
FROM ({s}) s WHERE c_custkey % 17 <> 3
UNION ALL
SELECT c_custkey + 1000000 AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM ({s}) s WHERE c_custkey % 29 = 7
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM ({s}) s WHERE c_custkey % 97 = 10"""


def recon_source_nullkey_sql(d: Dialect) -> str:
    return (
        "SELECT nullif(nullif(c_custkey, 5), 6) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
        f"FROM ({recon_source_sql(d)}) s"
    )


def recon_target_nullkey_sql(d: Dialect) -> str:
    return (
        "SELECT nullif(c_custkey, 5) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment "
        f"FROM ({recon_target_sql(d)}) t"
    )


# ---------------------------------------------------------------- B3: lineitem, composite key

_LI_COLS = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_shipdate"


def lineitem_raw_sql(d: Dialect) -> str:
    return (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity, "
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, "
        "CAST(l_discount AS DECIMAL(18,2)) AS l_discount, l_returnflag, l_shipdate FROM lineitem"
    )


def lineitem_clean_sql(d: Dialect) -> str:
    aggs = ", ".join(f"min({c}) AS {c}" for c in _LI_COLS.split(", "))
    return f"SELECT l_orderkey, l_linenumber, {aggs} FROM ({lineitem_raw_sql(d)}) r GROUP BY l_orderkey, l_linenumber"


def lineitem_perturbed_sql(base_sql: str) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(CASE WHEN (l_orderkey + l_linenumber) % 23 = 5 THEN l_quantity + 1 ELSE l_quantity END
            AS DECIMAL(18,2)) AS l_quantity,
       l_extendedprice,
       CAST(CASE WHEN (l_orderkey + l_linenumber) % 19 = 2 THEN l_discount + 0.01 ELSE l_discount END
            AS DECIMAL(18,2)) AS l_discount,
       l_returnflag, l_shipdate
FROM ({base_sql}) b WHERE (l_orderkey + l_linenumber) % 31 <> 7
UNION ALL
SELECT l_orderkey + 10000000 AS l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_returnflag, l_shipdate
FROM ({base_sql}) b WHERE (l_orderkey + l_linenumber) % 37 = 11"""


# ---------------------------------------------------------------- B4: SCD2 customer history

SCD2_KEYS = ["c_custkey"]
SCD2_COLUMNS = ["c_name", "c_nationkey", "c_mktsegment"]
SCD2_DELETE = ("is_deleted", "Y")


def scd2_target_sql(d: Dialect) -> str:
    fp = d.fingerprint(SCD2_COLUMNS)
    return f"""
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, is_deleted, {fp} AS _hash,
       '{BATCH_PREV}' AS batch_id, {d.ts(T0)} AS effective_start_date, {d.null_ts} AS effective_end_date,
       'Y' AS is_active, {d.ts(T0)} AS updated_timestamp
FROM (SELECT c_custkey, c_name, c_nationkey,
             CASE WHEN c_custkey % 11 = 4 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment,
             'N' AS is_deleted
      FROM customer WHERE c_custkey % 20 <> 1) a
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, is_deleted, {fp} AS _hash,
       'history' AS batch_id, {d.ts(T_HIST)} AS effective_start_date, {d.ts(T0)} AS effective_end_date,
       'N' AS is_active, {d.ts(T0)} AS updated_timestamp
FROM (SELECT c_custkey, c_name, c_nationkey, 'OLD' AS c_mktsegment, 'N' AS is_deleted
      FROM customer WHERE c_custkey % 7 = 2 OR c_custkey % 40 = 1) h"""


def scd2_source_sql(d: Dialect) -> str:
    return """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
       CASE WHEN c_custkey % 31 = 6 THEN 'Y' WHEN c_custkey % 37 = 8 THEN NULL ELSE 'N' END AS is_deleted
FROM customer WHERE c_custkey % 41 <> 9"""


def scd2_first_source_sql(d: Dialect) -> str:
    """Every customer, as a first load sees them."""
    return """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
       CASE WHEN c_custkey % 31 = 6 THEN 'Y' WHEN c_custkey % 37 = 8 THEN NULL ELSE 'N' END AS is_deleted
FROM customer"""


# Loads whose keys and tracked values are NULL in places: a third of the rows
# have a NULL key on both sides (they match nothing), some names are NULL.
def scd2_nullkey_target_sql(d: Dialect) -> str:
    cols = "c_name, c_nationkey, c_mktsegment, is_deleted, _hash, batch_id, effective_start_date, effective_end_date, is_active, updated_timestamp"
    return f"SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS c_custkey, {cols} FROM ({scd2_target_sql(d)}) t"


def scd2_nullkey_source_sql(d: Dialect) -> str:
    return (
        "SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS c_custkey, "
        "CASE WHEN c_custkey % 19 <> 4 THEN c_name END AS c_name, c_nationkey, c_mktsegment, is_deleted "
        f"FROM ({scd2_source_sql(d)}) s"
    )


def scd1_nullkey_target_sql(d: Dialect) -> str:
    return (
        "SELECT CASE WHEN p_partkey % 3 <> 0 THEN p_partkey END AS p_partkey, p_name, "
        "CASE WHEN p_partkey % 17 <> 5 THEN p_brand END AS p_brand, p_type, p_size, p_retailprice, created_at, updated_at "
        f"FROM ({scd1_target_sql(d)}) t"
    )


def scd1_nullkey_source_sql(d: Dialect) -> str:
    return (
        "SELECT CASE WHEN p_partkey % 3 <> 0 THEN p_partkey END AS p_partkey, p_name, p_brand, p_type, "
        f"CASE WHEN p_partkey % 13 <> 7 THEN p_size END AS p_size, p_retailprice FROM ({scd1_source_sql(d)}) s"
    )


# A keyed append whose batch repeats keys and has rows without one.
def events_dup_batch_sql(d: Dialect) -> str:
    return (
        "SELECT CASE WHEN event_id % 5 <> 0 THEN event_id END AS event_id, ts, user_id, event_type, value, props FROM events "
        "UNION ALL SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE event_id % 6 = 1"
    )


# SCD2 and SCD1 on a composite key: the line items, one row a key.
LI_SCD_KEYS = ["l_orderkey", "l_linenumber"]
LI_SCD_COLUMNS = ["l_quantity", "l_returnflag"]


def scd2_line_source_sql(d: Dialect) -> str:
    return f"SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM ({lineitem_clean_sql(d)}) l WHERE (l_orderkey + l_linenumber) % 13 <> 4"


def scd2_line_target_sql(d: Dialect) -> str:
    fp = d.fingerprint(LI_SCD_COLUMNS)
    return f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, {fp} AS _hash, '{BATCH_PREV}' AS batch_id,
       {d.ts(T0)} AS effective_start_date, {d.null_ts} AS effective_end_date, 'Y' AS is_active,
       {d.ts(T0)} AS updated_timestamp
FROM (SELECT l_orderkey, l_linenumber,
             CAST(CASE WHEN (l_orderkey + l_linenumber) % 7 = 2 THEN l_quantity + 1 ELSE l_quantity END AS DECIMAL(18,2))
                 AS l_quantity, l_returnflag
      FROM ({lineitem_clean_sql(d)}) l WHERE (l_orderkey + l_linenumber) % 11 <> 3) a"""


def scd1_line_target_sql(d: Dialect) -> str:
    return f"""
SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, {d.ts(T0)} AS created_at, {d.ts(T0)} AS updated_at
FROM ({scd2_line_target_sql(d)}) t"""


# Events whose times differ only below the millisecond (event_id % 9 = 4).
EV_TIME_COLS = ["event_type", "ts"]


def events_times_sql(d: Dialect) -> str:
    return "SELECT event_id, ts + INTERVAL 123456 MICROSECONDS AS ts, event_type FROM events"


def events_shifted_times_sql(d: Dialect) -> str:
    return (
        "SELECT event_id, ts + CASE WHEN event_id % 9 = 4 THEN INTERVAL 123999 MICROSECONDS "
        "ELSE INTERVAL 123456 MICROSECONDS END AS ts, event_type FROM events"
    )


# SCD2 without a delete flag (X5): part history, four tracked columns.
SCD2P_KEYS = ["p_partkey"]
SCD2P_COLUMNS = ["p_name", "p_brand", "p_type", "p_retailprice"]


def part_source_sql(d: Dialect) -> str:
    return (
        "SELECT p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(18,2)) AS p_retailprice "
        "FROM part"
    )


def scd2_part_target_sql(d: Dialect) -> str:
    fp = d.fingerprint(SCD2P_COLUMNS)
    return f"""
SELECT p_partkey, p_name, p_brand, p_type, p_retailprice, {fp} AS _hash,
       '{BATCH_PREV}' AS batch_id, {d.ts(T0)} AS effective_start_date, {d.null_ts} AS effective_end_date,
       'Y' AS is_active, {d.ts(T0)} AS updated_timestamp
FROM (SELECT p_partkey, p_name, p_brand, p_type,
             CAST(CASE WHEN p_partkey % 13 = 3 THEN p_retailprice + 1 ELSE p_retailprice END AS DECIMAL(18,2))
                 AS p_retailprice
      FROM ({part_source_sql(d)}) p WHERE p_partkey % 9 <> 2) a"""


def scd2_part_source_sql(d: Dialect) -> str:
    return f"SELECT p_partkey, p_name, p_brand, p_type, p_retailprice FROM ({part_source_sql(d)}) p WHERE p_partkey % 11 <> 5"


# ---------------------------------------------------------------- B5: incremental events

def events_sql(d: Dialect) -> str:
    return "SELECT * FROM events"


def events_target_sql(d: Dialect) -> str:
    return "SELECT * FROM events WHERE event_id % 2 = 0"


def events_batch_sql(d: Dialect) -> str:
    return "SELECT * FROM events WHERE event_id % 3 <> 0"


# ---------------------------------------------------------------- B6: SCD1 part

SCD1_KEYS = ["p_partkey"]
SCD1_COLUMNS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def scd1_target_sql(d: Dialect) -> str:
    return f"""
SELECT p_partkey, p_name, p_brand, p_type,
       CASE WHEN p_partkey % 7 = 3 THEN p_size + 1 ELSE p_size END AS p_size,
       p_retailprice, {d.ts(T0)} AS created_at, {d.ts(T0)} AS updated_at
FROM ({part_source_sql(d)}) p WHERE p_partkey % 5 <> 1"""


def scd1_first_source_sql(d: Dialect) -> str:
    return part_source_sql(d)


def scd1_source_sql(d: Dialect) -> str:
    return f"SELECT * FROM ({part_source_sql(d)}) p WHERE p_partkey % 9 <> 4"


# ---------------------------------------------------------------- names that helper columns have
# The inputs of the keyed append, the upsert, the history load and the raw line
# items, with columns called like columns that the operators add on the way.
CLASH_EVENTS = {"event_id": "_spread", "user_id": "_new", "value": "_hit", "event_type": "k__spread", "ts": "_row", "props": "s__ts"}
CLASH_PART = {"p_partkey": "_spread", "p_name": "_sp", "p_brand": "_tp", "p_type": "_action", "p_size": "_row", "p_retailprice": "s__p"}
CLASH_CUSTOMER = {"c_custkey": "_key_rows", "c_name": "_flag", "c_nationkey": "_rows", "c_mktsegment": "_h", "is_deleted": "_sp"}
CLASH_LINE_KEYS = {"l_orderkey": "_h", "l_linenumber": "source_rows"}


def renamed_sql(sql: str, names: dict[str, str], rest: str = "") -> str:
    return f"SELECT {', '.join(f'{a} AS {b}' for a, b in names.items())}{rest} FROM ({sql}) r"


META_REST = ", _hash, batch_id, effective_start_date, effective_end_date, is_active, updated_timestamp"


# ---------------------------------------------------------------- customer with a delete flag (X2, X3)

def customer_flagged_sql(d: Dialect) -> str:
    return (
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "
        "CASE WHEN c_custkey % 31 = 6 THEN 'Y' ELSE 'N' END AS is_deleted FROM customer"
    )


# ---------------------------------------------------------------- Spark side

_HANDLES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table as a DataFrame.  The handle (file listing and
    footer schema) is made once per session and path and then reused, so
    building a query does not list and open the files again."""
    mine, path = _HANDLES.setdefault(spark, {}), f"{sf_dir}/{name}.parquet"
    if path not in mine:
        mine[path] = spark.read.parquet(path)
    return mine[path]


def register_tables(spark: SparkSession, sf_dir: str, tables=TABLES) -> None:
    """Temp views over the driver's parquet files, named like the tables."""
    for t in tables:
        table(spark, sf_dir, t).createOrReplaceTempView(t)


def tables_in(sql: str) -> list[str]:
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


def spark_input(spark: SparkSession, sf_dir: str, sql_fn) -> DataFrame:
    """Run one derivation on Spark over ``sf_dir``.

    ``spark.sql`` resolves the views when it is called, so the returned
    DataFrame stays bound to ``sf_dir`` even if the views are re-pointed.
    """
    sql = sql_fn(SPARK) if callable(sql_fn) else sql_fn
    register_tables(spark, sf_dir, tables_in(sql))
    return spark.sql(sql)


# ---------------------------------------------------------------- B8: result history for the report queries
# Fixed values: (recon_id, recon_name, pair, execution_time, thresholds) of the
# runs whose results and details the report queries read.
CUST_LIMITS = {"max_mismatch_percent": 5.0, "max_missing_percent": 2.0}
LI_LIMITS = {"max_mismatch_percent": 10.0, "max_missing_percent": 5.0}
HISTORY_RUNS = [
    ("r01", "customer_recon", "customer", "2026-02-20 08:00:00", CUST_LIMITS),
    ("r02", "customer_null_keys", "customer_nk", "2026-02-20 08:00:00", CUST_LIMITS),
    ("r03", "lineitem_recon", "lineitem", "2026-02-20 09:30:00", LI_LIMITS),
    ("r04", "customer_recon", "customer_same", "2026-02-21 08:00:00", CUST_LIMITS),
    ("r05", "lineitem_recon", "lineitem_raw", "2026-02-21 10:00:00", LI_LIMITS),
    ("r06", "customer_recon", "customer", "2026-02-22 08:00:00", CUST_LIMITS),
    ("r07", "customer_null_keys", "customer_nk", "2026-02-22 08:00:00", CUST_LIMITS),
    ("r08", "lineitem_recon", "lineitem", "2026-02-22 11:00:00", LI_LIMITS),
]
REPORT_DAY = "2026-02-22"
PAIR_KEYS = {
    "customer": ["c_custkey"],
    "customer_nk": ["c_custkey"],
    "customer_same": ["c_custkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "lineitem_raw": ["l_orderkey", "l_linenumber"],
}
PAIR_NAMES = {
    "customer": ("customer_source", "customer_target"),
    "customer_nk": ("customer_source", "customer_target_nk"),
    "customer_same": ("customer_source", "customer_source"),
    "lineitem": ("lineitem_source", "lineitem_target"),
    "lineitem_raw": ("lineitem_raw", "lineitem_raw_target"),
}


def pair_sql(d: Dialect, pair: str, clean: str | None = None) -> tuple[str, str]:
    """A pair's two sides.  ``clean`` names a table that holds the clean line
    items, in place of working them out in each of the three places where a
    pair of them reads them."""
    if pair == "customer":
        return recon_source_sql(d), recon_target_sql(d)
    if pair == "customer_nk":
        return recon_source_nullkey_sql(d), recon_target_nullkey_sql(d)
    if pair == "customer_same":
        return recon_source_sql(d), recon_source_sql(d)
    cleaned = f"SELECT * FROM {clean}" if clean else lineitem_clean_sql(d)
    base = cleaned if pair == "lineitem" else lineitem_raw_sql(d)
    return base, lineitem_perturbed_sql(base)


AUDIT_START = "2026-02-22 00:00:00"
AUDIT_END = "2026-02-22 00:00:05"
AUDIT_USER = "etl_service"
JOB_NAME = "scd_multi_load_type_job"


def recon_shift_source_sql(d: Dialect) -> str:
    """B1's source with c_mktsegment NULL where c_custkey % 23 = 7."""
    return (
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, "
        "CASE WHEN c_custkey % 23 = 7 THEN NULL ELSE c_mktsegment END AS c_mktsegment "
        f"FROM ({recon_source_sql(d)}) s"
    )


def recon_shift_target_sql(d: Dialect) -> str:
    """The same rows, where % 23 = 7 the name moved into c_mktsegment and
    c_name is NULL: the separator-joined fingerprint cannot see the change."""
    return (
        "SELECT c_custkey, CASE WHEN c_custkey % 23 = 7 THEN NULL ELSE c_name END AS c_name, c_nationkey, "
        "c_acctbal, CASE WHEN c_custkey % 23 = 7 THEN c_name ELSE c_mktsegment END AS c_mktsegment "
        f"FROM ({recon_source_sql(d)}) s"
    )
