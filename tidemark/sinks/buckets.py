"""Table states in key buckets, of which a load rewrites only those it touches.

A state's rows are dealt to buckets by a hash of their keys; each bucket is a
partition directory.  A load finds the buckets of its batch's keys, reads
these from the target, computes their new rows and writes them to new
directories.  The commit makes a new version: a catalog table whose touched
partitions are the new directories and whose other partitions are the old
ones.  The state's own name is a view of the current version, and replacing
that view is the one step that readers see: what fails before it leaves the
old state, and nothing is ever half-applied.

A manifest (a small Parquet file a version: bucket, path, rows, active and
closed rows) holds the places of the buckets and what counters need of the
buckets that a load leaves alone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.fingerprint import quote, sql_string, unused
from tidemark.sinks.tables import delete_path, warehouse

BUCKETS = 64
MANIFEST = "bucket int, path string, rows long, active long, closed long"
#: Where a view keeps what is known of its state.
P_VERSION, P_MANIFEST, P_KEYS, P_BUCKETS, P_COLUMN, P_TAG = (f"tidemark.{x}" for x in ("version", "manifest", "keys", "buckets", "column", "tag"))


def _complete(keys: Sequence[str]) -> str:
    return " AND ".join(f"{quote(k)} IS NOT NULL" for k in keys)


def bucket_sql(keys: Sequence[str], types: dict[str, str], buckets: int) -> str:
    """The bucket of a row with complete keys, as the table types them."""
    typed = ", ".join(f"CAST({quote(k)} AS {types[k]})" for k in keys)
    return f"CAST(pmod(xxhash64({typed}), {buckets}) AS INT)"


def _place_sql(df: DataFrame, keys: Sequence[str], buckets: int, among: Sequence[int]) -> str:
    """Where a row is written: complete keys in their bucket; a row with a NULL
    key, which matches nothing and may lie anywhere, in one of ``among``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    row = ", ".join(quote(c) for c, kind in types.items() if "map<" not in kind)
    spread = f"element_at(array({', '.join(map(str, among))}), CAST(pmod(xxhash64({row}), {len(among)}) AS INT) + 1)"
    return f"CASE WHEN {_complete(keys)} THEN {bucket_sql(keys, types, buckets)} ELSE {spread} END"


class BucketedState:
    """A state as its view and manifest describe it."""

    def __init__(self, spark: SparkSession, name: str, props: dict[str, str]):
        self.spark, self.name = spark, name
        self.version, self.column = props[P_VERSION], props[P_COLUMN]
        self.keys, self.buckets = props[P_KEYS].split("\x1f"), int(props[P_BUCKETS])
        self.manifest_path, self.tag = props[P_MANIFEST], props.get(P_TAG)

    @property
    def manifest(self) -> dict[int, dict]:
        """Its places, one row a bucket."""
        return {r["bucket"]: r.asDict() for r in self.spark.read.schema(MANIFEST).parquet(self.manifest_path).collect()}

    @property
    def types(self) -> dict[str, str]:
        return {f.name: f.dataType.simpleString() for f in self.spark.read.table(self.name).schema.fields}

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of the batch's keys (at most ``buckets`` numbers).  Rows
        with a NULL key go where others do, or, if there are none, to the first."""
        bucket = f"CASE WHEN {_complete(self.keys)} THEN {bucket_sql(self.keys, self.types, self.buckets)} END AS b"
        found = {r["b"] for r in batch.selectExpr(bucket).distinct().collect()}
        return sorted(found - {None}) or [0] * bool(found)

    def read(self, buckets: Sequence[int]) -> DataFrame:
        """The state's rows in these buckets; no other directory is listed or read."""
        columns = [quote(c) for c in self.spark.read.table(self.name).columns]
        return self.spark.read.table(self.version).where(F.col(quote(self.column)).isin(list(buckets))).select(*columns)


def bucketed_state(spark: SparkSession, name: str) -> BucketedState | None:
    """The state behind a view that ``create_state`` made, else None."""
    if not spark.catalog.tableExists(name):
        return None
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    return BucketedState(spark, name, props) if P_VERSION in props else None


def _write(spark: SparkSession, df: DataFrame, at: str, bucket: str, column: str) -> dict[int, dict]:
    """Writes the rows by bucket under ``at``; the manifest rows of the buckets."""
    df.withColumn(column, F.expr(bucket)).write.mode("errorifexists").partitionBy(column).parquet(at)
    written = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(column, T.IntegerType())])).parquet(at)
    flag = "is_active" if "is_active" in df.columns else None
    counts = written.groupBy(column).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(F.col(flag) == "Y") if flag else F.count(F.lit(1))).alias("active"),
        (F.count_if(F.col(flag) == "N") if flag else F.lit(0).cast("long")).alias("closed"),
    )
    return {r[0]: {"bucket": r[0], "path": f"{at}/{column}={r[0]}", "rows": r["rows"], "active": r["active"], "closed": r["closed"]} for r in counts.collect()}


def _commit(spark: SparkSession, name: str, base: str, schema, column: str, keys: Sequence[str], buckets: int, places: dict[int, dict], tag: str | None) -> str:
    """A new version of these places, and the view that shows it."""
    stamp = f"{dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"
    version, manifest = f"{name}__v_{stamp}", f"{base}/manifests/{stamp}"
    spark.createDataFrame([tuple(p[c] for c in ("bucket", "path", "rows", "active", "closed")) for _, p in sorted(places.items())], MANIFEST).coalesce(1).write.parquet(manifest)
    ddl = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {version} ({ddl}, {quote(column)} INT) USING parquet PARTITIONED BY ({quote(column)}) LOCATION {sql_string(f'{base}/versions/{stamp}')}")
    if places:
        parts = " ".join(f"PARTITION ({quote(column)}={b}) LOCATION {sql_string(p['path'])}" for b, p in sorted(places.items()))
        spark.sql(f"ALTER TABLE {version} ADD {parts}")
    props = {P_VERSION: version, P_MANIFEST: manifest, P_KEYS: "\x1f".join(keys), P_BUCKETS: str(buckets), P_COLUMN: column} | ({P_TAG: tag} if tag else {})
    told = ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({told}) AS SELECT {', '.join(quote(f.name) for f in schema.fields)} FROM {version}")
    spark.catalog.refreshTable(name)
    return version


def _base(spark: SparkSession, name: str, root: str | None) -> str:
    return f"{(root or warehouse(spark)).rstrip('/')}/{name.replace('.', '/')}"


def create_state(spark: SparkSession, df: DataFrame, name: str, keys: Sequence[str], buckets: int = BUCKETS, root: str | None = None, tag: str | None = None) -> dict[int, dict]:
    """First load: the rows in their buckets, and the view."""
    base, column = _base(spark, name, root), unused("_bucket", df.columns)
    places = _write(spark, df, f"{base}/data/{uuid.uuid4().hex}", _place_sql(df, keys, buckets, range(buckets)), column)
    _commit(spark, name, base, df.schema, column, keys, buckets, places, tag)
    return places


def replace_buckets(state: BucketedState, rows: DataFrame, touched: Sequence[int], root: str | None = None, tag: str | None = None) -> dict[int, dict]:
    """The state with ``rows`` (which may read it) in place of what the touched
    buckets held; returns all buckets' manifest rows.  A bucket of no rows goes.
    The commit keeps ``tag``, which says what it was made for."""
    spark, base = state.spark, _base(state.spark, state.name, root)
    old, schema = state.manifest, spark.read.table(state.name).schema
    if not touched:
        return old
    named = rows.select(*[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
    new = _write(spark, named, f"{base}/data/{uuid.uuid4().hex}", _place_sql(named, state.keys, state.buckets, touched), state.column)
    if not set(new) <= set(touched):
        raise ValueError(f"rows for buckets {sorted(set(new) - set(touched))} were brought, which the load doesn't rewrite")
    places = {b: p for b, p in old.items() if b not in set(touched)} | new
    _commit(spark, state.name, base, schema, state.column, state.keys, state.buckets, places, tag)
    return places


def versions(spark: SparkSession, name: str) -> list[str]:
    """The state's versions in the catalog, oldest first; the last is current."""
    db, _, table = name.rpartition(".")
    rows = spark.sql(f"SHOW TABLES {'IN ' + db if db else ''} LIKE '{table}__v_*'").collect()
    return sorted(f"{db + '.' if db else ''}{r['tableName']}" for r in rows)


def release_versions(spark: SparkSession, name: str, keep: int = 1, root: str | None = None) -> int:
    """Drops all but the last ``keep`` versions, and deletes the directories
    that no version that stays refers to; returns how many went."""
    state = bucketed_state(spark, name)
    if state is None:
        return 0
    found = [v for v in versions(spark, name) if v != state.version]
    gone, base = found[: max(0, len(found) - (keep - 1))], _base(spark, name, root)
    stay = [v for v in found if v not in gone]
    manifest = lambda v: f"{base}/manifests/{v.rpartition('__v_')[2]}"
    read = lambda path: {r["path"] for r in spark.read.schema(MANIFEST).parquet(path).select("path").collect()}
    live = set().union(read(state.manifest_path), *[read(manifest(v)) for v in stay])
    dead = set().union(*[read(manifest(v)) for v in gone]) - live if gone else set()
    for v in gone:
        spark.sql(f"DROP TABLE IF EXISTS {v}")
        delete_path(spark, manifest(v))
    for path in dead:
        delete_path(spark, path)
    return len(dead)
