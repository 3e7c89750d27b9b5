"""Writing table states.

Parquet tables have no MERGE, and a plan may not overwrite the files it
reads.  A new state is therefore written to a fresh snapshot directory and
the table is re-pointed at it (``ALTER TABLE ... SET LOCATION``), which is
the commit: readers see the old or the new state, never a half-written
one, and a failed write leaves the table untouched.  Earlier snapshots stay
on storage until ``release_snapshots`` removes them.  Appends (incremental
loads) add files in place; ``append_once`` does so at most once a tag.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fingerprint import quote, sql_string

DEFAULT_FORMAT = "parquet"
#: What an entry is called while it replaces another.
INCOMING = "__incoming"


def warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def table_location(spark: SparkSession, name: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _snapshot_path(spark: SparkSession, name: str, root: str | None, tag: str | None = None) -> str:
    base = (root or warehouse(spark)).rstrip("/")
    stamp = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"{base}/{name.replace('.', '/')}/snapshot={stamp}-{uuid.uuid4().hex[:8]}{_mark(tag)}"


def _mark(tag: str | None) -> str:
    return "-" + hashlib.sha256(tag.encode()).hexdigest()[:32] if tag else ""


def state_is_of(spark: SparkSession, name: str, tag: str) -> bool:
    """Whether the table's current snapshot was written for ``tag``: the
    snapshot's name says so, and pointing the table at it is the commit."""
    return (table_location(spark, name) or "").rstrip("/").endswith(_mark(tag))


def _layout(df: DataFrame, fmt: str, cluster: tuple[int, Sequence[str]] | None):
    """A writer of ``df``, bucketed and sorted by ``cluster`` (number, columns)."""
    writer = df.write.format(fmt)
    return writer.bucketBy(cluster[0], *cluster[1]).sortBy(*cluster[1]) if cluster else writer


def create_table(
    spark: SparkSession, df: DataFrame, name: str, root: str | None = None, fmt: str = DEFAULT_FORMAT,
    cluster: tuple[int, Sequence[str]] | None = None, tag: str | None = None, compression: str | None = None,
) -> str:
    """First load: an external table over a first snapshot directory.
    Fails when the table exists (the default save mode).  With ``cluster`` (a
    number and columns) its files are bucketed and sorted by these columns, and
    so is every later snapshot: a join on them reads the table as it lies."""
    path = _snapshot_path(spark, name, root, tag)
    _packed(_layout(df, fmt, cluster), compression).option("path", path).saveAsTable(name)
    return path


def _packed(writer, compression: str | None):
    """``writer``, of files in that codec, where one is given: a table's option,
    which later appends keep."""
    return writer.option("compression", compression) if compression else writer


def clustering(spark: SparkSession, name: str) -> tuple[int, list[str]] | None:
    """The buckets and columns that a table's files are clustered by."""
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if not (n := info.get("Num Buckets", "")).isdigit():
        return None
    return int(n), [c.strip().strip("`") for c in info["Bucket Columns"].strip("[]").split(",")]


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.delete(p, True)


def _listed(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(x.getPath().toString() for x in fs.listStatus(p)) if fs.exists(p) else []


def _tagged(location: str, kind: str, tag: str) -> str:
    """A path of the table's own that readers of it pass over."""
    return f"{location}/_{kind}/{hashlib.sha256(tag.encode()).hexdigest()[:32]}"


def applied(spark: SparkSession, name: str, tag: str) -> bool:
    """Whether ``append_once`` has finished this tag."""
    fs, p = file_system(spark, _tagged(table_location(spark, name), "applied", tag))
    return fs.exists(p)


def append_once(spark: SparkSession, df: DataFrame, name: str, tag: str, on_write: Callable[[], None] | None = None) -> bool:
    """Append by column name, at most once for ``tag``; False if it was done before.

    Rows are written beside the table's files first.  When all are there, the
    files are moved into the table under names that follow from the tag, and
    a mark is left.  A run that dies while it writes leaves nothing that
    readers see; one that dies while files move is finished by the next run
    with the same tag, from what was written.  ``on_write`` is called where
    the rows are read and written."""
    if applied(spark, name, tag):
        return False
    at = table_location(spark, name)
    staged, mark = _tagged(at, "staged", tag), _tagged(at, "applied", tag)
    fs, ready = file_system(spark, f"{staged}/_SUCCESS")
    if not fs.exists(ready):
        columns = [quote(c) for c in spark.read.table(name).columns]
        df.select(*columns).write.mode("overwrite").parquet(staged)
        if on_write is not None:
            on_write()
    for path in _listed(spark, staged):
        base = path.rpartition("/")[2]
        if base.startswith("part-"):
            _, target = file_system(spark, f"{at}/part-{mark.rpartition('/')[2]}-{base[5:]}")
            _, source = file_system(spark, path)
            if not fs.rename(source, target):
                raise OSError(f"could not move {path} into {name}")
    _, done = file_system(spark, mark)
    fs.mkdirs(done.getParent())
    fs.create(done, True).close()
    delete_path(spark, staged)
    spark.catalog.refreshTable(name)
    return True


def snapshots(spark: SparkSession, name: str, root: str | None = None) -> list[str]:
    """The snapshot directories of a table, oldest first."""
    folder = _snapshot_path(spark, name, root).rpartition("/")[0]
    return [p for p in _listed(spark, folder) if p.rpartition("/")[2].startswith("snapshot=")]


def read_snapshot(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A table as it was in one of its snapshots."""
    return spark.read.format(fmt).load(path)


def release_snapshots(spark: SparkSession, name: str, keep: int = 2, root: str | None = None) -> list[str]:
    """Deletes all but the last ``keep`` snapshots, never the current one;
    returns those that went."""
    fs, now = file_system(spark, table_location(spark, name))
    current = fs.makeQualified(now).toString()
    old = [p for p in snapshots(spark, name, root) if fs.makeQualified(file_system(spark, p)[1]).toString() != current]
    gone = old[: max(0, len(old) - (keep - 1))]
    for path in gone:
        delete_path(spark, path)
    return gone


def append_rows(df: DataFrame, name: str, partition: str | None = None) -> None:
    """Append by column name; ``partition`` is the column that the table is
    partitioned by, if it is."""
    writer = df.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).saveAsTable(name)


def replace_state(spark: SparkSession, df: DataFrame, name: str, root: str | None = None, fmt: str = DEFAULT_FORMAT, tag: str | None = None) -> str:
    """Write ``df`` (which may read ``name``) as a new snapshot, then swap."""
    path, cluster = _snapshot_path(spark, name, root, tag), clustering(spark, name)
    if cluster:  # only a table can be written in buckets: an entry that goes again, its files stay
        written = f"{name}__writing_{uuid.uuid4().hex[:8]}"
        _layout(df, fmt, cluster).option("path", path).saveAsTable(written)
        drop_table(spark, written)
    else:
        df.write.format(fmt).mode("errorifexists").save(path)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return path


def create_typed(spark: SparkSession, name: str, columns: dict[str, str], fmt: str = DEFAULT_FORMAT) -> None:
    """An empty table with the declared column types, unless it exists."""
    ddl = ", ".join(f"{quote(c)} {kind}" for c, kind in columns.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING {fmt}")


def insert_values(spark: SparkSession, name: str, rows: Sequence[Sequence]) -> None:
    """INSERT INTO ... VALUES: literal rows, cast to the table's types."""
    if rows:
        target = spark.read.table(name)
        values = ", ".join("(" + ", ".join(sql_string(v) for v in row) + ")" for row in rows)
        typed = ", ".join(f"CAST(col{i + 1} AS {f.dataType.simpleString()}) AS {quote(f.name)}" for i, f in enumerate(target.schema.fields))
        append_rows(spark.sql(f"SELECT {typed} FROM VALUES {values}"), name)


def replace_table_as(spark: SparkSession, df: DataFrame, name: str, root: str | None = None, fmt: str = DEFAULT_FORMAT) -> str:
    """CREATE OR REPLACE TABLE ... AS: the table, of whatever columns it had,
    becomes ``df`` (which may read it).  The new files are written first; then
    the name moves to them: in one step where the columns stay as they are,
    else an entry for them is made, the old one dropped and the new one renamed.
    A run that dies between these steps is finished by ``finish_replacement``,
    which whatever opens a table through this library calls."""
    if not finish_replacement(spark, name):
        return create_table(spark, df, name, root, fmt)
    had = [(f.name, f.dataType) for f in spark.read.table(name).schema.fields]
    if had == [(f.name, f.dataType) for f in df.schema.fields]:
        return replace_state(spark, df, name, root, fmt)
    path = _snapshot_path(spark, name, root)
    df.write.format(fmt).mode("errorifexists").save(path)
    drop_table(spark, name + INCOMING)
    spark.catalog.createTable(name + INCOMING, path=path, source=fmt)
    drop_table(spark, name)
    finish_replacement(spark, name)
    return path


def finish_replacement(spark: SparkSession, name: str) -> bool:
    """Whether the table exists; a replacement that was interrupted after its
    new entry was complete and the old one gone is finished first."""
    if spark.catalog.tableExists(name):
        return True
    if not spark.catalog.tableExists(name + INCOMING):
        return False
    spark.sql(f"ALTER TABLE {name + INCOMING} RENAME TO {name}")
    return True


def drop_table(spark: SparkSession, name: str) -> None:
    """DROP TABLE IF EXISTS."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def commit_state(
    spark: SparkSession, df: DataFrame, name: str, exists: bool, root: str | None = None, tag: str | None = None,
    cluster: tuple[int, Sequence[str]] | None = None,
) -> str:
    return replace_state(spark, df, name, root, tag=tag) if exists else create_table(spark, df, name, root, cluster=cluster, tag=tag)


def ensure_table(
    spark: SparkSession, name: str, schema, root: str | None = None, partition: str | None = None, compression: str | None = None
) -> bool:
    """Create an empty table with ``schema``, partitioned by one of its columns
    if one is named, unless it exists; True if created."""
    if finish_replacement(spark, name):
        return False
    empty = spark.createDataFrame([], schema)
    if partition:
        writer = _packed(empty.write.format(DEFAULT_FORMAT).partitionBy(partition), compression)
        writer.option("path", _snapshot_path(spark, name, root)).saveAsTable(name)
    else:
        create_table(spark, empty, name, root, compression=compression)
    return True


def compact_partition(spark: SparkSession, name: str, column: str, value, root: str | None = None, files: int = 1) -> None:
    """One partition's rows in so many files: written anew beside the others,
    then the partition is pointed at them, which is the commit."""
    part = spark.read.table(name).filter(F.col(column) == F.lit(value)).drop(column)
    path = f"{_snapshot_path(spark, name, root)}/{column}={value}"
    part.coalesce(files).write.format(DEFAULT_FORMAT).save(path)
    spark.sql(f"ALTER TABLE {name} PARTITION ({quote(column)} = {sql_string(str(value))}) SET LOCATION {sql_string(path)}")
    spark.catalog.refreshTable(name)
