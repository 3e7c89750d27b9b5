"""Run lists of loads and reconciliations from config dicts.

The dicts use the same keys as the YAML files of the toolkit this replaces
(``job``, ``tables`` / ``reconciliations``, ``settings``), so a parsed config
can be passed in as is.  The driver loops over the specs; each spec is one
or two Spark jobs whose results come back as a single row of counts.
Failures are isolated per spec and recorded, never raised past the loop.

``parallel_execution`` (true, or a number) in the job or the settings runs
specs side by side, each under its own job tag and scheduler pool; a spec
waits for earlier ones that write what it reads or writes, or that read what
it writes.

``rerun_safe: true`` in the job or a load spec makes a load recognise that its
batch (job, spec and batch id) was applied, also after a failure half-way: a
batch that runs again leaves the rows as they are and reports ``SKIPPED``.
Appends remember every batch, states the last one.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import re
import threading
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fingerprint import case_sensitive, change_hash_sql, column_types

from tidemark.operators import compare as C
from tidemark.operators import digest as DG
from tidemark.operators import loads as L
from tidemark.operators.schema_drift import compare_schemas
from tidemark.sinks import buckets as BK
from tidemark.sinks import records as RC
from tidemark.sinks import tables as TB
from tidemark.sources.tables import load_source, read_table

SUCCESS, FAILED, SKIPPED = "SUCCESS", "FAILED", "SKIPPED"
#: Specs that run side by side where ``parallel_execution`` is just true.
WORKERS = 4
#: Fixed value: the audit table of jobs that name none.
DEFAULT_AUDIT_TABLE = "scd_job_audit"
STAT_KEYS = ["source_count", "inserted", "updated", "deleted", "active_count", "historical_count"]
LOAD_RESULT_SCHEMA = (
    "name string, table_name string, load_type string, status string, error_message string, "
    "source_count long, inserted long, updated long, deleted long, active_count long, historical_count long, "
    "duration_seconds double"
)
RECON_RESULT_SCHEMA = (
    "recon_id string, recon_name string, overall_status string, schema_status string, data_status string, "
    "threshold_breached boolean, duration_seconds double, error_message string"
)


def select_specs(specs: Sequence[dict], names: Sequence[str] | None, what: str) -> list[dict]:
    chosen = [s for s in specs if not names or s["name"] in names]
    if not chosen:
        raise ValueError(f"No {what} found matching: {list(names) if names else names}")
    return chosen


def _reads(spec: dict) -> str:
    """The text that names what a spec reads."""
    parts = [spec.get("source") or {}, *([spec["target"]] if "table" in (spec.get("target") or {}) else [])]
    return " ".join(str(p.get(kind) or "") for p in parts for kind in ("sql", "table"))


def _names_table(text: str, table: str | None) -> bool:
    return bool(table) and re.search(rf"(?<![\w.]){re.escape(table)}(?![\w.])", text.replace("`", ""), re.IGNORECASE) is not None


def waits_for(specs: Sequence[dict]) -> list[set[int]]:
    """For each spec the earlier ones that it must follow."""
    written = [(s.get("target") or {}).get("table_name") for s in specs]
    read = [_reads(s) for s in specs]
    return [
        {j for j in range(i) if _names_table(read[i], written[j]) or _names_table(read[j], written[i])
         or (written[i] and str(written[i]).lower() == str(written[j]).lower())}
        for i in range(len(specs))
    ]


def _run_all(spark: SparkSession, job: str, specs: Sequence[dict], parallel, run: Callable[[dict], tuple]) -> list[tuple]:
    """``run`` of every spec, in order or side by side; results in order."""
    workers = WORKERS if parallel is True else int(parallel or 1)
    if workers <= 1:
        return [run(s) for s in specs]
    sc = spark.sparkContext

    def tagged(spec: dict, before: list) -> tuple:
        for f in before:
            f.result()
        tag = f"{job}-{spec['name']}".replace(",", " ")
        sc.setLocalProperty("spark.scheduler.pool", tag)
        sc.addJobTag(tag)
        try:
            return run(spec)
        finally:
            sc.removeJobTag(tag)

    futures: list = []
    with ThreadPoolExecutor(workers) as pool:  # first in, first out: what a spec waits for has begun before it
        for spec, needs in zip(specs, waits_for(specs), strict=True):
            futures.append(pool.submit(inheritable_thread_target(spark)(tagged), spec, [futures[j] for j in sorted(needs)]))
    return [f.result() for f in futures]


def _observed(df: DataFrame, exprs: Sequence[str]) -> tuple[DataFrame, Callable[[], dict]]:
    """``df``, and its aggregates once an action on it has ended: they are
    gathered while its rows stream by, so that nothing is computed twice or
    stored in between."""
    seen = Observation()
    return df.observe(seen, *[F.expr(e) for e in exprs]), lambda: {k: int(v or 0) for k, v in seen.get.items()}


def _raise_duplicate(e: Exception):
    if L.DUPLICATE_KEY_MESSAGE.split(":")[0] in str(e):
        raise L.DuplicateKeyError(L.DUPLICATE_KEY_MESSAGE) from e
    raise e


def run_load(
    spark: SparkSession,
    spec: dict,
    source: DataFrame,
    batch_id: str | None,
    as_of=None,
    root: str | None = None,
    tag: str | None = None,
) -> dict | None:
    """Apply one load spec to its target table with ``source``; returns the
    six counters, or None if the target has ``tag`` already.  The new state is
    written once (as a snapshot, or appended) and the counters are observed in
    that write.

    In the spec's ``target``, ``key_buckets: n`` keeps an SCD state in buckets
    of which a load rewrites those it touches (``sinks.buckets``), and
    ``cluster_by_keys: n`` keeps a table's files bucketed and sorted by the
    keys, so that a load doesn't shuffle the target to join it.

    ``exact: true`` in the spec's ``scd`` part uses the null-safe fingerprint;
    a target whose fingerprints were made the other way is refused."""
    table = spec["target"]["table_name"]
    load_type = spec.get("load_type", "scd2")
    scd = spec.get("scd", {}) or {}
    keys, columns = list(scd.get("keys", []) or []), list(scd.get("columns", []) or [])
    dh = spec.get("delete_handling") or {}
    del_col = dh.get("column") if dh.get("enabled") else None
    del_val = dh.get("value") if dh.get("enabled") else None
    exact = bool(scd.get("exact", False))
    scd2_args = dict(keys=keys, columns=columns, as_of=as_of, batch_id=batch_id, delete_column=del_col, delete_value=del_val, exact=exact)
    if spec["target"].get("key_buckets") and load_type in ("scd1", "scd2"):
        try:
            return _load_buckets(spark, spec, source, keys, columns, as_of, scd2_args, root, tag)
        except Exception as e:  # noqa: BLE001
            _raise_duplicate(e)
    cluster = (int(spec["target"]["cluster_by_keys"]), keys) if spec["target"].get("cluster_by_keys") and keys else None
    target = read_table(spark, table)
    exists = target is not None
    if exists and tag and (TB.applied(spark, table, tag) if load_type == "incremental" else TB.state_is_of(spark, table, tag)):
        return None
    joins = _as_it_lies(spark) if cluster else contextlib.nullcontext()
    count = ["count(1) AS n"]
    all_new = lambda n: dict(source_count=n, inserted=n, updated=0, deleted=0, active_count=n, historical_count=0)
    try:
        if load_type == "incremental":
            if tag and not exists:  # made empty first, so that the rows come with their tag
                TB.create_table(spark, source.limit(0), table, root, cluster=cluster)
            if not exists or not keys:
                rows, got = _observed(source, count)
                if tag:
                    n = _appended(spark, rows, table, tag, lambda: got()["n"])
                else:
                    TB.append_rows(rows, table) if exists else TB.create_table(spark, rows, table, root, cluster=cluster)
                    n = got()["n"]
                out = all_new(n)
            else:
                tagged, got = _observed(L.incremental_tagged(target, source, keys), ["count(1) AS n", "count_if(_new) AS new"])
                new = tagged.filter("_new").select("_row.*")
                if tag:
                    n = _appended(spark, new, table, tag, lambda: got()["new"])
                    out = {**all_new(n), "source_count": source.count()}
                else:
                    TB.append_rows(new, table)
                    out = {**all_new(got()["n"]), "inserted": got()["new"]}
            return {**out, "active_count": spark.read.table(table).count()} if exists else out
        if load_type == "full_refresh":
            rows, got = _observed(source, count)
            TB.commit_state(spark, rows, table, exists, root, tag, cluster)
            return all_new(got()["n"])
        if load_type == "scd1":
            if not exists:
                rows, got = _observed(L.scd1(None, source, keys, columns, as_of), count)
                TB.create_table(spark, rows, table, root, cluster=cluster, tag=tag)
                return all_new(got()["n"])
            joined, got = _observed(L.scd1_joined(target, source, keys, columns, as_of), L.counter_exprs("scd1"))
            with joins:
                TB.replace_state(spark, joined.select("_row.*"), table, root, tag=tag)
            return got()
        if load_type == "scd2":
            if not exists:
                rows, seen = _observed(source, count)
                state, got = _observed(L.scd2(None, rows, **scd2_args), count)
                TB.create_table(spark, state, table, root, cluster=cluster, tag=tag)
                return {**all_new(got()["n"]), "source_count": seen()["n"]}
            _same_hash_kind(target, columns, exact, table)
            joined, got = _observed(L.scd2_joined(target, source, **scd2_args), L.counter_exprs("scd2"))
            closed, before = _observed(L.closed_rows(target), [L.HISTORY_EXPR])
            with joins:
                TB.replace_state(spark, L.scd2_state_from_joined(joined, target, history=closed), table, root, tag=tag)
            out = got()
            return {**out, "historical_count": out["historical_count"] + before()["closed_before"]}
    except Exception as e:  # noqa: BLE001
        _raise_duplicate(e)
    raise ValueError(f"Unknown load_type: {load_type}")


@contextlib.contextmanager
def _as_it_lies(spark: SparkSession):
    """Lets a join use a table's buckets by its keys although it also compares
    the column that spreads rows without keys."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    had = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, had)


def _appended(spark: SparkSession, rows: DataFrame, table: str, tag: str, count: Callable[[], int]) -> int:
    """Rows that an append with a tag added; where it finished what an earlier
    run had written, nothing was read, and they are counted in the table."""
    before = spark.read.table(table).count()
    reads = threading.Event()
    TB.append_once(spark, rows, table, tag, on_write=reads.set)
    return count() if reads.is_set() else spark.read.table(table).count() - before


def _load_buckets(spark, spec, source, keys, columns, as_of, scd2_args, root, tag) -> dict | None:
    """An SCD load of a state in key buckets: reads and rewrites the buckets of
    the batch's keys; the others are counted by the state's manifest."""
    table, scd1 = spec["target"]["table_name"], spec.get("load_type") == "scd1"
    state = BK.bucketed_state(spark, table)
    if state is None and TB.finish_replacement(spark, table):
        raise ValueError(f"{table} is not kept in key buckets")
    zero = dict.fromkeys(STAT_KEYS, 0)
    if state is None:
        rows, seen = _observed(source, ["count(1) AS n"])
        first = L.scd1(None, rows, keys, columns, as_of) if scd1 else L.scd2(None, rows, **scd2_args)
        places = BK.create_state(spark, first, table, keys, int(spec["target"]["key_buckets"]), root, tag)
        n = sum(p["rows"] for p in places.values())
        return {**zero, "source_count": seen()["n"], "inserted": n, "active_count": n}
    if tag and state.tag == tag:
        return None
    touched, old = state.touched(source), state.manifest
    out = dict(zero)
    if touched:
        target = state.read(touched)
        if not scd1:
            _same_hash_kind(target, columns, scd2_args["exact"], table)
        joined = L.scd1_joined(target, source, keys, columns, as_of) if scd1 else L.scd2_joined(target, source, **scd2_args)
        joined, got = _observed(joined, L.counter_exprs(spec.get("load_type", "scd2")))
        rows = joined.select("_row.*") if scd1 else L.scd2_state_from_joined(joined, target)
        BK.replace_buckets(state, rows, touched, root, tag)
        out = got()
    rest = [p for b, p in old.items() if b not in set(touched)]
    closed = sum(p["closed"] for p in (old.values() if not scd1 else []))
    return {**out, "active_count": out["active_count"] + sum(p["active"] for p in rest), "historical_count": out["historical_count"] + closed}


def _same_hash_kind(target: DataFrame, columns: Sequence[str], exact: bool, table: str) -> None:
    """Refuses an SCD2 target whose fingerprints were made the other way: every
    unchanged row would look changed.  One row with a NULL or the separator in
    no tracked column tells, as its two fingerprints differ."""
    if not set(columns) <= set(target.columns):
        return
    plain, strict = (change_hash_sql(columns, exact=e, types=column_types(target, columns)) for e in (False, True))
    one = target.filter(f"{L.ACTIVE} = '{L.YES}'").selectExpr(f"{L.HASH} = {plain} AS p", f"{L.HASH} = {strict} AS e").first()
    if one is not None and (one["p"], one["e"]) == ((True, False) if exact else (False, True)):
        raise ValueError(f"{table} holds {'plain' if exact else 'exact'} fingerprints; load it as it was made, or rebuild it")


def run_loads(
    spark: SparkSession,
    config: dict,
    names: Sequence[str] | None = None,
    as_of=None,
    audit_table: str | bool | None = None,
    user: str | None = None,
    root: str | None = None,
) -> DataFrame:
    """Run the selected load specs in order; one failure does not stop the
    rest.  Appends one audit row per spec to ``audit_table``: the argument,
    else the job's ``audit_table``, else ``DEFAULT_AUDIT_TABLE`` (``False``:
    none).  Audit write errors are reported in the result, not raised.  Returns
    one row per spec with status, error and the six counters."""
    job = config["job"]
    if audit_table is None:
        audit_table = job.get("audit_table", DEFAULT_AUDIT_TABLE)
    specs = select_specs(config["tables"], names, "tables")
    parallel = job.get("parallel_execution", (config.get("settings") or {}).get("parallel_execution"))
    auditing = threading.Lock()  # files of two appends to one table would meet
    clock = {"as_of": str(as_of) if as_of is not None else None, "batch_id": job.get("batch_id")}

    def run(spec: dict) -> tuple:
        start = dt.datetime.now()
        status, error, stats = SUCCESS, None, dict.fromkeys(STAT_KEYS, 0)
        try:
            source = load_source(spark, spec["source"], clock)
            safe = spec.get("rerun_safe", job.get("rerun_safe"))
            tag = f"{job.get('name')}|{spec['name']}|{job.get('batch_id')}" if safe else None
            done = run_load(spark, spec, source, job.get("batch_id"), as_of, root, tag)
            status, stats = (SUCCESS, done) if done is not None else (SKIPPED, stats)
        except Exception as e:  # noqa: BLE001
            status, error = FAILED, str(e)
        end = dt.datetime.now()
        if audit_table:
            try:
                with auditing:
                    stats_df = spark.createDataFrame([tuple(stats[k] for k in STAT_KEYS)], ", ".join(f"{k} long" for k in STAT_KEYS))
                    row = RC.audit_row(stats_df, job.get("name"), job.get("batch_id"), spec["target"]["table_name"],
                                       spec.get("load_type", "scd2").upper(), start, end, status, error, user)
                    row = row.select(*[F.col(f.name).cast(f.dataType) for f in RC.AUDIT_SCHEMA.fields])
                    TB.ensure_table(spark, audit_table, RC.AUDIT_SCHEMA, root)
                    TB.append_rows(row, audit_table)
            except Exception as e:  # noqa: BLE001
                error = (error + "; " if error else "") + f"audit write failed: {e}"
        return (spec["name"], spec["target"]["table_name"], spec.get("load_type", "scd2"), status, error,
                *[stats[k] for k in STAT_KEYS], (end - start).total_seconds())

    out = _run_all(spark, str(job.get("name")), specs, parallel, run)
    return spark.createDataFrame(out, LOAD_RESULT_SCHEMA)


def run_reconciliation(
    spark: SparkSession,
    cfg: dict,
    batch_id: str,
    settings: dict | None = None,
    results_table: str | None = None,
    details_table: str | None = None,
    recon_id: str | None = None,
    execution_time=None,
    root: str | None = None,
    writing: threading.Lock | None = None,
) -> tuple:
    """One reconciliation: schema check, data check, thresholds, records.

    ``validations``: ``schema_check`` and ``data_comparison`` switch the two
    checks; ``duplicate_check: false`` leaves duplicates out of the counts
    and the status; ``row_count_check: false`` leaves the row counts
    out of the result row;
    ``null_check: true`` adds NULL_DIFFERENCE detail rows for compared columns
    whose NULL counts differ.  Every issue is listed unless the settings'
    ``sample_mismatches`` asks for a sample of the mismatches.  ``exact_compare: true`` uses
    the null-safe fingerprint.  ``drill_down: true`` compares digests of key
    buckets first and shuffles the rows of buckets that differ
    (``operators.digest``); ``unique_keys: true`` with it vouches that neither
    side has repeated keys.  The settings' ``partition_by_day: true`` makes
    record tables that are partitioned by the day of the run."""
    settings = settings or {}
    recon_id = recon_id or str(uuid.uuid4())
    execution_time = execution_time or dt.datetime.now()
    start = dt.datetime.now()
    validations = cfg.get("validations") or {}
    clock = {"as_of": str(execution_time), "batch_id": batch_id}
    source = load_source(spark, cfg["source"], clock)
    target = load_source(spark, cfg["target"], clock)
    days = bool(settings.get("partition_by_day"))
    src_name, tgt_name = cfg["source"].get("table"), cfg["target"].get("table")
    if validations.get("schema_check", True):
        sch = compare_schemas(source, target)
        schema_status, schema_summary = sch["status"], sch["summary"]
    else:
        schema_status, schema_summary = C.SKIPPED, "Schema check disabled"
    keys = cfg["keys"]
    sample = settings.get("sample_mismatches")
    logging = settings.get("enable_detailed_logging", True)
    breached, data_status = False, C.SKIPPED
    if validations.get("data_comparison", True):
        cols = C.compare_columns(source.columns, target.columns, keys, cfg.get("columns_to_compare"),
                                 cfg.get("exclude_columns"), case_sensitive(source))
        exact = bool(cfg.get("exact_compare", False))
        drill, unique = bool(cfg.get("drill_down")), bool(cfg.get("unique_keys"))
        unique = drill and unique
        rows, inside = DG.digest_rows(source, target, keys, cols, exact, unique) if drill else (C.side_rows(source, target, keys, cols, exact), None)
        if not drill and cols and not (sample and logging and details_table):
            inside = C.crowded_keys(source, target, keys)
        duplicates, rows_too = validations.get("duplicate_check", True), validations.get("row_count_check", True)
        if logging and details_table:
            # one job: the numbers are observed where the keys are gathered, while the issues, which
            # are all that is kept of it, stream to the details table; a sample reads it per type
            seen: list[Callable[[], dict]] = []

            def watch(prof: DataFrame) -> DataFrame:
                if unique or sample:
                    return prof
                prof, got = _observed(prof, C.summary_exprs(bool(cols)))
                seen.append(got)
                return prof

            if sample or unique or not cols:
                per_hash = C.counts_of(rows, keys) if cols or drill else None
                prof = C.profile_from_counts(per_hash, keys) if per_hash is not None else C.key_profile(source, target, keys)
                per_hash = per_hash if cols else None
            if sample or unique:
                counts = DG.digest_summary(C.summarize_profile(prof, keys, bool(cols)), source, target, unique)
            if sample:
                issues = C.issue_rows_from_profile(prof, per_hash, keys, {C.MISMATCH: int(sample)})
            elif cols:
                issues = C.issues_of_rows(rows, keys, inside, watch)
            else:
                issues = C.issue_rows_from_profile(watch(prof), None, keys)
            if not duplicates:
                issues = issues.filter(~F.col("issue_type").isin(C.SOURCE_DUPLICATE, C.TARGET_DUPLICATE))
            if validations.get("null_check", False):
                issues = issues.unionByName(C.null_difference_rows(source, target, cols))
            RC.require_not_null({"recon_id": recon_id, "recon_name": cfg["name"], "batch_id": batch_id,
                                 "execution_time": execution_time}, RC.DETAILS_SCHEMA)
            dr = RC.details_rows(issues, recon_id, cfg["name"], batch_id, execution_time)
            _record(spark, dr, details_table, RC.DETAILS_SCHEMA, root, writing, days)
            if not sample and not unique:
                parts = [got() for got in seen]
                counts = spark.createDataFrame([{c: min(C.LONG_MAX, sum(p[c] for p in parts)) for c in parts[0]}], C.SUMMARY_COUNTS)
        elif cols or drill:
            counts = C.summary_of_rows(rows, keys, bool(cols), inside)
            counts = DG.digest_summary(counts, source, target, unique)
        else:
            counts = C.summarize_profile(C.key_profile(source, target, keys), keys, False)
        summ = C.finish_summary(counts, cols, src_name, tgt_name, duplicates)
        summ = C.with_thresholds(summ, cfg.get("thresholds"), schema_status)
        row = summ.collect()[0].asDict()
        breached, data_status = bool(row["threshold_breached"]), row["status"]
        duration = (dt.datetime.now() - start).total_seconds()
        if logging and results_table:
            if not rows_too:
                row.update(source_count=None, target_count=None)
            rr = RC.result_row(spark.createDataFrame([row], summ.schema), recon_id, cfg["name"], batch_id,
                               execution_time, schema_status, schema_summary, duration)
            _record(spark, rr, results_table, RC.RESULTS_SCHEMA, root, writing, days)
    else:
        duration = (dt.datetime.now() - start).total_seconds()
        if logging and results_table:
            rr = RC.skipped_result_row(spark, recon_id, cfg["name"], batch_id, execution_time, schema_status,
                                       schema_summary, src_name, tgt_name, duration)
            _record(spark, rr, results_table, RC.RESULTS_SCHEMA, root, writing, days)
    overall = C.PASSED
    if schema_status == C.FAILED or data_status == C.FAILED:
        overall = C.FAILED
    if breached:
        overall = C.THRESHOLD_BREACHED
    return recon_id, cfg["name"], overall, schema_status, data_status, breached, duration, None


def _record(spark, rows: DataFrame, table: str, schema, root: str | None, writing: threading.Lock | None, days: bool) -> None:
    """Appends record rows.  Where several specs run at once, they are written
    aside first, and appended one after the other."""
    typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    staged = None
    if writing is not None:
        staged = f"{(root or TB.warehouse(spark)).rstrip('/')}/_staged/{uuid.uuid4().hex}"
        typed.write.parquet(staged)
        typed = spark.read.schema(typed.schema).parquet(staged)
    with writing or contextlib.nullcontext():
        RC.ensure_records(spark, table, schema, root, days)
        by_day = RC.DAY in spark.read.table(table).columns
        TB.append_rows(typed.withColumn(RC.DAY, F.to_date("execution_time")) if by_day else typed, table, RC.DAY if by_day else None)
    if staged:
        TB.delete_path(spark, staged)


def run_reconciliations(
    spark: SparkSession,
    config: dict,
    names: Sequence[str] | None = None,
    root: str | None = None,
) -> DataFrame:
    """Run the selected reconciliations in order; each gets a fresh id.
    A failing reconciliation is recorded as FAILED and the rest still run."""
    job = config["job"]
    settings = config.get("settings") or {}
    recons = select_specs(config["reconciliations"], names, "reconciliations")
    parallel = settings.get("parallel_execution", job.get("parallel_execution"))
    writing = threading.Lock() if parallel else None

    def run(cfg: dict) -> tuple:
        try:
            return run_reconciliation(spark, cfg, job.get("batch_id"), settings, job.get("results_table"),
                                      job.get("details_table"), root=root, writing=writing)
        except Exception as e:  # noqa: BLE001
            return str(uuid.uuid4()), cfg.get("name"), C.FAILED, None, None, False, None, str(e)

    out = _run_all(spark, str(job.get("name")), recons, parallel, run)
    return spark.createDataFrame(out, RECON_RESULT_SCHEMA)
