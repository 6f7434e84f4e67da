"""Orchestration: catalog -> selection -> per-table plan -> one write job per table.

The driver only plans (metadata, chunk bounds, at most a few small
collects); executors read, assign chunks, convert and write.

* J1 retries: planning and each commit are retried by themselves after each wait in
  ``job.retry_waits`` (task-level retries are Spark's own);
* J2 ``continue_on_exception``: a table that still fails is recorded in
  ``failed`` (and the manifest) instead of failing the run; of a database table, the chunks
  of a commit that fails are tried one by one, and only those that fail are missing;
* J3 pre/post SQL: ``;``-separated statements run with ``spark.sql``;
* J4 resume: a table is committed in waves of ``commit_chunks`` chunks; what is committed is
  skipped, chunk by chunk, by a key that names what it holds. Files of an earlier plan stay
  in place until all of the new one is there, and are replaced in one commit;
* J5 concurrency: ``threads`` tables are exported at the same time (each
  is a full-width Spark job).
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from .session import local_df

from .functions.columns import chunk_id_col, convert_datetimes, expand_pattern, tidy_columns
from .operators import catalog_ops as co
from .operators.balance import assign_balanced, balanced_chunk_table, balanced_groups, balanced_predicates
from .operators.content import HASH_COL, check_content, row_hash
from .operators.stats import query_stats, read_file_index, table_rollup, with_planned_chunks
from .operators.union_batches import union_batches
from .plans.chunks import plan_table
from .plans.job import ExportJob
from .sources import commit_log
from .sources.avro_sink import FORMAT, _fs, ensure_destination, register
from .sources.manifest import write_chunk_stats, write_job_manifest

DATETIME_VENDOR_TYPES = {
    # Vendor types whose values are turned into ISO-8601 text.
    "sqlserver": ("datetime", "datetime2", "smalldatetime", "timestamp", "timestamp_ntz"),
    "oracle": ("DATE", "timestamp", "timestamp_ntz"),
}


def split_sql(script: str) -> list[str]:
    return [s.strip() for s in script.split(";") if s.strip()]


def run_sql(spark: SparkSession, scripts) -> None:
    for script in scripts:
        for stmt in split_sql(script):
            spark.sql(stmt)


@dataclass
class TableResult:
    catalog: str | None
    schema: str
    table: str
    run_id: str
    strategy: str = "whole"
    split_strategies: list = field(default_factory=list)
    table_query_count: int = 0
    db_row_count: int | None = None
    ok: bool = True
    error: str | None = None
    chunk_labels: DataFrame | None = None
    plan: str | None = None  # fingerprint of the chunks
    failed_chunks: list = field(default_factory=list)  # (chunk number, query, error)
    content_mismatch: bool | None = None  # files hold other values than were read; None: not checked
    complete: bool = True  # every chunk of the plan is committed


@dataclass
class ExportResult:
    tables: list[TableResult]
    files: DataFrame
    stats: DataFrame
    rollup: DataFrame
    manifest_path: str
    runtime_ms: int
    timings: dict = field(default_factory=dict)

    @property
    def failed(self) -> list[TableResult]:
        return [t for t in self.tables if not t.ok]


def choose_strategy(job: ExportJob, schema: str, table: str, partitioned: bool) -> str:
    """Explicit split strings win; partitioned tables are balanced per partition;
    tables listed in ``tables_split`` get balanced chunks; the rest is one query."""
    if job.specs_for(schema, table):
        return "strategies"
    if partitioned:
        return "balanced_partitioned"
    if f"{schema}.{table}" in job.tables_split:
        return "balanced"
    return "whole"


def project_for_export(df: DataFrame, columns: list[str], vendor: dict, job: ExportJob, keep: list[str]) -> DataFrame:
    """Exportable columns in catalog order, date-times as text when asked, tidy names."""
    sel = df.select(*[F.col(f"`{c}`") for c in columns], *[F.col(f"`{k}`") for k in keep])
    if job.string_datetime:
        conv = [c for c in columns if vendor.get(c) in DATETIME_VENDOR_TYPES[job.flavor]]
        sel = convert_datetimes(sel, job.flavor, job.string_datetime_suffix, conv)
    data_cols = [c for c in sel.columns if c not in keep]
    tidy = tidy_columns(sel.select(*[F.col(f"`{c}`") for c in data_cols]))
    return sel.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(data_cols, tidy.columns)],
                      *[F.col(f"`{k}`") for k in keep])


def _sql_labels(spark, source, schema, table, columns, preds):
    """Chunk labels for a database source: the SQL each chunk runs (metadata-sized)."""
    return local_df(spark, [(f"{no:07d}", source.chunk_sql(schema, table, columns, p)) for no, p in preds],
                    "query_id string, label string")


@dataclass
class Planned:
    """How one table is exported: ``preds`` of a database (chunk number, predicate), else ``rows`` with a chunk column, or the whole of ``df``."""

    strategy: str
    n_chunks: int
    labels: DataFrame
    fingerprint: str  # of the plan: what is exported, and all chunks as resolved
    texts: list = field(default_factory=list)
    df: DataFrame | None = None
    rows: DataFrame | None = None
    preds: list | None = None
    key_columns: list = field(default_factory=list)


def plan_and_assign(spark: SparkSession, job: ExportJob, df: DataFrame | None, schema: str, table: str,
                    partitioned_by: list[str] | None, chunk_col: str = "_tx_chunk", source=None,
                    export_cols: list[str] | None = None, primary_key: list[str] | None = None) -> Planned:
    """For a database source (``read_chunks``) bounds, distinct values and balanced
    groups are asked of the database and every chunk is read by its own
    predicate (one task each, already clustered); for files the chunk is a
    column computed in one scan."""
    db = source is not None and hasattr(source, "read_chunks")
    stored = []
    if db and not partitioned_by and not job.specs_for(schema, table):
        stored = source.storage_partitions(schema, table)  # the database keeps the table in parts: chunks name them
    strategy = choose_strategy(job, schema, table, bool(partitioned_by or stored))
    if strategy == "strategies":
        specs = job.specs_for(schema, table)
        kw = {}
        if db:
            kw = dict(bounds_fn=lambda cols: source.bounds(schema, table, cols),
                      distinct_fn=lambda cols: source.distinct(schema, table, cols))
        plan = plan_table(df, specs, table=table, exactly_once=job.exactly_once,
                          increment_factor=job.increment_factor, spark=spark, **kw)
        labels = plan.chunk_table(spark).select(chunk_id_col(F.col("chunk_no")).alias("query_id"), "label")
        texts = [st.describe() for st in plan.strategies]
        if not db:
            return Planned(strategy, plan.n_chunks, labels, fingerprint(job, schema, table, export_cols, texts), texts, df, plan.assign(df, chunk_col))
        from .sources.jdbc import predicates
        keys = []
        for st in plan.strategies:
            keys += [st.column] if getattr(st, "column", None) else list(st.spec.key_columns)
        # one chunk = one query = one task, whatever their number: the database alone says which rows are in a chunk
        preds = predicates(plan, source.flavor)
        return Planned(strategy, plan.n_chunks, _sql_labels(spark, source, schema, table, export_cols, preds),
                       fingerprint(job, schema, table, export_cols, [p for _, p in preds]), texts, preds=preds, key_columns=keys)
    if strategy in ("balanced", "balanced_partitioned"):
        keys = job.primary_keys.get(f"{schema}.{table}") or job.primary_keys.get(table) or primary_key or []
        key = keys[0] if keys else (export_cols[0] if df is None else df.columns[0])
        if stored:
            from .sources.jdbc import stored_chunks
            preds = [(no, p) for no, p, _ in stored_chunks(stored, source.stored_groups(schema, table, key, job.balanced_chunks, stored),
                                                           key, source.dialect, job.exactly_once)]
            return Planned(strategy, len(preds), _sql_labels(spark, source, schema, table, export_cols, preds),
                           fingerprint(job, schema, table, export_cols, [p for _, p in preds]), preds=preds,
                           key_columns=[key, *sorted({x.column for x in stored} - {""})])
        parts = list(partitioned_by or [])
        if db:
            groups = source.balanced_groups(schema, table, key, job.balanced_chunks, parts)
        else:
            groups = balanced_groups(df, key, job.balanced_chunks, part=parts)
        chunks = balanced_chunk_table(groups, part=bool(parts))
        residual = len(chunks) + 1 if job.exactly_once else None
        label = lambda p: "" if not parts else (",".join(map(str, p)) if isinstance(p, tuple) else "" if p is None else str(p)) + " "
        rows = [(f"{no:07d}", f"{label(p)}[{lo},{hi}] weight {w}") for no, p, g, lo, hi, w in chunks]
        if residual:
            rows.append((f"{residual:07d}", "residual"))
        n = len(chunks) + (1 if residual else 0)
        if db:
            preds = balanced_predicates(chunks, key, parts, source.dialect, residual)
            return Planned(strategy, n, _sql_labels(spark, source, schema, table, export_cols, preds),
                           fingerprint(job, schema, table, export_cols, [p for _, p in preds]), preds=preds, key_columns=[key, *parts])
        assigned = assign_balanced(df, key, chunks, part=parts, chunk_col=chunk_col, residual=residual)
        return Planned(strategy, n, local_df(spark, rows, "query_id string, label string"),
                       fingerprint(job, schema, table, export_cols, [key, parts, *[t for _, t in rows]]), [], df, assigned)
    text = source.chunk_sql(schema, table, export_cols, None) if db else "whole table"
    labels = local_df(spark, [("0000001", text)], "query_id string, label string")
    if df is None:
        df = source.read(schema, table, export_cols)
    return Planned("whole", 1, labels, fingerprint(job, schema, table, export_cols, [text]), [], df)


def fingerprint(job: ExportJob, schema: str, table: str, columns, parts: list) -> str:
    """Names a plan, or a chunk: what is exported, and the chunks as resolved (bounds included)."""
    text = json.dumps([schema, table, list(columns or []), job.exactly_once, job.string_datetime, job.string_datetime_suffix,
                       [str(p) for p in parts]])
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def with_retries(waits, work):
    """``work()``, again after each wait if it raises."""
    for wait in [*waits, None]:
        try:
            return work()
        except Exception:  # noqa: BLE001 - the last one is raised
            if wait is None:
                raise
            time.sleep(wait)


def check_names(job: ExportJob, catalog, tables: list) -> None:
    """Two tables whose files would carry one name (by tidying, or for want of a placeholder) are refused before anything is written."""
    seen: dict = {}
    for schema, table in tables:
        name = expand_pattern(job.filename_pattern, catalog, schema, table, tidy=job.tidy_tables)
        if name in seen:
            raise ValueError(f"tables {'.'.join(seen[name])!r} and {schema + '.' + table!r} would both be written as {name!r}")
        seen[name] = (schema, table)


def export_table(spark: SparkSession, job: ExportJob, source, cols_rows: list, schema: str, table: str,
                 run_id: str, resume: bool = False, cluster: bool = True) -> TableResult:
    """Export one table; ``cols_rows`` are its column metadata rows (ordinal, column, vendor_type, exportable)."""
    res = TableResult(catalog=getattr(source, "catalog", None), schema=schema, table=table, run_id=run_id)
    cols_rows = sorted(cols_rows, key=lambda r: r["ordinal"])
    export_cols = [r["column"] for r in cols_rows if r["exportable"]]
    if not export_cols:
        res.strategy, res.table_query_count = "skipped", 0
        return res
    vendor = {r["column"]: r["vendor_type"] for r in cols_rows}
    db = hasattr(source, "read_chunks")
    df = None if db else source.read(schema, table)  # a database table is read per chunk (or whole, below)
    partitioned_by = (job.partition_columns.get(f"{schema}.{table}") or job.partition_columns.get(table))
    if not partitioned_by and hasattr(source, "partition_columns"):
        partitioned_by = source.partition_columns(schema, table) or None  # folder partitions
    plan = with_retries(job.retry_waits, lambda: plan_and_assign(
        spark, job, df, schema, table, partitioned_by, source=source, export_cols=export_cols,
        primary_key=[r["column"] for r in cols_rows if r["is_key"]]))
    res.plan, res.strategy, res.table_query_count, res.split_strategies = plan.fingerprint, plan.strategy, plan.n_chunks, plan.texts
    planned_at = time.strftime("%Y-%m-%d %H:%M:%S")
    res.chunk_labels = plan.labels.select(F.lit(res.catalog).cast("string").alias("catalog"), F.lit(schema).alias("schema"),
                                          F.lit(table).alias("table"), "query_id", "label",
                                          F.to_timestamp(F.lit(planned_at)).alias("created_time"))
    unionize = f"{schema}.{table}" in job.unionize
    by_chunk = plan.preds is not None and not unionize  # union batches number what they write, not what is read
    if plan.preds is not None:
        keys = {no: fingerprint(job, schema, table, export_cols, [no, p]) for no, p in plan.preds} if by_chunk else {}
        planned = set(keys.values()).__contains__ if by_chunk else (lambda k: str(k).startswith(f"{plan.fingerprint}-"))
    else:
        keys, planned = {}, lambda k: str(k).startswith(f"{plan.fingerprint}-")

    fs, root = _fs(job.destination)
    name = (res.catalog, schema, table)
    there = commit_log.records(fs, root, name) if resume else []
    finished = there + (commit_log.records(fs, root, name, commit_log.STAGED) if resume else [])
    done = {r["key"]: r["chunk"] for r in finished if planned(r.get("key"))}
    waiting = len(finished) > len(there)  # an earlier resumed run was stopped before it could replace what was there
    # files of chunks that the plan doesn't have (bounds have moved, other columns): seen until all of the plan is there, then replaced as one
    stale = {commit_log.token(r) for r in there if not planned(r.get("key"))}

    register(spark)

    def write(rows: DataFrame, chunk_col: str | None, clustered: bool, wave: dict) -> None:
        out = project_for_export(rows, export_cols, vendor, job, [chunk_col] if chunk_col else [])
        if chunk_col and unionize:
            out = union_batches(out, [c for c in out.columns if c != chunk_col], chunk_col, job.union_batch, chunk_col)
            clustered = False  # the de-duplication shuffle hashed rows on their values, not on the batch
        if job.content_check:
            out = out.withColumn(HASH_COL, row_hash(out, [c for c in out.columns if c != chunk_col]))
        if cluster and chunk_col and not clustered:
            # rows of one chunk are spread over the scan's tasks: cluster them (AQE splits a skewed chunk)
            out = out.hint("rebalance", chunk_col)
        if chunk_col:
            out = out.sortWithinPartitions(chunk_col)  # a task has one file open at a time
        w = (out.write.format(FORMAT).mode("append").option("plan", plan.fingerprint).option("sorted", "true")
             .option("staged", str(bool(stale)).lower()).option("keys", json.dumps(wave))
             .option("path", job.destination).option("pattern", job.filename_pattern)
             .option("schema", schema).option("table", table).option("codec", job.codec)
             .option("target_size", str(job.avro_size)).option("tidy", str(job.tidy_tables).lower())
             .option("run_id", run_id))
        if res.catalog:
            w = w.option("catalog", res.catalog)
        if chunk_col:
            w = w.option("chunk_col", chunk_col)
        if job.content_check:
            w = w.option("hash_col", HASH_COL)
        w.save()

    def save(wave: list) -> None:
        """One commit: the chunks (number, predicate or None) of a wave; an empty list stands for all that is left."""
        if plan.preds is not None:
            rows = source.read_chunks(schema, table, wave, export_cols, "_tx_chunk", key_columns=plan.key_columns)
            write(rows, "_tx_chunk", True, {str(no): keys[no] for no, _ in wave} if by_chunk else {})
        elif plan.rows is None:
            write(plan.df, None, True, {"1": f"{plan.fingerprint}-1"})
        elif wave:
            numbers = [no for no, _ in wave]
            write(plan.rows.where(F.col("_tx_chunk").between(min(numbers), max(numbers)) & F.col("_tx_chunk").isin(numbers)), "_tx_chunk", False,
                  {str(no): f"{plan.fingerprint}-{no}" for no in numbers})
        else:
            rows = plan.rows
            if done:
                rows = rows.join(F.broadcast(local_df(spark, [(int(c),) for c in done.values()], "_tx_chunk long")), "_tx_chunk", "left_anti")
            write(rows, "_tx_chunk", False, {})

    if plan.preds is not None:
        todo = [(no, p) for no, p in plan.preds if not by_chunk or keys[no] not in done]
        if not by_chunk and done:
            todo = []  # all batches are one commit, and it is there
        size = job.commit_chunks if by_chunk else 0
    elif plan.rows is None:
        todo, size = [] if done else [(1, None)], 0
    else:
        size = 0 if unionize else job.commit_chunks_files
        numbers = range(1, plan.n_chunks + 1) if size else ()
        todo = [(no, None) for no in numbers if f"{plan.fingerprint}-{no}" not in done]
    waves = [todo[i:i + size] for i in range(0, len(todo), size)] if size else [todo] if todo or plan.rows is not None else []
    left = len(waves) - job.max_commits if job.max_commits else 0
    for wave in waves[:job.max_commits or None]:
        try:
            with_retries(job.retry_waits, lambda: save(wave))
        except Exception:  # noqa: BLE001 - policy decides
            if not job.continue_on_exception or not by_chunk:
                raise
            for one in wave:  # a chunk by itself: only those that fail are missing
                try:
                    save([one])
                except Exception as e:  # noqa: BLE001
                    res.failed_chunks.append((one[0], source.chunk_sql(schema, table, export_cols, one[1]), f"{type(e).__name__}: {e}"))
    res.complete = left <= 0 and not res.failed_chunks
    if (stale or waiting) and res.complete:
        commit_log.publish(fs, root, f"{run_id}-{uuid.uuid4().hex[:8]}", name, planned, stale)
    if job.content_check:
        wrong = [r["chunk"] for r in check_content(spark, job.destination, name).where("not content_match").orderBy("chunk").select("chunk").collect()]
        res.content_mismatch = bool(wrong)
        if wrong and not job.continue_on_exception:
            raise RuntimeError(f"{schema}.{table}: {len(wrong)} chunks hold other values than were read, the first is {wrong[0]}")
        res.failed_chunks += [(no, None, "the files hold other values than were read") for no in wrong]
    return res


def export_database(spark: SparkSession, job: ExportJob, source, threads: int = 1, resume: bool = False,
                    count_rows: bool = True, manifest_name: str = "job.json") -> ExportResult:
    t0 = time.time()
    timings: dict[str, float] = {}

    def lap(name, since):
        timings[name] = round(time.time() - since, 3)
        return time.time()

    run_id = uuid.uuid4().hex[:12]
    ensure_destination(job.destination)
    if hasattr(source, "check_connection"):
        source.check_connection()
    run_sql(spark, job.pre_sql)
    moment = source.pin() if hasattr(source, "pin") else None
    tables = co.exclude_tables(co.filter_tables(co.filter_schemas(source.tables(), job.schemas), job.tables),
                               job.table_exclusions)
    ordered = co.prioritized_tables(tables, job.table_priorities, job.tables_split)
    todo = [(r["schema"], r["table"]) for r in ordered.orderBy("schema", "priority").collect()]
    # column metadata of the selected tables only, fetched with one collect
    meta_rows = (co.mark_excluded(source.columns(todo), job.column_exclusions)
                 .select("schema", "table", "ordinal", "column", "vendor_type", "is_key", "exportable").collect())
    by_table: dict = {}
    for r in meta_rows:
        by_table.setdefault((r["schema"], r["table"]), []).append(r)
    check_names(job, getattr(source, "catalog", None), todo)
    t = lap("plan_catalog", t0)

    def one(st):
        schema, table = st
        try:
            return export_table(spark, job, source, by_table.get((schema, table), []), schema, table, run_id, resume=resume)
        except Exception as e:  # noqa: BLE001 - policy decides
            if not job.continue_on_exception:
                raise
            return TableResult(catalog=getattr(source, "catalog", None), schema=schema, table=table,
                               run_id=run_id, ok=False, error=f"{type(e).__name__}: {e}", complete=False)

    if threads > 1:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            results = list(pool.map(one, todo))
    else:
        results = [one(t) for t in todo]

    t = lap("export", t)
    if count_rows:
        ok = [(r.schema, r.table) for r in results if r.ok and r.strategy != "skipped"]
        rc = source.row_counts(ok) if ok else None
        if rc is not None:  # a source without catalog counts (Oracle) leaves them empty
            counts = {(x["schema"], x["table"]): x["row_count"] for x in rc.collect()}
            for r in results:
                r.db_row_count = counts.get((r.schema, r.table))

    t = lap("row_counts", t)
    files = read_file_index(spark, job.destination)
    if not resume:  # a resumed run reports the chunks committed by earlier runs too
        files = files.filter(F.col("run_id") == run_id)
    else:  # of the tables of this run: what other plans left of them is replaced once all of a plan is there
        mine = local_df(spark, [(r.schema, r.table) for r in results if r.plan], "schema string, table string")
        files = files.join(F.broadcast(mine), ["schema", "table"], "left_semi")
    planned = None
    for r in results:
        if r.ok and r.chunk_labels is not None:
            planned = r.chunk_labels if planned is None else planned.unionByName(r.chunk_labels)
    if planned is None:  # nothing planned (every table skipped or failed): same columns, no rows
        planned = local_df(spark, [], "catalog string, schema string, table string, query_id string, label string, "
                                      "created_time timestamp")
    stats = with_planned_chunks(query_stats(files), planned).persist()
    info = local_df(spark,
        [(r.catalog, r.schema, r.table, r.db_row_count, r.table_query_count, r.split_strategies, r.strategy)
         for r in results if r.ok],
        "catalog string, schema string, table string, db_row_count long, table_query_count long, "
        "split_strategies array<string>, strategy string")
    rollup = table_rollup(stats, info)
    write_chunk_stats(stats, job.destination, run_id)
    roll_rows = [row.asDict(recursive=True) for row in rollup.collect()]  # one row per table
    unsupported = {(r["schema"], r["table"]): r["unsupported"] for r in co.unsupported_columns(source.columns(todo)).collect()}
    checked = {(r.schema, r.table): r.content_mismatch for r in results}
    for entry in roll_rows:
        entry["contentMismatch"] = checked.get((entry["schema"], entry["table"]))
        entry["unsupportedColumns"] = unsupported.get((entry["schema"], entry["table"]))
        entry["rowCountMismatch"] = None if entry.get("db_row_count") is None else entry["db_row_count"] != entry["export_row_count"]
    failed = [{"schema": r.schema, "table": r.table, "error": r.error} for r in results if not r.ok]
    failed += [{"schema": r.schema, "table": r.table, "chunk": no, "query": query, "error": error} for r in results for no, query, error in r.failed_chunks]
    runtime_ms = int((time.time() - t0) * 1000)
    job_doc = job.to_dict()
    if not job_doc.get("timezone"):
        job_doc["timezone"] = spark.conf.get("spark.sql.session.timeZone", None)
    job_doc["readMoment"] = moment
    job_doc["runId"] = run_id
    few = sum(r.table_query_count for r in results) <= job.manifest_chunks
    path = write_job_manifest(job_doc, roll_rows, failed, runtime_ms,
                              f"{job.destination.rstrip('/')}/{manifest_name}",
                              [r.asDict(recursive=True) for r in stats.collect()] if few else None)
    if resume and job.exactly_once and not job.continue_on_exception:  # a resumed run must not pass for whole when it isn't
        whole = {(r.schema, r.table) for r in results if r.complete and f"{r.schema}.{r.table}" not in job.unionize}
        short = [e for e in roll_rows if e["rowCountMismatch"] and (e["schema"], e["table"]) in whole]
        if short:
            raise RuntimeError("rows at the source and in the destination differ after resuming: " + ", ".join(
                f"{e['schema']}.{e['table']} {e['db_row_count']} / {e['export_row_count']}" for e in short))
    run_sql(spark, job.post_sql)
    lap("report", t)
    return ExportResult(tables=results, files=files, stats=stats, rollup=rollup, manifest_path=path,
                        runtime_ms=runtime_ms, timings=timings)
