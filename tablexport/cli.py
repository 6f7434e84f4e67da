"""Command line: ``spark-submit -m tablexport ...`` / ``python -m tablexport ...``.

Option names follow the export tool's command line (comma-delimited lists,
a repeatable ``--split-table-strategy``); ``--source-dir`` exports a folder of
Parquet tables and ``--spark-database`` the tables of Spark's catalog instead
of a database. Everything maps onto ``ExportJob``.
Exit status 1 when a table failed (unless ``--continue-on-exception``).
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans.job import CODECS, DEFAULT_DATETIME_SUFFIX, DEFAULT_FETCH_SIZE, DEFAULT_FILENAME_PATTERN, \
    DEFAULT_INCREMENT_FACTOR, ExportJob


def _list(v: str | None) -> tuple[str, ...]:
    return tuple(x.strip() for x in v.split(",") if x.strip()) if v else ()


def _bool(v: str) -> bool:
    if v.lower() in ("true", "yes", "1"):
        return True
    if v.lower() in ("false", "no", "0"):
        return False
    raise argparse.ArgumentTypeError(f"expected true/false, got {v!r}")


def _pairs(values: list[str] | None) -> dict:
    out: dict = {}
    for v in values or ():
        table, _, cols = v.partition("=")
        out[table.strip()] = [c.strip() for c in cols.split(",") if c.strip()]
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tablexport", description="Export database tables to Avro with Spark.")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--connect", help="JDBC URL of the database to export")
    src.add_argument("--source-dir", help="folder of Parquet tables to export instead of a database")
    src.add_argument("--spark-database", help="tables of this Spark catalog database (use 'temp' for temp views)")
    p.add_argument("--flavor", choices=("sqlserver", "oracle"), default="sqlserver")
    p.add_argument("--user")
    p.add_argument("--password")
    p.add_argument("--password-file")
    p.add_argument("--destination", required=True, help="Avro destination folder (path or URI)")
    p.add_argument("--catalog")
    p.add_argument("--dirty-reads", action="store_true", help="SQL Server: do not wait for locks of open transactions")
    p.add_argument("--snapshot", nargs="?", type=int, const=True, default=False, metavar="SCN",
                   help="Oracle: all queries read as of one system change number (the present one, or SCN); SQL Server: SNAPSHOT isolation")
    p.add_argument("--schema", help="only these schemas (comma-delimited)")
    p.add_argument("--table", help="only these schema.table (comma-delimited)")
    p.add_argument("--split-table", help="schema.table exported in weight-balanced chunks (comma-delimited)")
    p.add_argument("--prioritize-table", help="schema.table exported first (comma-delimited)")
    p.add_argument("--unionize-query", help="schema.table whose chunks are UNIONed in batches (comma-delimited)")
    p.add_argument("--exclude-table", help="case-insensitive regexes on schema.table (comma-delimited)")
    p.add_argument("--exclude-column", help="case-insensitive regexes on schema.table.column (comma-delimited)")
    p.add_argument("--pre-sql", help="file of ';'-separated Spark SQL run before the export")
    p.add_argument("--post-sql", help="file of ';'-separated Spark SQL run after the export")
    p.add_argument("--datetime-string", type=_bool, default=False)
    p.add_argument("--datetime-string-suffix", default=DEFAULT_DATETIME_SUFFIX)
    p.add_argument("--filename-pattern", default=DEFAULT_FILENAME_PATTERN)
    p.add_argument("--fetch-row-count", type=int, default=DEFAULT_FETCH_SIZE)
    p.add_argument("--avro-codec", choices=CODECS, default="snappy")
    p.add_argument("--avro-size", type=int, default=0, help="uncompressed bytes per file, 0 = unlimited")
    p.add_argument("--log-file", default="job.json", help="manifest file name inside the destination")
    p.add_argument("--threads", type=int, default=1, help="tables exported at the same time")
    p.add_argument("--tidy-tables", type=_bool, default=True)
    p.add_argument("--split-table-strategy", action="append", default=[],
                   help="table,operation,column(s),keyType,increment,start,end,prefix (repeatable)")
    p.add_argument("--increment-factor", type=int, default=DEFAULT_INCREMENT_FACTOR)
    p.add_argument("--continue-on-exception", type=_bool, default=False)
    p.add_argument("--as-written", action="store_true", help="mirror the chunk lists exactly (overlaps, gaps)")
    p.add_argument("--primary-key", action="append", help="table=col1,col2 (key used for balanced chunks)")
    p.add_argument("--partition-column", action="append", help="table=col (balanced chunks per value)")
    p.add_argument("--content-check", action="store_true", help="read the files again and hold them against the rows as read")
    p.add_argument("--resume", action="store_true", help="skip chunks already committed in the destination")
    p.add_argument("--retry-waits", default="5,25,125,625",
                   help="seconds to wait before each retry of a failed table (comma-delimited, empty = no retry)")
    return p


def job_from_args(a: argparse.Namespace) -> ExportJob:
    def sql_file(path):
        if not path:
            return ()
        with open(path, encoding="utf-8") as fh:
            return (fh.read(),)

    return ExportJob(
        destination=a.destination, catalog=a.catalog, schemas=_list(a.schema), tables=_list(a.table),
        table_priorities=_list(a.prioritize_table), tables_split=_list(a.split_table), unionize=_list(a.unionize_query),
        table_exclusions=_list(a.exclude_table), column_exclusions=_list(a.exclude_column),
        split_strategies=tuple(a.split_table_strategy), primary_keys=_pairs(a.primary_key),
        partition_columns=_pairs(a.partition_column), pre_sql=sql_file(a.pre_sql), post_sql=sql_file(a.post_sql),
        flavor=a.flavor, string_datetime=a.datetime_string, string_datetime_suffix=a.datetime_string_suffix,
        filename_pattern=a.filename_pattern, fetch_rows=a.fetch_row_count, avro_size=a.avro_size, codec=a.avro_codec,
        tidy_tables=a.tidy_tables, continue_on_exception=a.continue_on_exception, increment_factor=a.increment_factor,
        exactly_once=not a.as_written, content_check=a.content_check, retry_waits=tuple(int(x) for x in _list(a.retry_waits)))


def main(argv: list[str] | None = None, spark=None) -> int:
    a = parser().parse_args(argv)
    job = job_from_args(a)
    from pyspark.sql import SparkSession

    from .run import export_database
    from .sources.catalog import DirectoryCatalog, JdbcCatalog, SparkCatalogSource

    spark = spark or SparkSession.builder.appName("tablexport").getOrCreate()
    if a.source_dir:
        source = DirectoryCatalog(spark, a.source_dir, catalog=a.catalog, primary_keys=job.primary_keys)
    elif a.spark_database:
        db = None if a.spark_database == "temp" else a.spark_database
        source = SparkCatalogSource(spark, db, catalog=a.catalog, primary_keys=job.primary_keys)
    else:
        props = {}
        if a.user:
            props["user"] = a.user
        if a.password_file:
            with open(a.password_file, encoding="utf-8") as fh:
                props["password"] = fh.read().strip()
        elif a.password:
            props["password"] = a.password
        source = JdbcCatalog(spark, a.connect, props, flavor=a.flavor, catalog=a.catalog, fetch_size=a.fetch_row_count,
                             dirty_reads=a.dirty_reads, snapshot=a.snapshot)
    try:
        res = export_database(spark, job, source, threads=a.threads, resume=a.resume, manifest_name=a.log_file)
    except Exception as e:  # noqa: BLE001 - a failed table ends the run with status 1
        print(json.dumps({"error": f"{type(e).__name__}: {e}"}), file=sys.stderr)
        return 1
    print(json.dumps({"manifest": res.manifest_path, "runtimeMs": res.runtime_ms,
                      "tables": [{"table": f"{t.schema}.{t.table}", "strategy": t.strategy, "chunks": t.table_query_count,
                                  "ok": t.ok} for t in res.tables]}))
    return 1 if res.failed and not job.continue_on_exception else 0


if __name__ == "__main__":
    sys.exit(main())
