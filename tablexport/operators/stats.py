"""Per-chunk statistics, per-table roll-up, validation and audit.

The sink's commit writes one JSON line per file (``_manifest/files-*.json``);
everything here is Spark aggregation over those small records, or one
pass over the exported rows (``split_audit``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import chunk_id_col

FILES_SCHEMA = ("catalog string, schema string, table string, chunk long, name string, path string, rows long, "
                "bytes long, plain_bytes long, start string, end string, task long, run_id string, plan string, key string, content string")


def read_file_index(spark: SparkSession, destination: str) -> DataFrame:
    """Every file that is part of ``destination``, of every run (empty when nothing was written)."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.schema(FILES_SCHEMA + ", removes array<string>").json(f"{destination.rstrip('/')}/_manifest/files-*.json")
        df.inputFiles()  # resolves the glob now
        gone = df.select(F.explode("removes").alias("name")).distinct()
        return df.where("name is not null").drop("removes").join(gone, "name", "left_anti")
    except AnalysisException:
        from ..session import local_df
        return local_df(spark, [], FILES_SCHEMA)


def query_stats(files: DataFrame) -> DataFrame:
    """One row per exported chunk: status, query id, files, rows, bytes, times."""
    ts = lambda c: F.to_timestamp(F.col(c), "yyyy-MM-dd HH:mm:ss")
    g = (files.groupBy("catalog", "schema", "table", "chunk")
         .agg(F.count(F.lit(1)).alias("query_file_count"), F.sum("rows").alias("export_row_count"),
              F.sum("bytes").alias("total_bytes"), F.min(ts("start")).alias("start_time"),
              F.max(ts("end")).alias("end_time"), F.sort_array(F.collect_list("name")).alias("files")))
    return g.select(
        "catalog", "schema", "table", chunk_id_col(F.col("chunk")).alias("query_id"),
        F.lit("Completed").alias("status"), "query_file_count", "export_row_count", "total_bytes", "start_time",
        "end_time", (F.unix_timestamp("end_time") - F.unix_timestamp("start_time")).alias("time_taken_seconds"),
        "files")


def with_planned_chunks(stats: DataFrame, planned: DataFrame) -> DataFrame:
    """Every planned chunk (catalog, schema, table, query_id, label) with its statistics;
    a chunk that matched no row wrote no file and shows 0 rows / 0 files."""
    cond = (planned["catalog"].eqNullSafe(stats["catalog"]) & (planned["schema"] == stats["schema"])
            & (planned["table"] == stats["table"]) & (planned["query_id"] == stats["query_id"]))
    j = planned.join(stats, cond, "left")
    zero = F.lit(0).cast("long")
    return j.select(
        planned["catalog"], planned["schema"], planned["table"], planned["query_id"], planned["label"],
        *([planned["created_time"]] if "created_time" in planned.columns else []),
        F.lit("Completed").alias("status"), F.coalesce(stats["query_file_count"], zero).alias("query_file_count"),
        F.coalesce(stats["export_row_count"], zero).alias("export_row_count"),
        F.coalesce(stats["total_bytes"], zero).alias("total_bytes"), stats["start_time"], stats["end_time"],
        F.coalesce(stats["time_taken_seconds"], zero).alias("time_taken_seconds"),
        F.coalesce(stats["files"], F.array().cast("array<string>")).alias("files"))


def chunk_events(stats: DataFrame) -> DataFrame:
    """The status events of every chunk — Created (planned), Started (first file opened),
    Completed (last file closed) — one row each, unpivoted JVM-side with ``stack``."""
    has_created = "created_time" in stats.columns
    created = "created_time" if has_created else "CAST(NULL AS TIMESTAMP)"
    ev = stats.selectExpr("catalog", "schema", "table", "query_id",
                          f"stack(3, 'Created', {created}, 'Started', start_time, 'Completed', end_time) "
                          "AS (status, time)")
    return ev.filter(F.col("time").isNotNull() | (F.col("status") == "Completed"))


def table_rollup(stats: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Per (catalog, schema, table): query count, rows, files, bytes, start, end, seconds.

    ``tables`` (catalog, schema, table, db_row_count, table_query_count,
    split_strategies) adds what the plan knew; its query count wins (empty
    chunks write no file but are still queries)."""
    written = F.sum((F.col("query_file_count") > 0).cast("long"))
    r = (stats.groupBy("catalog", "schema", "table")
         .agg(written.alias("written_query_count"), F.sum("export_row_count").alias("export_row_count"),
              F.sum("query_file_count").alias("files_count"), F.sum("total_bytes").alias("total_bytes"),
              F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time")))
    r = r.withColumn("time_taken_seconds", F.unix_timestamp("end_time") - F.unix_timestamp("start_time"))
    if tables is not None:
        cond = (tables["catalog"].eqNullSafe(r["catalog"]) & (tables["schema"] == r["schema"])
                & (tables["table"] == r["table"]))
        r = tables.join(r, cond, "left").drop(r["catalog"]).drop(r["schema"]).drop(r["table"])
        r = r.withColumn("export_row_count", F.coalesce("export_row_count", F.lit(0).cast("long")))
    else:
        r = r.withColumn("table_query_count", F.col("written_query_count"))
    return r


def validate_row_counts(rollup: DataFrame, counts: DataFrame, contents: DataFrame | None = None) -> DataFrame:
    """Exported rows next to the source row count, with a mismatch flag.

    ``contents`` (schema, table, content_match per chunk; see ``content.check_content``) adds
    ``content_mismatch``: whether files of the table hold other values than were read."""
    j = counts.join(rollup.select("schema", "table", "export_row_count"), ["schema", "table"], "left")
    more = []
    if contents is not None:
        wrong = contents.groupBy("schema", "table").agg((~F.every("content_match")).alias("content_mismatch"))
        j, more = j.join(wrong, ["schema", "table"], "left"), ["content_mismatch"]
    return j.select("schema", "table", F.col("row_count").alias("db_row_count"),
                    F.coalesce("export_row_count", F.lit(0).cast("long")).alias("export_row_count"),
                    (F.col("row_count") != F.coalesce("export_row_count", F.lit(0).cast("long"))).alias("mismatch"), *more)


def split_audit(times: DataFrame) -> DataFrame:
    """How many rows are covered 0, 1, 2, ... times by a chunk list."""
    return times.groupBy("times").agg(F.count(F.lit(1)).alias("n"))
