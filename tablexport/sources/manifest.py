"""Job manifest (JSON) and resume.

``job.json`` (pretty-printed): the job definition, one roll-up entry per
table (``outputList``), failed tables (``failedAvro``) and ``runtimeMs``;
times as ``yyyy-MM-dd HH:mm:ss``. Per-chunk statistics are a JSON dataset written by Spark next to it
(``_manifest/chunks/``, one ``Id- <id>: query- <chunk>`` line per chunk, with the ``run_id``), which
``chunkStatistics`` names; each executor writes its own part of it. A run of at most ``manifest_chunks`` chunks also has them
inline (``queries``, ``statisticsList``): more never reach the driver. ``manifest_chunks`` reads the dataset.

Resume: planned chunks ``left_anti`` the chunks already in the manifest
file index = what is still to do.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .avro_sink import _fs

TS_FORMAT = "%Y-%m-%d %H:%M:%S"
CHUNKS = "_manifest/chunks"  # below the destination


def _json_default(o):
    if isinstance(o, (_dt.datetime,)):
        return o.strftime(TS_FORMAT)
    if isinstance(o, _dt.date):
        return o.isoformat()
    return str(o)


def write_chunk_stats(stats: DataFrame, destination: str, run_id: str) -> str:
    """Per-chunk statistics (with their ``label``) as a Spark-written JSON dataset (distributed)."""
    out = stats.withColumn("query", F.concat(F.lit("Id- "), F.col("query_id"), F.lit(": query- "),
                                             F.coalesce(F.col("label"), F.lit(""))))
    out.withColumn("start_time", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss")) \
       .withColumn("end_time", F.date_format("end_time", "yyyy-MM-dd HH:mm:ss")) \
       .withColumn("run_id", F.lit(run_id)) \
       .write.mode("append").json(f"{destination.rstrip('/')}/{CHUNKS}")
    return CHUNKS


def write_job_manifest(job_dict: dict, rollup_rows: list[dict], failed: list[dict], runtime_ms: int,
                       path: str, chunks: list | None) -> str:
    """Write the pretty-printed job manifest: the job, a roll-up for each table, the failures.

    ``chunks``: the chunk statistics to list inline, few by the job's ``manifest_chunks``; None leaves them to the dataset."""
    by_table: dict = {}
    for r in chunks or ():
        by_table.setdefault((r["schema"], r["table"]), []).append(r)
    tables = []
    for entry in sorted(rollup_rows, key=lambda r: (r["schema"], r["table"])):
        if chunks is not None:
            rows = sorted(by_table.get((entry["schema"], entry["table"]), ()), key=lambda r: r["query_id"])
            entry = entry | {"queries": [f"Id- {r['query_id']}: query- {r.get('label') or ''}" for r in rows],
                             "statisticsList": [{k: v for k, v in r.items() if k not in ("catalog", "schema", "table", "label")} for r in rows]}
        tables.append(entry)
    doc = dict(job_dict) | {"failedAvro": failed, "runtimeMs": int(runtime_ms), "chunkStatistics": CHUNKS, "outputList": tables}
    fs, p = _fs(path)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(p) as out:
        out.write(json.dumps(doc, indent=2, default=_json_default).encode())
    return p


def read_job_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as a DataFrame (multi-line JSON)."""
    return spark.read.option("multiLine", "true").json(path)


def manifest_tables(spark: SparkSession, path: str) -> DataFrame:
    """One row per table of ``outputList``."""
    m = read_job_manifest(spark, path)
    return m.select(F.explode("outputList").alias("o")).select("o.*")


def manifest_chunks(spark: SparkSession, destination: str, run_id: str | None = None) -> DataFrame:
    """One row per chunk of a destination's runs (or of one run), as the executors wrote them."""
    rows = spark.read.json(f"{destination.rstrip('/')}/{CHUNKS}")
    return rows if run_id is None else rows.where(F.col("run_id") == run_id)


def pending_chunks(planned: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Planned chunks not yet in the manifest (``left_anti`` on ``keys``)."""
    return planned.join(done.select(*keys).distinct(), keys, "left_anti")
