"""Benchmark: export throughput of the headline export shapes.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line:
{"metric": "export_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ..., ...}

Shapes (all on lineitem, the largest table, snappy Avro):
  whole_table     one chunk, every task writes its own part
  number_50       between split, auto range + auto increment (about 50 chunks)
  date_yearly     yearly range split on l_shipdate
  balanced_256    weight-balanced chunks (256) on l_orderkey
  like_prefix     number-like split on l_partkey 1..9 (exactly once)
  read_back       reading the whole-table export back through the Avro source

The given table is one row group, so that its scan is one task: "files" has
two of the shapes over all its rows in several files, outside the total.
"phases" splits each export into planning, writing and reporting.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tablexport.plans.job import ExportJob  # noqa: E402
from tablexport.run import export_database  # noqa: E402
from tablexport.session import RECOMMENDED_CONF, scratch_path  # noqa: E402
from tablexport.sources.avro_sink import FORMAT, register  # noqa: E402
from tablexport.sources.catalog import DirectoryCatalog  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder.master(f"local[{cpus}]").appName("tablexport-bench")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
         .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC"))
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    register(spark)
    cat = DirectoryCatalog(spark, sf_dir, primary_keys={"lineitem": ["l_orderkey"]})
    n_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()

    shapes = {
        "whole_table": dict(),
        "number_50": dict(split_strategies=("lineitem,between,l_orderkey,number",)),
        "date_yearly": dict(split_strategies=("lineitem,range,l_shipdate,date,12",)),
        "balanced_256": dict(tables_split=("dbo.lineitem",)),
        "like_prefix": dict(split_strategies=("lineitem,like,l_partkey,number,1,1,9",)),
    }
    times, chunks, dests, phases, files = {}, {}, {}, {}, {}
    # warm-up: JVM, Python workers, parquet footer cache (not timed)
    export_database(spark, ExportJob(destination=scratch_path(spark, "bench-warm"), tables=("dbo.region",),
                                     retry_waits=()), cat, count_rows=False)

    def export(source, name, kw):
        dests[name] = scratch_path(spark, f"bench-{name}")
        job = ExportJob(destination=dests[name], tables=("dbo.lineitem",), retry_waits=(), **kw)
        t0 = time.time()
        res = export_database(spark, job, source, count_rows=False)
        chunks[name] = res.tables[0].table_query_count
        phases[name] = res.timings
        return round(time.time() - t0, 3)

    for name, kw in shapes.items():
        times[name] = export(cat, name, kw)
    t0 = time.time()
    back = spark.read.format(FORMAT).load(dests["whole_table"]).count()
    times["read_back"] = round(time.time() - t0, 3)
    if back != n_rows:
        raise SystemExit(f"read back {back} rows, expected {n_rows}")
    several = scratch_path(spark, "bench-input")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(2 * int(cpus)).write.parquet(f"{several}/lineitem.parquet")
    for name in ("whole_table", "number_50"):
        files[name] = export(DirectoryCatalog(spark, several, primary_keys={"lineitem": ["l_orderkey"]}), f"{name}_files", shapes[name])
    total = round(sum(v for k, v in times.items()), 3)
    export_secs = sum(v for k, v in times.items() if k != "read_back")
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "export_total_sec", "value": total, "unit": "sec", "queries": times,
        "sf": float(sf.group(1)) if sf else sf_dir, "rows": n_rows, "chunks": chunks,
        "rows_per_sec_export": round(n_rows * (len(shapes)) / export_secs, 1), "cpus": int(cpus),
        "files": files, "phases": phases,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
