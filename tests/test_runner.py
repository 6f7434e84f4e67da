"""The export runner: whole jobs on the smallest driver tables."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from tablexport.plans.job import ExportJob
from tablexport.run import export_database
from tablexport.sources.avro_sink import FORMAT
from tablexport.sources.catalog import DirectoryCatalog, SparkCatalogSource

from .conftest import SF001


def _job(dest, **kw):
    kw.setdefault("retry_waits", ())
    return ExportJob(destination=dest, **kw)


def test_export_and_manifest(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.orders", "dbo.embeddings", "dbo.region"),
               split_strategies=("orders,range,o_orderdate,date,12",), string_datetime=True, flavor="oracle",
               column_exclusions=(r"dbo\.embeddings\.(vec_id|label)",))
    res = export_database(spark, job, DirectoryCatalog(spark, SF001), threads=2)
    by = {t.table: t for t in res.tables}
    assert by["embeddings"].strategy == "skipped" and by["region"].strategy == "whole"
    roll = {r["table"]: r for r in res.rollup.collect()}
    n_orders = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert roll["orders"]["export_row_count"] == n_orders == roll["orders"]["db_row_count"]
    m = json.load(open(res.manifest_path))
    assert {o["table"] for o in m["outputList"]} == {"orders", "embeddings", "region"}
    assert m["runtimeMs"] > 0 and m["failedAvro"] == []
    back = spark.read.format(FORMAT).option("glob", "dbo.orders-*").load(tmp_dest)
    assert "o_orderdate__dt_str" in back.columns
    assert back.filter(F.col("o_orderdate__dt_str").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$")).count() == n_orders
    assert spark.read.format(FORMAT).option("glob", "dbo.region-*").load(tmp_dest).count() == 5
    chunks = spark.read.json(tmp_dest + "/_manifest/chunks")
    assert chunks.filter(F.col("query").startswith("Id- 0000001: query- <")).count() == 1


def test_continue_on_exception(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.part", "dbo.region"), continue_on_exception=True,
               split_strategies=("part,between,p_nothere,number,10",))
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    assert [t.table for t in res.failed] == ["part"]
    assert json.load(open(res.manifest_path))["failedAvro"][0]["table"] == "part"
    with pytest.raises(Exception):
        export_database(spark, _job(tmp_dest + "2", tables=("dbo.part",),
                                    split_strategies=("part,between,p_nothere,number,10",)),
                        DirectoryCatalog(spark, SF001))


def test_resume_skips_committed_chunks(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.orders",), split_strategies=("orders,between,o_orderkey,number,99",))
    cat = DirectoryCatalog(spark, SF001)
    first = export_database(spark, job, cat)
    n_files = len(glob.glob(tmp_dest + "/*.avro"))
    again = export_database(spark, job, cat, resume=True)
    assert len(glob.glob(tmp_dest + "/*.avro")) == n_files  # nothing left to do
    assert spark.read.format(FORMAT).load(tmp_dest).count() == spark.read.parquet(f"{SF001}/orders.parquet").count()


def test_union_batches_dedupes_within_batch(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.orders",), unionize=("dbo.orders",), union_batch=100,
               split_strategies=("orders,between,o_orderkey,number,9,0,14999",),
               column_exclusions=(r"dbo\.orders\.o_(orderkey|custkey|totalprice|orderdate)",))
    export_database(spark, job, DirectoryCatalog(spark, SF001))
    back = spark.read.format(FORMAT).load(tmp_dest)
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    expect = o.select((F.expr("o_orderkey div 1000") + 1).alias("b"), "o_orderstatus", "o_orderpriority").distinct().count()
    assert back.count() == expect


def test_pre_post_sql_and_spark_catalog(spark, tmp_dest):
    path = f"{SF001}/orders.parquet"
    job = _job(tmp_dest, tables=("temp.tx_test_view",),
               pre_sql=(f"CREATE OR REPLACE TEMP VIEW tx_test_view AS SELECT * FROM parquet.`{path}` "
                        "WHERE o_orderstatus = 'F'; SELECT 1",),
               post_sql=("DROP VIEW IF EXISTS tx_test_view",))
    res = export_database(spark, job, SparkCatalogSource(spark))
    n = spark.read.parquet(path).filter("o_orderstatus = 'F'").count()
    assert res.rollup.collect()[0]["export_row_count"] == n
    assert not spark.catalog.tableExists("tx_test_view")


def test_balanced_partitioned_export(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.lineitem",), partition_columns={"lineitem": ["l_returnflag"]},
               primary_keys={"lineitem": ["l_orderkey"]}, balanced_chunks=8, codec="deflate")
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    t = res.tables[0]
    assert t.strategy == "balanced_partitioned" and t.table_query_count <= 3 * 8 + 1
    n = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert spark.read.format(FORMAT).load(tmp_dest).count() == n


def test_nothing_exportable_still_reports(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.embeddings",), column_exclusions=(r"dbo\.embeddings\.(vec_id|label)",))
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    assert res.tables[0].strategy == "skipped" and res.stats.count() == 0
    assert json.load(open(res.manifest_path))["outputList"][0]["export_row_count"] == 0


def test_destination_that_is_a_file_is_refused(spark, tmp_path):
    f = tmp_path / "afile"
    f.write_text("x")
    with pytest.raises(NotADirectoryError):
        export_database(spark, _job(str(f), tables=("dbo.region",)), DirectoryCatalog(spark, SF001))


def test_skewed_chunk_is_split_across_writers(spark, tmp_path):
    """One chunk holds a third of the rows: the rebalance exchange splits it over several tasks
    (several files), and every row is still written exactly once."""
    from tablexport.sources.catalog import DirectoryCatalog as DC
    root = str(tmp_path / "wh")
    n = 120_000
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50)
                               .alias("bucket"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    df.repartition(8).write.parquet(f"{root}/skewed")
    keys = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                              "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        job = _job(str(tmp_path / "out"), tables=("dbo.skewed",), split_strategies=("skewed,query,bucket",))
        res = export_database(spark, job, DC(spark, root))
    finally:
        for k, v in keys.items():
            spark.conf.set(k, v)
    stats = {r["label"]: r for r in res.stats.collect()}
    hot = stats["7"]
    assert hot["export_row_count"] == sum(1 for i in range(n) if i % 3 == 0 or i % 50 == 7)
    assert hot["query_file_count"] > 1  # split over several writer tasks
    back = spark.read.format(FORMAT).load(str(tmp_path / "out"))
    assert back.count() == n and back.select("id").distinct().count() == n


def test_chunk_status_events(spark, tmp_dest):
    from tablexport.operators.stats import chunk_events
    job = _job(tmp_dest, tables=("dbo.orders",), split_strategies=("orders,range,o_orderdate,date,12",))
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    ev = chunk_events(res.stats)
    by = {}
    for r in ev.collect():
        by.setdefault(r["query_id"], {})[r["status"]] = r["time"]
    written = [q for q, e in by.items() if "Started" in e]
    assert written and all(by[q]["Created"] <= by[q]["Started"] <= by[q]["Completed"] for q in written)
    assert {"Created", "Completed"} <= set(by["0000008"])  # the empty residual chunk was planned, never started


def test_small_manifest_lists_chunks_inline(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.orders",), split_strategies=("orders,range,o_orderdate,date,12",))
    res = export_database(spark, job, DirectoryCatalog(spark, SF001))
    out = json.load(open(res.manifest_path))["outputList"][0]
    assert len(out["queries"]) == len(out["statisticsList"]) == out["table_query_count"]
    assert out["queries"][0].startswith("Id- 0000001: query- < ")
    assert sum(s["export_row_count"] for s in out["statisticsList"]) == out["export_row_count"]


def test_pattern_without_tidy_and_with_part(spark, tmp_dest):
    job = _job(tmp_dest, tables=("dbo.region",), catalog=None, tidy_tables=False,
               filename_pattern="%{CATALOG}_%{SCHEMA}_%{TABLE}_%{PART}.avro")
    export_database(spark, job, DirectoryCatalog(spark, SF001, catalog="TestDB"))
    names = sorted(p.split("/")[-1] for p in glob.glob(tmp_dest + "/*.avro"))
    assert names and all(n.startswith("TestDB_dbo_region-0000001_") and n.endswith(".avro") for n in names)


def test_spark_catalog_database_source(spark, tmp_path):
    loc = str(tmp_path / "tbl")
    spark.sql("CREATE DATABASE IF NOT EXISTS tx_test_db")
    try:
        spark.sql(f"CREATE TABLE tx_test_db.nation_copy USING parquet LOCATION '{loc}' AS "
                  f"SELECT * FROM parquet.`{SF001}/nation.parquet`")
        src = SparkCatalogSource(spark, "tx_test_db")
        assert [(r["schema"], r["table"]) for r in src.tables().collect()] == [("tx_test_db", "nation_copy")]
        job = _job(str(tmp_path / "out"), split_strategies=("nation_copy,between,n_nationkey,number,4",))
        res = export_database(spark, job, src)
        assert res.tables[0].strategy == "strategies"
        roll = res.rollup.collect()[0]
        assert roll["export_row_count"] == roll["db_row_count"] == 25
    finally:
        spark.sql("DROP TABLE IF EXISTS tx_test_db.nation_copy")
        spark.sql("DROP DATABASE IF EXISTS tx_test_db")
