"""The command line maps the export tool's options onto one export."""

import json

from tablexport.cli import main, parser, job_from_args
from tablexport.sources.avro_sink import FORMAT

from .conftest import SF001


def test_options_map_to_job():
    a = parser().parse_args(["--source-dir", SF001, "--destination", "/x", "--table", "dbo.orders, dbo.part",
                             "--split-table-strategy", "orders,range,o_orderdate,date,12",
                             "--split-table-strategy", 'part,query,"p_brand"', "--exclude-column", r".*\.p_name",
                             "--datetime-string", "true", "--avro-codec", "deflate", "--primary-key", "part=p_partkey",
                             "--as-written"])
    job = job_from_args(a)
    assert job.tables == ("dbo.orders", "dbo.part") and len(job.split_strategies) == 2
    assert job.string_datetime and job.codec == "deflate" and not job.exactly_once
    assert job.primary_keys == {"part": ["p_partkey"]}


def test_cli_exports(spark, tmp_dest, capsys):
    rc = main(["--source-dir", SF001, "--destination", tmp_dest, "--table", "dbo.orders,dbo.region",
               "--split-table-strategy", "orders,range,o_orderdate,date,12", "--log-file", "run.json"], spark=spark)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 0 and out["manifest"].endswith("run.json")
    assert {t["table"]: t["strategy"] for t in out["tables"]} == {"dbo.orders": "strategies", "dbo.region": "whole"}
    n = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert spark.read.format(FORMAT).option("glob", "dbo.orders-*").load(tmp_dest).count() == n


def test_cli_failure_exit_code(spark, tmp_dest, capsys):
    args = ["--source-dir", SF001, "--destination", tmp_dest, "--table", "dbo.part",
            "--split-table-strategy", "part,between,p_nothere,number,10", "--retry-waits", ""]
    assert main(args + ["--continue-on-exception", "true"], spark=spark) == 0
    assert main(args, spark=spark) == 1


def test_cli_spark_catalog_source(spark, tmp_dest, capsys):
    spark.read.parquet(f"{SF001}/region.parquet").createOrReplaceTempView("tx_cli_region")
    try:
        rc = main(["--spark-database", "temp", "--destination", tmp_dest, "--table", "temp.tx_cli_region",
                   "--retry-waits", ""], spark=spark)
    finally:
        spark.catalog.dropTempView("tx_cli_region")
    assert rc == 0
    assert spark.read.format(FORMAT).load(tmp_dest).count() == 5


def test_cli_database_unreachable_exits_1(spark, tmp_path, capsys):
    pw = tmp_path / "pw"
    pw.write_text("secret\n")
    rc = main(["--connect", "jdbc:nothing:here", "--user", "u", "--password-file", str(pw),
               "--destination", str(tmp_path / "out"), "--retry-waits", ""], spark=spark)
    assert rc == 1
    assert "ConnectionError" in capsys.readouterr().err
