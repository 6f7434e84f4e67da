"""Catalog and selection operators on the metadata fixture and on the driver's tables."""

import pytest
from pyspark.sql import functions as F

from tablexport.functions.columns import (chunk_id_text, expand_pattern, pattern_col, tidy_columns, tidy_name,
                                          datetime_text_126)
from tablexport.operators import catalog_ops as co
from tablexport.sources.catalog import COLUMNS_SCHEMA, DirectoryCatalog, is_supported_code

from .conftest import SF001

# the metadata fixture: (catalog, schema, table, ordinal, column, jdbc_type, vendor_type, is_key)
META = [
    ("db", "dbo", "note", 1, "note_id", -5, "bigint", True),
    ("db", "dbo", "note", 2, "note_text", -1, "text", False),
    ("db", "dbo", "note", 3, "created", 93, "datetime2", False),
    ("db", "dbo", "note", 4, "born", 91, "date", False),
    ("db", "dbo", "note", 5, "updated", -155, "datetimeoffset", False),
    ("db", "dbo", "note", 6, "shape", 1111, "geometry", False),
    ("db", "dbo", "note", 7, "ssn", 12, "varchar", False),
    ("db", "dbo", "blobs_only", 1, "shape", 1111, "geometry", False),
    ("db", "dbo", "sysdiagrams", 1, "id", 4, "int", True),
    ("db", "hr", "employees", 1, "hired", 93, "DATE", False),
]


@pytest.fixture()
def meta(spark):
    rows = [r + (is_supported_code(r[5]),) for r in META]
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def test_exclusions_and_exportable(spark, meta):
    m = co.mark_excluded(meta, [r".*\.SSN", r"dbo\.sysdiag"])
    got = {(r["table"], r["column"]): (r["excluded"], r["exportable"]) for r in m.collect()}
    assert got[("note", "ssn")] == (True, False)
    assert got[("note", "updated")] == (False, False) and got[("note", "shape")] == (False, False)
    assert got[("sysdiagrams", "id")] == (False, True)  # no full match
    m2 = co.mark_excluded(meta, [r"dbo\.sysdiag.*"])
    assert {(r["table"], r["exportable"]) for r in m2.filter("table = 'sysdiagrams'").collect()} == {("sysdiagrams", False)}


def test_skip_and_unsupported(spark, meta):
    m = co.mark_excluded(meta, [r".*\.SSN"])
    assert {r["table"] for r in co.skip_empty_tables(m).collect()} == {"blobs_only"}
    rep = {r["table"]: r["unsupported"] for r in co.unsupported_columns(meta).collect()}
    assert rep["note"] == "updated (datetimeoffset,-155), shape (geometry,1111)"


def test_table_selection(spark):
    cat = DirectoryCatalog(spark, SF001)
    t = cat.tables()
    assert co.filter_tables(t, ["dbo.orders", "dbo.nope"]).count() == 1
    assert co.filter_schemas(t, ["hr"]).count() == 0
    assert co.exclude_tables(t, [r"DBO\.ORDERS"]).count() == 13
    assert co.exclude_tables(t, [r"dbo\.ord"]).count() == 14  # full match only
    pri = co.prioritized_tables(t, ["dbo.orders", "dbo.missing", "dbo.orders"], ["dbo.lineitem"])
    order = [r["table"] for r in pri.orderBy("priority").collect()]
    assert order[:3] == ["orders", "lineitem", "benchmark"] and len(order) == 14
    assert {r["table"] for r in co.tables_existing(t, ["dbo.orders", "dbo.missing"], []).collect()} == {"orders"}


def test_directory_catalog_columns(spark):
    cat = DirectoryCatalog(spark, SF001, primary_keys={"orders": ["o_orderkey"]})
    cols = cat.columns([("dbo", "orders"), ("dbo", "embeddings")]).collect()
    by = {(r["table"], r["column"]): r for r in cols}
    assert by[("orders", "o_orderkey")]["is_key"] and by[("orders", "o_orderkey")]["jdbc_type"] == -5
    assert by[("orders", "o_orderdate")]["jdbc_type"] == 93
    assert not by[("embeddings", "embedding")]["supported"]


def test_names():
    assert tidy_name("Brand#1") == "brand_1" and tidy_name(" a") == "_a" and tidy_name("É") == "_"
    assert chunk_id_text(1) == "0000001" and chunk_id_text(123456789) == "123456789"
    assert expand_pattern("%{SCHEMA}.%{TABLE}-%{PART}.avro", None, "DBO", "My Table", "0000002", "p1") == \
        "dbo.my_table-0000002-p1.avro"
    assert expand_pattern("%{CATALOG}/%{TABLE}.avro", None, None, "t", "") == "catalog/t.avro"


def test_tidy_columns_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError):
        tidy_columns(df)


def test_pattern_col_and_126(spark):
    import datetime as dt
    df = spark.createDataFrame([("0000003", dt.datetime(2020, 1, 1)), ("0000004", dt.datetime(2020, 1, 1, 0, 0, 0, 3000)),
                                ("0000005", dt.datetime(2020, 1, 1, 0, 0, 0, 123456))], "c string, t timestamp_ntz")
    rows = df.select(pattern_col("%{SCHEMA}.%{TABLE}.avro", None, "dbo", "orders", F.col("c")).alias("p"),
                     datetime_text_126(F.col("t")).alias("s")).collect()
    assert [r["p"] for r in rows] == ["dbo.orders-0000003.avro", "dbo.orders-0000004.avro", "dbo.orders-0000005.avro"]
    assert [r["s"] for r in rows] == ["2020-01-01T00:00:00", "2020-01-01T00:00:00.003000", "2020-01-01T00:00:00.123456"]


def test_table_folders_schemas_and_partitions(spark, tmp_path):
    root = str(tmp_path / "wh")
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    o.write.parquet(f"{root}/plain_folder")                                   # folder of part files
    o.write.partitionBy("o_orderstatus").parquet(f"{root}/sales/by_status")   # schema 'sales', partitioned
    o.limit(10).write.parquet(f"{root}/sales/small.parquet")                  # folder named *.parquet
    cat = DirectoryCatalog(spark, root)
    got = sorted((r["schema"], r["table"]) for r in cat.tables().collect())
    assert got == [("dbo", "plain_folder"), ("sales", "by_status"), ("sales", "small")]
    assert cat.partition_columns("sales", "by_status") == ["o_orderstatus"]
    assert cat.partition_columns("dbo", "plain_folder") == []
    assert cat.read("sales", "by_status").count() == o.count()
    cols = [r["column"] for r in cat.columns([("sales", "by_status")]).orderBy("ordinal").collect()]
    assert cols[-1] == "o_orderstatus"


def test_ntz_text_ignores_session_time_zone(spark):
    import datetime as dt
    from tablexport.functions.columns import convert_datetimes
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 0),), (dt.datetime(2024, 3, 10, 2, 30, 0, 5000),),
                                    (dt.datetime(1999, 12, 31, 23, 59, 59, 999999),)], "t timestamp_ntz")
        a = [r[0] for r in convert_datetimes(df, "sqlserver", "_s").collect()]
        b = [r[0] for r in convert_datetimes(df, "oracle", "_s").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert a == ["2024-03-10T02:30:00", "2024-03-10T02:30:00.005000", "1999-12-31T23:59:59.999999"]
    assert b == ["2024-03-10T02:30:00", "2024-03-10T02:30:00", "1999-12-31T23:59:59"]


def test_partition_flags(spark, tmp_path):
    root = str(tmp_path / "wh")
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    li.write.partitionBy("l_returnflag", "l_linestatus").parquet(f"{root}/li_two")
    li.write.partitionBy("l_returnflag").parquet(f"{root}/li_one")
    li.write.parquet(f"{root}/li_none")
    got = {r["table"]: (r["partitioned"], r["sub_partitioned"], r["partition_columns"])
           for r in co.partition_flags(DirectoryCatalog(spark, root)).collect()}
    assert got == {"li_two": (True, True, ["l_returnflag", "l_linestatus"]),
                   "li_one": (True, False, ["l_returnflag"]), "li_none": (False, False, [])}
