"""Chunks that name the storage partition of a database, and reads pinned to one moment; DuckDB runs the SQL."""

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tablexport.plans.job import ExportJob
from tablexport.run import export_database
from tablexport.sources.avro_sink import FORMAT
from tablexport.sources.catalog import JdbcCatalog, Stored
from tablexport.sources.jdbc import Dialect, scope_of, stored_chunks

from .conftest import SF001
from .test_jdbc_runner import DuckJdbc

FLAGS = "RNA"


class PartedDuck(DuckJdbc):
    """lineitem kept in a partition for each flag: named ones are views, numbered ones an expression."""

    def __init__(self, spark, root, named):
        super().__init__(spark, root)
        self.named = named
        for f in FLAGS:
            self.con.execute(f"CREATE VIEW dbo.\"lineitem@{f}\" AS SELECT * FROM dbo.lineitem WHERE l_returnflag = '{f}'")

    def qualified(self, schema, table, scope=""):
        m = re.fullmatch(r' PARTITION \("(.)"\)', scope)
        return super().qualified(schema, f"{table}@{m[1]}" if m else table, "" if m else scope)

    def storage_partitions(self, schema, table):
        if table != "lineitem":
            return []
        return [Stored(f"partition {f}", f' PARTITION ("{f}")') if self.named else Stored(f"partition {ord(f)}", "", "ASCII(\"l_returnflag\")", ord(f), "l_returnflag") for f in FLAGS]


@pytest.mark.parametrize("named", [True, False])
@pytest.mark.parametrize("exactly_once", [True, False])
def test_export_reads_each_storage_partition_by_name(spark, tmp_dest, named, exactly_once):
    src = PartedDuck(spark, SF001, named)
    job = ExportJob(destination=tmp_dest, tables=("dbo.lineitem",), retry_waits=(), balanced_chunks=4, exactly_once=exactly_once,
                    primary_keys={"lineitem": ["l_orderkey"]}, column_exclusions=(r".*\.l_returnflag",), commit_chunks=5)
    res = export_database(spark, job, src, count_rows=False)
    assert res.tables[0].strategy == "balanced_partitioned"
    t = spark.read.parquet(f"{SF001}/lineitem.parquet")
    expected = t.select("l_orderkey", "l_linenumber", "l_quantity")
    got = spark.read.format(FORMAT).load(tmp_dest).select("l_orderkey", "l_linenumber", "l_quantity")
    assert got.count() == expected.count() and got.exceptAll(expected).count() == 0
    chunks = {r["query_id"]: (r["label"], r["export_row_count"]) for r in res.stats.collect()}
    per_flag = {r["l_returnflag"]: r["count"] for r in t.groupBy("l_returnflag").count().collect()}
    of = lambda f: f'"lineitem@{f}"' if named else f'ASCII("l_returnflag") = {ord(f)}'
    numbers = []
    for f in FLAGS:
        mine = {no: n for no, (label, n) in chunks.items() if of(f) in label}
        numbers += sorted(mine)
        assert 1 <= len(mine) <= 4 and sum(mine.values()) == per_flag[f]
        assert max(mine.values()) <= per_flag[f] / 4 + 8  # a key has seven rows at most
    assert numbers == sorted(chunks)  # ids run on over the partitions
    sent = len(src.sent)
    again = export_database(spark, job, src, count_rows=False, resume=True)
    assert not [q for q in src.sent[sent:] if q.startswith("partition ")] and again.stats.count() == len(chunks)


def test_stored_chunks_take_every_row_once_with_null_and_new_keys():
    con = duckdb.connect()
    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(30)]), rnd.randrange(4)) for _ in range(500)]
    con.execute("CREATE TABLE t (k INTEGER, p INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    stored = [Stored(f"partition {p}", "", "p", p) for p in (3, 2, 1, 0)]
    groups = {0: [(2, 9, 5), (12, 20, 5), (22, 25, 5)], 1: [(5, 6, 1), (8, 9, 1)], 2: [(4, 4, 1)]}
    once = stored_chunks(stored, groups, "k", Dialect("ansi"), True)
    assert [no for no, _, _ in once] == list(range(1, 8))
    hits = " + ".join(f"(CASE WHEN {p} THEN 1 ELSE 0 END)" for _, p, _ in once)
    assert con.execute(f"SELECT DISTINCT {hits} FROM t").fetchall() == [(1,)]
    written = stored_chunks(stored, groups, "k", Dialect("ansi"), False)
    assert [p for _, p, _ in written][0] == 'p = 3 AND ("k" BETWEEN 2 AND 9)' and len(written) == 6
    named = stored_chunks([Stored("x", ' PARTITION ("X")')], {}, "k", Dialect("oracle"), True)
    assert [scope_of(p) for _, p, _ in named] == [(' PARTITION ("X")', "1 = 1")]
    assert stored_chunks([], {}, "k", Dialect("oracle"), True) == []


class Dictionary(JdbcCatalog):
    def __init__(self, spark, rows, schema, **kw):
        super().__init__(spark, "jdbc:none", **kw)
        self.rows, self.schema, self.sent = rows, schema, []

    def _query(self, sql):
        self.sent.append(sql)
        return self.spark.createDataFrame(self.rows, self.schema)


def test_partitions_of_the_dictionaries(spark):
    schema = "SCHEMA_NAME string, TABLE_NAME string, PARTITION_NAME string, POSITION int, SUBPARTITION_NAME string, SUBPOSITION int"
    o = Dictionary(spark, [("S", "T", "P1", 1, None, None), ("S", "T", "P2", 2, "P2B", 2), ("S", "T", "P2", 2, "P2A", 1), ("S", "T", 'P"3', 3, None, None)], schema, flavor="oracle")
    assert [x.scope for x in o.storage_partitions("S", "T")] == [' PARTITION ("P""3")', ' SUBPARTITION ("P2B")', ' SUBPARTITION ("P2A")', ' PARTITION ("P1")']
    assert "d.schema_name = 'S' AND d.table_name = 'T'" in o.sent[0]
    chunks = stored_chunks(o.storage_partitions("S", "T")[1:2], {0: [(1, 5, 9), (6, 9, 9)]}, "K", o.dialect, True)
    assert o.chunk_sql("S", "T", ["A"], chunks[1][1]) == 'SELECT "A" FROM "S"."T" SUBPARTITION ("P2B") WHERE ("K" >= 6)'
    schema = "schema_name string, table_name string, position int, function_name string, column_name string"
    m = Dictionary(spark, [("dbo", "t", 1, "pf", "d"), ("dbo", "t", 2, "pf", "d")], schema, flavor="sqlserver", catalog="db")
    assert [x.condition for x in m.storage_partitions("dbo", "t")] == ["[db].$PARTITION.[pf]([d]) = 2", "[db].$PARTITION.[pf]([d]) = 1"]
    assert "[db].sys.partitions p" in m.sent[0]
    assert Dictionary(spark, [], schema, flavor="oracle").storage_partitions("S", "T") == []


def test_all_queries_read_one_moment(spark):
    o = Dictionary(spark, [(4711,)], "SCN long", flavor="oracle", snapshot=True)
    assert o.qualified("S", "T") == '"S"."T"' and o.pin() == "SCN 4711"
    assert o.qualified("S", "T", ' PARTITION ("P")') == '"S"."T" PARTITION ("P") AS OF SCN 4711'
    assert o.chunk_sql("S", "T", ["A"], None) == 'SELECT "A" FROM "S"."T" AS OF SCN 4711'
    fixed = Dictionary(spark, [], "SCN long", flavor="oracle", snapshot=99)
    assert fixed.pin() == "SCN 99" and not fixed.sent
    m = Dictionary(spark, [], "x int", flavor="sqlserver", snapshot=True)
    assert m.pin() == "SNAPSHOT" and m._props()["sessionInitStatement"] == "SET TRANSACTION ISOLATION LEVEL SNAPSHOT"
    assert Dictionary(spark, [], "x int", flavor="oracle").pin() is None
    with pytest.raises(ValueError):
        Dictionary(spark, [], "x int", flavor="ansi", snapshot=True).pin()
    with pytest.raises(ValueError):
        JdbcCatalog(spark, "jdbc:none", dirty_reads=True, snapshot=True)


def test_the_pinned_moment_is_in_every_query_and_the_manifest(spark, tmp_dest):
    class Pinned(DuckJdbc):
        def pin(self):
            self._moment = " /* AS OF SCN 7 */"
            return "SCN 7"

    src = Pinned(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), retry_waits=(), split_strategies=("orders,between,o_orderkey,number",))
    res = export_database(spark, job, src, count_rows=False)
    asked = [q for q in src.sent if " FROM " in q and "orders" in q]
    assert asked and all("AS OF SCN 7" in q for q in asked)
    doc = spark.read.option("multiLine", "true").json(res.manifest_path)
    assert doc.select("readMoment").collect()[0][0] == "SCN 7"
    assert res.stats.where(F.col("label").contains("AS OF SCN 7")).count() == res.stats.count()
