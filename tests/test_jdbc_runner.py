"""The database export path without a database: a JdbcCatalog whose SQL is run by DuckDB.

Every query the export sends (bounds, DISTINCT, key weights, one query per
chunk predicate) is executed by DuckDB on the driver's tables; each predicate's
result becomes one single-partition DataFrame, exactly like Spark's JDBC
source gives one partition per predicate. The exported chunks must equal the
one-pass assignment over the same table read from Parquet."""

import glob
import json
from dataclasses import replace

import duckdb
import pytest
from pyspark.sql import functions as F

from tablexport.plans.chunks import plan_table
from tablexport.plans.job import ExportJob
from tablexport.plans.split_spec import SplitSpec
from tablexport.run import export_database
from tablexport.sources.avro_sink import FORMAT
from tablexport.sources.catalog import DirectoryCatalog, JdbcCatalog

from .conftest import SF001


class DuckJdbc(JdbcCatalog):
    def __init__(self, spark, root):
        super().__init__(spark, "jdbc:none", flavor="ansi")
        self.files = DirectoryCatalog(spark, root)
        self.con = duckdb.connect()
        self.con.execute("CREATE SCHEMA dbo")
        for t in ("orders", "part", "lineitem"):
            self.con.execute(f"CREATE VIEW dbo.{t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
        self.sent = []

    # metadata as the file catalog has it
    def tables(self):
        return self.files.tables().filter(F.col("table").isin("orders", "part", "lineitem"))

    def columns(self, tables=None):
        return self.files.columns(tables)

    def row_counts(self, tables=None):
        return self.files.row_counts(tables)

    def _df(self, sql):
        self.sent.append(sql)
        return self.spark.createDataFrame(self.con.execute(sql).to_arrow_table())

    def _query(self, sql):
        return self._df(sql)

    def check_connection(self, attempts=1, wait_seconds=5.0):
        self.con.execute("SELECT 1")

    def _read_predicates(self, source_sql, preds):
        # one RDD partition per predicate, in predicate order — what Spark's JDBC source builds
        schema = self._df(f"SELECT * FROM {source_sql} WHERE 1 = 0").schema
        blocks = [[tuple(r) for r in self.con.execute(f"SELECT * FROM {source_sql} WHERE {p}").fetchall()]
                  for p in preds]
        self.sent += [f"partition {i}: {p}" for i, p in enumerate(preds)]
        rdd = self.spark.sparkContext.parallelize(blocks, len(blocks)).flatMap(lambda b: b)
        return self.spark.createDataFrame(rdd, schema)


@pytest.mark.parametrize("spec", ["orders,between,o_orderkey,number",
                                  "orders,range,o_orderdate,date,12",
                                  'orders,query,"o_orderstatus;o_orderpriority"',
                                  "orders,like,o_custkey,number,1,1,12"])
@pytest.mark.parametrize("exactly_once", [True, False])
def test_database_export_matches_file_assignment(spark, tmp_dest, spec, exactly_once):
    src = DuckJdbc(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=(spec,), retry_waits=(),
                    exactly_once=exactly_once, column_exclusions=(r".*\.o_orderdate",))
    res = export_database(spark, job, src, count_rows=False)
    assert res.tables[0].strategy == "strategies"
    assert any("MIN(" in s or "DISTINCT" in s for s in src.sent) or "like" in spec
    got = {r["query_id"]: r["export_row_count"] for r in res.stats.collect()}
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = plan_table(o, [SplitSpec.parse(spec)], exactly_once=exactly_once)
    expect = {f"{r['chunk_no']:07d}": r["n"] for r in plan.summary(o).collect()}
    assert got == expect
    assert spark.read.format(FORMAT).load(tmp_dest).count() == sum(expect.values())
    q = spark.read.json(tmp_dest + "/_manifest/chunks").filter("query_id = '0000001'").collect()[0]["query"]
    assert q.startswith('Id- 0000001: query- SELECT "o_orderkey"') and ' FROM "dbo"."orders" WHERE ' in q


def test_database_balanced_partitioned(spark, tmp_dest):
    src = DuckJdbc(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.lineitem",), retry_waits=(), balanced_chunks=8,
                    partition_columns={"lineitem": ["l_returnflag"]}, primary_keys={"lineitem": ["l_orderkey"]})
    res = export_database(spark, job, src, count_rows=False)
    assert any("GROUP BY" in s for s in src.sent)
    n = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert spark.read.format(FORMAT).load(tmp_dest).count() == n
    stats = res.stats.collect()
    assert len(stats) == res.tables[0].table_query_count


def test_sqlserver_dictionary_query_runs_on_information_schema(spark):
    """The SQL Server column query is plain INFORMATION_SCHEMA SQL: run it on DuckDB tables with a key."""
    src = DuckJdbc(spark, SF001)
    src.flavor = "sqlserver"
    src.con.execute("CREATE TABLE dbo.t_keyed (id BIGINT PRIMARY KEY, name VARCHAR, price DOUBLE, born DATE, "
                    "tags VARCHAR[])")
    cols = {r["column"]: r for r in JdbcCatalog.columns(src).filter(F.col("table") == "t_keyed").collect()}
    assert [cols[c]["ordinal"] for c in ("id", "name", "price", "born", "tags")] == [1, 2, 3, 4, 5]
    assert cols["id"]["is_key"] and not cols["name"]["is_key"]
    assert (cols["id"]["jdbc_type"], cols["name"]["jdbc_type"], cols["born"]["jdbc_type"]) == (-5, 12, 91)
    assert cols["id"]["supported"] and not cols["tags"]["supported"]
    # views are not tables: the parquet views of the fake are not listed
    assert JdbcCatalog.columns(src).filter(F.col("table") == "orders").count() == 0
    # a table list is filtered by the database
    src.con.execute("CREATE TABLE dbo.t_other (x INTEGER)")
    only = JdbcCatalog.columns(src, [("dbo", "t_other")]).collect()
    assert [(r["table"], r["column"]) for r in only] == [("t_other", "x")]
    assert any("d.table_name = N't_other'" in q for q in src.sent)


@pytest.mark.parametrize("spec", ["orders,between,o_orderkey,number,9", "orders,like,o_custkey,number,1,1,120"])
@pytest.mark.parametrize("exactly_once", [True, False])
def test_each_chunk_is_one_query_whatever_their_number(spark, tmp_dest, spec, exactly_once):
    src = DuckJdbc(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=(spec,), retry_waits=(), exactly_once=exactly_once)
    res = export_database(spark, job, src, count_rows=False)
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    plan = plan_table(o, [SplitSpec.parse(spec)], exactly_once=exactly_once)
    assert len([s for s in src.sent if s.startswith("partition ")]) == plan.n_chunks
    got = {r["query_id"]: r["export_row_count"] for r in res.stats.collect()}
    expect = {f"{r['chunk_no']:07d}": r["n"] for r in plan.summary(o).collect()}
    assert got == expect
    assert spark.read.format(FORMAT).load(tmp_dest).count() == sum(expect.values())


def test_row_counts_per_flavor(spark, tmp_dest):
    """Oracle has no catalog row count (stays empty); the export still reports."""
    src = DuckJdbc(spark, SF001)
    src.row_counts = lambda tables=None: JdbcCatalog.row_counts(src, tables)  # the real method, not the fake's
    src.flavor = "oracle"
    assert JdbcCatalog.row_counts(src, [("dbo", "orders")]) is None
    src.flavor = "ansi"
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=("orders,range,o_orderdate,date,12",),
                    retry_waits=())
    res = export_database(spark, job, src)  # count_rows on: no catalog count for this flavor
    assert res.tables[0].ok and res.tables[0].db_row_count is None
    assert res.rollup.collect()[0]["export_row_count"] == spark.read.parquet(f"{SF001}/orders.parquet").count()


def test_database_whole_table_export(spark, tmp_dest):
    src = DuckJdbc(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.part",), retry_waits=(), string_datetime=True)
    res = export_database(spark, job, src, count_rows=False)
    assert res.tables[0].strategy == "whole" and res.tables[0].table_query_count == 1
    assert any(s.startswith('partition 0: 1 = 1') for s in src.sent)
    q = spark.read.json(tmp_dest + "/_manifest/chunks").collect()[0]["query"]
    assert q.startswith('Id- 0000001: query- SELECT "p_partkey"') and q.endswith('FROM "dbo"."part"')
    assert spark.read.format(FORMAT).load(tmp_dest).count() == spark.read.parquet(f"{SF001}/part.parquet").count()


class Faulty(DuckJdbc):
    """Fails on every query of a chunk whose predicate holds ``bad``; notes the predicates that were read."""

    bad, read = None, ()

    def _read_predicates(self, source_sql, preds):
        if self.bad and any(self.bad in p for p in preds):
            raise RuntimeError("the database went away")
        self.read = [*self.read, *preds]
        return super()._read_predicates(source_sql, preds)


def _rows(dest):
    """chunk -> rows of what the destination holds."""
    lines = [json.loads(x) for f in glob.glob(dest + "/_manifest/files-*.json") for x in open(f)]
    gone = {n for r in lines for n in r.get("removes", ())}
    out = {}
    for r in lines:
        if "chunk" in r and (r.get("name") or r.get("id")) not in gone:
            out[r["chunk"]] = out.get(r["chunk"], 0) + r["rows"]
    return out


SPLIT = "orders,between,o_orderkey,number,149,0,1499"  # ten chunks and the residual


def test_a_run_that_dies_in_a_table_keeps_the_chunks_before_it(spark, tmp_dest):
    src, n = Faulty(spark, SF001), spark.read.parquet(f"{SF001}/orders.parquet").count()
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=(SPLIT,), retry_waits=(), commit_chunks=3)
    src.bad = "BETWEEN 900 AND"
    with pytest.raises(RuntimeError):
        export_database(spark, job, src, count_rows=False)
    assert sorted(_rows(tmp_dest)) == [1, 2, 3, 4, 5, 6]
    src.bad, src.read = None, []
    res = export_database(spark, job, src, resume=True)
    assert len(src.read) == 5 and any("BETWEEN 900 AND" in p for p in src.read) and not any("BETWEEN 0 AND" in p for p in src.read if "CASE" not in p)
    assert sum(_rows(tmp_dest).values()) == n == spark.read.format(FORMAT).load(tmp_dest).count() and res.tables[0].complete
    src.read = []
    export_database(spark, job, src, resume=True)  # nothing is left, empty chunks included
    assert src.read == []


def test_only_the_chunk_that_fails_is_missing_and_a_resumed_run_reads_it_alone(spark, tmp_dest):
    src = Faulty(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=(SPLIT,), retry_waits=(), commit_chunks=4, continue_on_exception=True)
    src.bad = "BETWEEN 300 AND 449"
    job_as_written = replace(job, exactly_once=False)  # no residual, whose predicate names every chunk
    res = export_database(spark, job_as_written, src, count_rows=False)
    assert sorted(_rows(tmp_dest)) == [1, 2, 4, 5, 6, 7, 8, 9, 10] and not res.tables[0].complete
    failed = json.load(open(res.manifest_path))["failedAvro"]
    assert [f["chunk"] for f in failed] == [3] and "BETWEEN 300 AND 449" in failed[0]["query"] and "went away" in failed[0]["error"]
    src.bad, src.read = None, []
    export_database(spark, job_as_written, src, resume=True, count_rows=False)
    assert len(src.read) == 1 and "BETWEEN 300 AND 449" in src.read[0] and sorted(_rows(tmp_dest)) == list(range(1, 11))


def test_a_commit_is_retried_by_itself(spark, tmp_dest):
    class Once(Faulty):
        planned = 0

        def bounds(self, *a):
            self.planned += 1
            return super().bounds(*a)

        def _read_predicates(self, source_sql, preds):
            if len(self.read) == 4 and not self.bad:
                self.bad = "only once"
                raise RuntimeError("a moment's fault")
            self.read = [*self.read, *preds]
            return DuckJdbc._read_predicates(self, source_sql, preds)

    src = Once(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=("orders,between,o_orderkey,number",), retry_waits=(0,), commit_chunks=2, increment_factor=8)
    res = export_database(spark, job, src, count_rows=False)
    assert src.planned == 1 and len(src.read) == res.tables[0].table_query_count == len(set(src.read))
    assert sum(_rows(tmp_dest).values()) == spark.read.parquet(f"{SF001}/orders.parquet").count()


def test_files_of_two_plans_and_a_resumed_run_lose_no_row(spark, tmp_dest):
    src, n = Faulty(spark, SF001), spark.read.parquet(f"{SF001}/orders.parquet").count()
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=(SPLIT,), retry_waits=(), commit_chunks=3)
    other = replace(job, split_strategies=("orders,between,o_orderkey,number,499,0,1499",))
    export_database(spark, job, src, count_rows=False)
    export_database(spark, other, src, count_rows=False)
    assert sum(_rows(tmp_dest).values()) == 2 * n  # two runs, neither resumed: both are there
    src.read = []
    res = export_database(spark, job, src, resume=True)
    assert src.read == [] and sum(_rows(tmp_dest).values()) == n == res.rollup.first()["export_row_count"]
    # to another plan, stopped on the way: the old rows stay until all of the new ones are there
    export_database(spark, replace(other, max_commits=1), src, resume=True, count_rows=False)
    assert sum(_rows(tmp_dest).values()) == n == spark.read.format(FORMAT).load(tmp_dest).count() and len(_rows(tmp_dest)) == 11
    src.read = []
    export_database(spark, other, src, resume=True)
    assert len(src.read) == 1 and sum(_rows(tmp_dest).values()) == n == spark.read.format(FORMAT).load(tmp_dest).count() and len(_rows(tmp_dest)) == 4


def test_a_resumed_run_that_ends_with_other_rows_than_the_source_fails(spark, tmp_dest):
    src = Faulty(spark, SF001)
    job = ExportJob(destination=tmp_dest, tables=("dbo.orders",), split_strategies=(SPLIT,), retry_waits=())
    export_database(spark, job, src, count_rows=False)
    src.row_counts = lambda tables=None: src.files.row_counts(tables).withColumn("row_count", F.col("row_count") + 1)
    with pytest.raises(RuntimeError, match="differ after resuming"):
        export_database(spark, job, src, resume=True)


@pytest.mark.parametrize("parts", [[], ["l_returnflag"], ["l_returnflag", "l_linestatus"]])
def test_the_database_makes_the_balanced_groups(spark, parts):
    from tablexport.operators.balance import balanced_groups

    src = DuckJdbc(spark, SF001)
    key = lambda r: (str(r["part"]) if parts else "", r["grp"], r["lo"], r["hi"], r["weight"])
    groups = src.balanced_groups("dbo", "lineitem", "l_orderkey", 7, parts)
    expected = balanced_groups(spark.read.parquet(f"{SF001}/lineitem.parquet"), "l_orderkey", 7, part=parts)
    assert sorted(map(key, groups.collect())) == sorted(map(key, expected.collect()))
    assert len(src.sent) == 1 and "OVER (" in src.sent[0]


def test_primary_key_of_the_dictionary_and_empty_tables(spark, tmp_dest):
    src = DuckJdbc(spark, SF001)
    src.con.execute("CREATE TABLE dbo.empty_one (a BIGINT, b BIGINT)")
    src.con.execute("CREATE TABLE dbo.keyed (a BIGINT, b BIGINT PRIMARY KEY)")
    src.con.execute("INSERT INTO dbo.keyed SELECT 1, i FROM range(100) t(i)")
    cols = [(None, "dbo", t, i, c, -5, "bigint", t == "keyed" and c == "b", True) for t in ("empty_one", "keyed") for i, c in ((1, "a"), (2, "b"))]
    from tablexport.sources.catalog import COLUMNS_SCHEMA, TABLES_SCHEMA
    src.tables = lambda: spark.createDataFrame([(None, "dbo", t, None) for t in ("empty_one", "keyed")], TABLES_SCHEMA)
    src.columns = lambda tables=None: spark.createDataFrame(cols, COLUMNS_SCHEMA)
    job = ExportJob(destination=tmp_dest, tables_split=("dbo.empty_one", "dbo.keyed"), retry_waits=(), balanced_chunks=4)
    res = export_database(spark, job, src, count_rows=False)
    by = {t.table: t for t in res.tables}
    assert by["empty_one"].table_query_count == 1 and by["keyed"].table_query_count == 5  # 4 groups of the key, and the residual
    assert {r["table"]: r["export_row_count"] for r in res.rollup.collect()} == {"empty_one": 0, "keyed": 100}
