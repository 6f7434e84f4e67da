"""JDBC chunk predicates, executed in DuckDB over the same table, must split it exactly as
the one-pass Spark assignment does (same chunk numbers, same row counts)."""

import duckdb
import pytest

from tablexport.plans.chunks import plan_table
from tablexport.plans.split_spec import SplitSpec
from tablexport.sources.jdbc import Dialect, predicates

from .conftest import SF01

SPECS = [
    ("orders", "orders,between,o_orderkey,number,5000,0,14999"),
    ("orders", "orders,between,o_orderkey,number,250,100,1000"),
    ("orders", "orders,like,o_custkey,number,1,1,12"),
    ("orders", "orders,like,o_custkey,number,1,10,99"),
    ("customer", "customer,like,c_name,number,1,0,1,Customer#00000"),
    ("orders", "orders,range,o_orderdate,date,12"),
    ("orders", "orders,range,o_orderdate,date,5"),
    ("orders", 'orders,query,"o_orderstatus;o_orderpriority"'),
    ("part", 'part,query,"p_brand",like,p_brand'),
    ("part", "part,like,p_name,string,1,a,z"),
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("orders", "customer", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.mark.parametrize("exactly_once", [False, True])
@pytest.mark.parametrize("table,text", SPECS)
def test_predicates_split_like_spark(spark, duck, table, text, exactly_once):
    df = spark.read.parquet(f"{SF01}/{table}.parquet")
    plan = plan_table(df, [SplitSpec.parse(text)], exactly_once=exactly_once)
    spark_counts = {r["chunk_no"]: r["n"] for r in plan.summary(df).collect()}
    preds = predicates(plan, "ansi")
    assert [no for no, _ in preds] == sorted(spark_counts)
    sql_counts = {no: duck.execute(f"SELECT count(*) FROM {table} WHERE {p}").fetchone()[0] for no, p in preds}
    assert sql_counts == spark_counts
    if exactly_once:
        assert sum(sql_counts.values()) == duck.execute(f"SELECT count(*) FROM {table}").fetchone()[0]


def test_multi_strategy_exactly_once(spark, duck):
    df = spark.read.parquet(f"{SF01}/orders.parquet")
    specs = [SplitSpec.parse("orders,between,o_orderkey,number,999,0,4999"),
             SplitSpec.parse("orders,like,o_custkey,number,1,1,9")]
    plan = plan_table(df, specs, exactly_once=True)
    spark_counts = {r["chunk_no"]: r["n"] for r in plan.summary(df).collect()}
    sql_counts = {no: duck.execute(f"SELECT count(*) FROM orders WHERE {p}").fetchone()[0]
                  for no, p in predicates(plan, "ansi")}
    assert sql_counts == spark_counts and sum(sql_counts.values()) == 15000


def test_dialect_quoting():
    assert Dialect("sqlserver").ident("a]b") == "[a]]b]"
    assert Dialect("oracle").ident('a"b') == '"a""b"'
    assert Dialect("ansi").starts_with("x", "50%_") == "x LIKE '50\\%\\_%' ESCAPE '\\'"
    assert Dialect("sqlserver").string("O'Brien") == "N'O''Brien'"
    import datetime as dt
    assert Dialect("sqlserver").timestamp(dt.datetime(2016, 1, 1)) == "CAST('2016-01-01T00:00:00' AS DATETIME2(7))"
    assert Dialect("oracle").timestamp(dt.datetime(2016, 1, 1)) == "TIMESTAMP '2016-01-01 00:00:00'"


def test_null_keys_go_to_residual(spark, duck):
    rows = [(None,), (5,), (None,), (1200,)]
    df = spark.createDataFrame(rows, "k bigint")
    duck.execute("CREATE OR REPLACE TABLE nk AS SELECT * FROM (VALUES (NULL), (5), (NULL), (1200)) t(k)")
    plan = plan_table(df, [SplitSpec.parse("nk,between,k,number,9,0,100")], exactly_once=True)
    preds = predicates(plan, "ansi")
    counts = {no: duck.execute(f"SELECT count(*) FROM nk WHERE {p}").fetchone()[0] for no, p in preds}
    assert counts[plan.residual_no] == 3 and sum(counts.values()) == 4
    spark_counts = {r["chunk_no"]: r["n"] for r in plan.summary(df).collect()}
    assert counts == spark_counts


def test_connection_check_fails_fast(spark):
    from tablexport.sources.jdbc import check_connection
    with pytest.raises(ConnectionError):
        check_connection(spark, "jdbc:nothing:here", attempts=1)


@pytest.mark.parametrize("exactly_once", [False, True])
def test_combination_predicates_with_nulls_and_quotes(spark, duck, exactly_once):
    rows = [("x", 1), (None, 1), ("O'Hara", None), ("x", 1), (None, None), ("50%_", 2)]
    df = spark.createDataFrame(rows, "a string, b int")
    duck.execute("CREATE OR REPLACE TABLE combos (a VARCHAR, b INTEGER)")
    duck.executemany("INSERT INTO combos VALUES (?, ?)", rows)
    plan = plan_table(df, [SplitSpec.parse('combos,query,"a;b"')], exactly_once=exactly_once)
    spark_counts = {r["chunk_no"]: r["n"] for r in plan.summary(df).collect()}
    sql_counts = {no: duck.execute(f"SELECT count(*) FROM combos WHERE {p}").fetchone()[0]
                  for no, p in predicates(plan, "ansi")}
    assert sql_counts == spark_counts and sum(v for k, v in sql_counts.items()) == len(rows)


@pytest.mark.parametrize("exactly_once", [False, True])
def test_wildcard_characters_in_prefixes_are_literal(spark, duck, exactly_once):
    vals = ["50%x", "50ab", "5_1", "501", "a\\b", "a\\bc", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    duck.execute("CREATE OR REPLACE TABLE wild (v VARCHAR)")
    duck.executemany("INSERT INTO wild VALUES (?)", [(v,) for v in vals])
    plan = plan_table(df, [SplitSpec.parse('wild,query,"v",like,v')], exactly_once=exactly_once)
    spark_counts = {r["chunk_no"]: r["n"] for r in plan.summary(df).collect()}
    sql_counts = {no: duck.execute(f"SELECT count(*) FROM wild WHERE {p}").fetchone()[0]
                  for no, p in predicates(plan, "ansi")}
    assert sql_counts == spark_counts


WORDS = ["ab", "ABC", "abd", "Ab", "aB c", "ÉT", "été", "et", "b", "B", "", "z%", "Z%x", "straße", "STRASSE", None]


@pytest.mark.parametrize("spec", ["t,like,k,string,1,A,z", 't,query,"k",like,k'])
def test_each_row_once_where_the_database_ignores_case(spark, spec):
    """SQLite's LIKE holds A and a equal, as the default collation of SQL Server does."""
    import sqlite3

    df = spark.createDataFrame([(w,) for w in WORDS * 2], "k string")
    preds = predicates(plan_table(df, [SplitSpec.parse(spec)]), "ansi")
    con = sqlite3.connect(":memory:")
    con.execute("CREATE TABLE t (k TEXT)")
    con.executemany("INSERT INTO t VALUES (?)", [(w,) for w in WORDS * 2])
    took = [r[0] for _, p in preds for r in con.execute(f"SELECT rowid FROM t WHERE {p}")]
    assert sorted(took) == list(range(1, 2 * len(WORDS) + 1))
    assert [con.execute("SELECT 'A' LIKE 'a'").fetchone()[0]] == [1]


def test_what_any_collation_may_hold_equal_is_left_out_of_later_chunks():
    from tablexport.sources.jdbc import _earlier_overlaps

    rows = list(enumerate(["É", "e", "straße", "STRASSEN", "x", "ｘy"], start=1))
    assert _earlier_overlaps(rows) == {1: [], 2: ["É"], 3: [], 4: ["straße"], 5: [], 6: ["x"]}
