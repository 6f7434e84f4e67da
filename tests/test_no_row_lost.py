"""Keys that narrow literals or integer windows could lose: every row is in one chunk, in files and in the database."""

import datetime as dt
from decimal import Decimal

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablexport.operators.balance import balanced_groups
from tablexport.plans.chunks import plan_table
from tablexport.plans.split_spec import SplitSpec
from tablexport.sources.catalog import sqlserver_row_counts_sql
from tablexport.sources.jdbc import Dialect, predicates


def counts(spark, rows, schema, text, exactly_once=True):
    """(rows by chunk in Spark, rows by chunk in DuckDB) of one split."""
    df = spark.createDataFrame(rows, schema)
    plan = plan_table(df, [SplitSpec.parse(text)], exactly_once=exactly_once)
    in_files = {r["chunk_no"]: r["n"] for r in plan.summary(df).collect()}
    con = duckdb.connect()
    t = df.toArrow()  # noqa: F841 - read by name
    con.execute("CREATE TABLE t AS SELECT * FROM t")
    in_db = {no: con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for no, p in predicates(plan, "ansi")}
    return in_files, in_db


@pytest.mark.parametrize("kind, keys", [
    ("double", [0.0, 1.5, 299.0, 299.5, 300.0, 599.75, 600.0, 1000.0, None, -3.5]),
    ("decimal(12,3)", [Decimal("0"), Decimal("299.001"), Decimal("299.999"), Decimal("300"), Decimal("1000"), None]),
    ("bigint", [0, 299, 300, 599, 600, 1000, None, -1, 10**15]),
])
def test_number_windows(spark, kind, keys):
    in_files, in_db = counts(spark, [(k,) for k in keys], f"k {kind}", "t,between,k,number,299,0,1000")
    assert in_db == in_files and sum(in_db.values()) == len(keys)


@pytest.mark.parametrize("kind, keys", [
    ("timestamp_ntz", [dt.datetime(2024, 1, 1, 0, 0, 0, us) for us in (0, 1, 123456, 999999)] + [None, dt.datetime(1969, 12, 31, 23, 59, 59, 5)]),
    ("date", [dt.date(2024, 2, 29), dt.date(1, 1, 1), None]),
    ("decimal(20,6)", [Decimal("1.000001"), Decimal("1.000002"), Decimal("-99999999999999.5"), None]),
    ("double", [0.1, 1e-300, 1.7976931348623157e308, -2.5, None]),
    ("binary", [b"\x01", b"", b"\xff\x00'", None]),
    ("string", ["", "'", "É", "x" * 300, "x" * 301, "a\nb", None]),
    ("boolean", [True, False, None]),
])
def test_combinations(spark, kind, keys):
    rows = [(k, i % 2) for i, k in enumerate(keys * 2)]
    in_files, in_db = counts(spark, rows, f"k {kind}, v int", 't,query,"k;v"')
    assert in_db == in_files and sum(in_db.values()) == len(rows)
    residual = max(in_db)
    assert in_db[residual] == 0  # every combination found its own chunk


def test_long_and_foreign_prefixes(spark):
    keys = ["x" * 300 + "a", "x" * 300 + "b", "x" * 120, "É1", "éa", "日本語", "50%", "a_b", "A'b", None, ""]
    for text in ("t,like,k,string,1,a,z", 't,query,"k",like,k'):
        in_files, in_db = counts(spark, [(k,) for k in keys], "k string", text)
        assert in_db == in_files and sum(in_db.values()) == len(keys)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-50, 1050, width=32)), min_size=1, max_size=30))
def test_any_fractional_keys(spark, keys):
    in_files, in_db = counts(spark, [(k,) for k in keys], "k double", "t,between,k,number,99,0,1000")
    assert in_db == in_files and sum(in_db.values()) == len(keys)


def test_literals_of_each_dialect():
    s, o, a = Dialect("sqlserver"), Dialect("oracle"), Dialect("ansi")
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, 600)
    assert s.literal(moment) == "CAST('2024-01-02T03:04:05.000600' AS DATETIME2(7))" and o.literal(moment) == "TIMESTAMP '2024-01-02 03:04:05.000600'"
    assert s.literal(moment.date()) == "CAST('2024-01-02' AS DATE)" and o.literal(moment.date()) == "DATE '2024-01-02'"
    assert (s.literal(b"\x01\xff"), o.literal(b"\x01\xff"), a.literal(b"\x01\xff")) == ("0x01FF", "HEXTORAW('01FF')", "UNHEX('01FF')")
    assert s.literal("É'") == "N'É'''" and o.literal("É'") == "'É'''" and s.text("k") == "CAST([k] AS NVARCHAR(MAX))"
    assert s.literal(Decimal("1E+3")) == "1000" and s.literal(None) == "NULL"


def test_row_counts_of_another_catalog():
    sql = sqlserver_row_counts_sql("a]b")
    assert "FROM [a]]b].sys.partitions" in sql and "DB_ID(N'a]b')" in sql and "sys.partitions" in sqlserver_row_counts_sql(None)


def test_balanced_groups_of_wide_weights(spark):
    rows = [(k, 2 * 10**16 + k) for k in range(300)]
    got = balanced_groups(spark.createDataFrame(rows, "k long, w long"), "k", n=256, weight="w").orderBy("grp").collect()
    total, cum, expected = sum(w for _, w in rows), 0, {}
    for k, w in rows:
        cum += w
        g = (cum * 100 - 1) * 256 // (total * 100)
        lo, hi, weight = expected.get(g, (k, k, 0))
        expected[g] = (lo, k, weight + w)
    assert [(r["grp"], r["lo"], r["hi"], r["weight"]) for r in got] == [(g, *expected[g]) for g in sorted(expected)] and max(expected) == 255
