"""The driver contract: entry, registry and oracle agree; a sample checked against DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_registry_and_oracles_agree():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 45


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) >= {"query_id", "status", "export_row_count"}
    n = spark.read.parquet(f"{SF001}/orders.parquet").count()
    assert sum(r["export_row_count"] for r in rows) == n


@pytest.mark.parametrize("name", ["split_date_monthly", "split_query_like", "split_balanced_partitioned",
                                  "union_batches", "describe_columns", "query_stats", "split_exactly_once"])
def test_sample_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted(tuple(str(r[i]) for i in idx) for r in res.fetchall())
    assert got == exp
