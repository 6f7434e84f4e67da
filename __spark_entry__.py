"""

Queries live in ``tablexport.queries``; every one reads the given tables.
The oracle of each states the same computation in SQL on the same
parquet views. Chunk summaries list every planned chunk (empty ones with
n = 0), so the SQL builds the chunk list and LEFT JOINs the counts.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:  # loaded by file path: make the package importable
    sys.path.insert(0, _HERE)

from tablexport.queries import QUERIES, flagship  # noqa: E402

# The training-data operators and their pipeline are optional: without their folder the rest works.
_LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_LLM_ORACLE: dict[str, str] = {}
try:
    from tablexport.llm import queries as _llm  # noqa: E402
    import corpus_pipeline as _pipeline  # noqa: E402
except ImportError:  # the folder, the pipeline or a module that they need isn't there
    pass
else:
    _LLM_QUERIES = {**_llm.QUERIES, "pipeline": _pipeline.run}
    _LLM_ORACLE = dict(_llm.ORACLE_SQL) | ({"pipeline": _pipeline.ORACLE_SQL} if _pipeline.ORACLE_SQL else {})

SF_SMOKE = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """orders -> yearly chunks -> ISO date text -> Avro files -> per-chunk statistics."""
    return flagship(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**QUERIES, **_LLM_QUERIES}


# The 14 driver tables, as a catalog of one schema.
_TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
           "nation", "orders", "pages", "part", "region", "supplier")
_TV = "(VALUES " + ", ".join(f"('{t}')" for t in _TABLES) + ") t(table_name)"
_IN = "(" + ", ".join(f"'{t}'" for t in _TABLES) + ")"
_JDBC_CODE = ("CASE data_type WHEN 'BIGINT' THEN -5 WHEN 'INTEGER' THEN 4 WHEN 'SMALLINT' THEN 5 WHEN 'TINYINT' "
              "THEN -6 WHEN 'DOUBLE' THEN 8 WHEN 'FLOAT' THEN 7 WHEN 'VARCHAR' THEN 12 WHEN 'BOOLEAN' THEN -7 "
              "WHEN 'DATE' THEN 91 WHEN 'TIMESTAMP' THEN 93 WHEN 'TIMESTAMP_NS' THEN 93 WHEN 'TIMESTAMP_MS' THEN 93 "
              "WHEN 'TIMESTAMP_S' THEN 93 WHEN 'BLOB' THEN -3 "
              "ELSE CASE WHEN data_type LIKE '%[]' THEN 2003 ELSE 1111 END END")
_SUPPORTED = "(-5, -2, -7, 2004, 1, 2005, 91, 3, 8, 6, 4, -16, -4, -1, -15, 2011, 2, -9, 7, 5, 93, -6, -3, 12)"
_COLS = f"(SELECT * FROM information_schema.columns WHERE table_name IN {_IN})"
_ORDERS_SCAN = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
_YEARS = "(SELECT year(min(o_orderdate)) AS y0, year(max(o_orderdate)) AS yn FROM orders)"
_DIGITS = "('0', '1', '2', '3', '4', '5', '6', '7', '8', '9')"
# Keys of lineitem with the group that each is in among its partition's and sub-partition's 16.
_SUBPARTS = ("(SELECT *, CAST((cum * 100 - 1) * 16 // (tot * 100) AS BIGINT) AS grp FROM (SELECT *, sum(w) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY k) AS cum, "
             "sum(w) OVER (PARTITION BY l_returnflag, l_linestatus) AS tot FROM (SELECT l_returnflag, l_linestatus, l_orderkey AS k, count(*) AS w FROM lineitem "
             "WHERE l_orderkey IS NOT NULL GROUP BY 1, 2, 3)))")

_ORACLE = {
    # ---------------------------------------------------------------- catalog
    "list_schemas": "SELECT 'dbo' AS schema_name",
    "list_tables_priority": f"SELECT table_name, row_number() OVER (ORDER BY CASE table_name WHEN 'orders' THEN 1 "
                            f"WHEN 'lineitem' THEN 2 ELSE 3 END, table_name) AS priority FROM {_TV}",
    "tables_existing": "SELECT * FROM (VALUES ('orders'), ('lineitem')) t(table_name)",
    "filter_schemas": f"SELECT table_name FROM {_TV}",
    "filter_tables": "SELECT * FROM (VALUES ('orders'), ('part')) t(table_name)",
    "exclude_tables_regex": f"SELECT table_name FROM {_TV} WHERE NOT regexp_full_match('dbo.' || table_name, "
                            r"'(?i)(?:dbo\.(doc|emb).*)|(?:DBO\.PAGES)|(?:dbo\.lab)')",
    "describe_columns": f"SELECT table_name, CAST(ordinal_position AS BIGINT) AS ordinal, column_name, "
                        f"{_JDBC_CODE} AS jdbc_type, ({_JDBC_CODE}) IN {_SUPPORTED} AS supported FROM {_COLS}",
    "primary_key_columns": "SELECT k.t AS table_name, k.c AS column_name FROM (VALUES ('orders', 'o_orderkey'), "
                           "('lineitem', 'l_orderkey'), ('lineitem', 'l_linenumber'), ('customer', 'c_custkey'), "
                           "('part', 'p_partkey'), ('supplier', 's_suppkey'), ('nation', 'n_nationkey'), "
                           "('region', 'r_regionkey'), ('events', 'event_id'), ('documents', 'doc_id'), "
                           "('orders_missing', 'o_nothere')) k(t, c) "
                           f"JOIN {_COLS} c ON c.table_name = k.t AND c.column_name = k.c",
    "exclude_columns_regex": "SELECT table_name, column_name, regexp_full_match('dbo.' || table_name || '.' || "
                             r"column_name, '(?i)(?:.*\.l_(tax|discount))|(?:DBO\.ORDERS\.O_COMMENT)|(?:dbo\.part\.p_)') "
                             f"AS excluded FROM {_COLS} WHERE table_name IN ('lineitem', 'orders', 'part')",
    "skip_empty_tables": f"SELECT table_name FROM {_COLS} GROUP BY table_name HAVING bool_and(({_JDBC_CODE}) NOT IN "
                         f"{_SUPPORTED} OR regexp_full_match('dbo.' || table_name || '.' || column_name, "
                         r"'(?i)dbo\.embeddings\.(vec_id|label)'))",
    "unsupported_columns": "SELECT table_name, string_agg(column_name || ' (' || replace(data_type, 'FLOAT[]', "
                           "'array<float>') || ',2003)', ', ' ORDER BY ordinal_position) AS unsupported "
                           f"FROM {_COLS} WHERE data_type LIKE '%[]' GROUP BY table_name",
    "table_row_counts": "SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL "
                        "SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer",
    "list_partitions": "SELECT part, sub_part, dense_rank() OVER (ORDER BY part DESC) AS position FROM "
                       "(SELECT DISTINCT l_returnflag AS part, l_linestatus AS sub_part FROM lineitem)",
    "split_choice": f"SELECT table_name, CASE table_name WHEN 'orders' THEN 'strategies' WHEN 'lineitem' THEN "
                    f"'balanced_partitioned' WHEN 'part' THEN 'balanced' ELSE 'whole' END AS strategy FROM {_TV}",
    # ---------------------------------------------------------------- scans / projections
    "scan_table": _ORDERS_SCAN,
    "scan_chunks": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CASE WHEN o_orderkey IS NULL THEN "
                   "(e - s) // (inc + 1) + 2 ELSE CAST((o_orderkey - s) // (inc + 1) AS BIGINT) + 1 END AS chunk_no FROM orders, "
                   "(SELECT s, e, (e - s) // 50 AS inc FROM (SELECT min(o_orderkey) AS s, max(o_orderkey) AS e FROM orders))",
    "project_exportable": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                          "l_returnflag, l_linestatus, l_shipdate FROM lineitem",
    "datetime_string_seconds": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o_orderdate__dt_str "
                               "FROM orders",
    "datetime_string_126": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 "
                           "THEN '' ELSE strftime(ts, '.%f') END AS ts__dt_str FROM events",
    "tidy_names": "SELECT DISTINCT p_brand AS name, lower(regexp_replace(p_brand, '[^a-zA-Z0-9]', '_', 'g')) AS tidy_name "
                  "FROM part",
    "chunk_ids": "SELECT v, printf('%07d', row_number() OVER (ORDER BY v)) AS chunk_id "
                 "FROM (SELECT DISTINCT o_orderpriority AS v FROM orders)",
    "filename_pattern": "SELECT v, printf('%07d', row_number() OVER (ORDER BY v)) AS chunk_id, 'dbo.orders-' || "
                        "printf('%07d', row_number() OVER (ORDER BY v)) || '.avro' AS path "
                        "FROM (SELECT DISTINCT o_orderpriority AS v FROM orders)",
    # ---------------------------------------------------------------- splits
    "split_number_between": "WITH c AS (SELECT range + 1 AS chunk_no FROM range(0, (14999 - 0) // (5000 + 1) + 2)), "
                            "a AS (SELECT CASE WHEN o_orderkey BETWEEN 0 AND 14999 THEN CAST((o_orderkey - 0) // 5001 AS BIGINT) + 1 "
                            "ELSE (14999 - 0) // (5000 + 1) + 2 END AS cn, o_orderkey FROM orders) "
                            "SELECT c.chunk_no, count(a.cn) AS n, min(a.o_orderkey) AS lo, max(a.o_orderkey) AS hi "
                            "FROM c LEFT JOIN a ON a.cn = c.chunk_no GROUP BY c.chunk_no",
    "split_number_between_auto": "WITH b AS (SELECT min(l_orderkey) AS s, max(l_orderkey) AS e FROM lineitem), "
                                 "c AS (SELECT unnest(range(0, (e - s) // 1001 + 1)) + 1 AS chunk_no FROM b), "
                                 "a AS (SELECT CAST((l_orderkey - s) // 1001 AS BIGINT) + 1 AS cn, l_orderkey FROM lineitem, b "
                                 "WHERE l_orderkey BETWEEN s AND greatest(s + 1000, e)) "
                                 "SELECT c.chunk_no, count(a.l_orderkey) AS n, min(a.l_orderkey) AS lo, "
                                 "max(a.l_orderkey) AS hi FROM c LEFT JOIN a ON a.cn = c.chunk_no GROUP BY c.chunk_no",
    "split_number_auto_increment": "WITH b AS (SELECT min(o_orderkey) AS s, max(o_orderkey) AS e FROM orders), "
                                   "i AS (SELECT s, e, (e - s) // 50 AS inc FROM b), "
                                   "c AS (SELECT unnest(range(0, (e - s) // (inc + 1) + 1)) + 1 AS chunk_no FROM i), "
                                   "a AS (SELECT CAST((o_orderkey - s) // (inc + 1) AS BIGINT) + 1 AS cn FROM orders, i "
                                   "WHERE o_orderkey BETWEEN s AND greatest(s + inc, e)) "
                                   "SELECT c.chunk_no, count(a.cn) AS n FROM c LEFT JOIN a ON a.cn = c.chunk_no "
                                   "GROUP BY c.chunk_no",
    "split_number_like": "SELECT c.i AS chunk_no, CAST(c.i AS VARCHAR) || '%' AS label, count(o.o_orderkey) AS n "
                         "FROM range(1, 13) c(i) LEFT JOIN orders o "
                         "ON starts_with(CAST(o.o_custkey AS VARCHAR), CAST(c.i AS VARCHAR)) GROUP BY 1, 2",
    "split_prefix_like": "SELECT CAST(c.chunk_no AS BIGINT) AS chunk_no, c.label, count(a.cn) AS n FROM (VALUES "
                         "(1, 'Customer#000000%'), (2, 'Customer#000001%'), (3, 'NOT Customer#00000%'), (4, 'residual')) "
                         "c(chunk_no, label) LEFT JOIN (SELECT CASE WHEN starts_with(c_name, 'Customer#000000') THEN 1 "
                         "WHEN starts_with(c_name, 'Customer#000001') THEN 2 WHEN NOT starts_with(c_name, 'Customer#00000') "
                         "THEN 3 ELSE 4 END AS cn FROM customer) a ON a.cn = c.chunk_no GROUP BY 1, 2",
    "split_digit_catch_all": "SELECT c.i - 9 AS chunk_no, CAST(c.i AS VARCHAR) || '%' AS label, count(o.o_orderkey) AS n "
                             "FROM range(10, 100) c(i) LEFT JOIN orders o "
                             "ON starts_with(CAST(o.o_custkey AS VARCHAR), CAST(c.i AS VARCHAR)) GROUP BY 1, 2 "
                             f"UNION ALL SELECT 91, 'digits', count(*) FROM orders WHERE CAST(o_custkey AS VARCHAR) IN {_DIGITS}",
    "split_string_like": "SELECT c.i + 1 AS chunk_no, chr(CAST(97 + c.i AS INTEGER)) || '%' AS label, "
                         "count(p.p_partkey) AS n FROM range(0, 26) c(i) LEFT JOIN part p "
                         "ON left(p.p_name, 1) = chr(CAST(97 + c.i AS INTEGER)) GROUP BY 1, 2",
    "split_date_yearly": f"WITH b AS {_YEARS}, c AS (SELECT unnest(range(0, yn - y0 + 1)) + 1 AS chunk_no FROM b), "
                         "a AS (SELECT least(greatest(year(o_orderdate) - y0, 0), yn - y0) + 1 AS cn FROM orders, b "
                         "WHERE o_orderdate IS NOT NULL) "
                         "SELECT c.chunk_no, count(a.cn) AS n FROM c LEFT JOIN a ON a.cn = c.chunk_no GROUP BY c.chunk_no",
    "split_date_monthly": "WITH b AS (SELECT year(min(o_orderdate)) * 12 + month(min(o_orderdate)) - 1 AS m0, "
                          "year(max(o_orderdate)) * 12 + month(max(o_orderdate)) - 1 AS mn FROM orders), "
                          "k AS (SELECT m0, (mn - m0) // 3 AS k FROM b), "
                          "c AS (SELECT unnest(range(0, k + 1)) + 1 AS chunk_no FROM k), "
                          "a AS (SELECT least(greatest((year(o_orderdate) * 12 + month(o_orderdate) - 1 - m0) // 3, 0), k) "
                          "+ 1 AS cn FROM orders, k WHERE o_orderdate IS NOT NULL) "
                          "SELECT c.chunk_no, count(a.cn) AS n FROM c LEFT JOIN a ON a.cn = c.chunk_no GROUP BY c.chunk_no",
    "split_distinct_combos": "SELECT o_orderstatus, o_orderpriority, dense_rank() OVER (ORDER BY o_orderstatus NULLS FIRST, "
                             "o_orderpriority NULLS FIRST) AS chunk_no, count(*) AS n FROM orders GROUP BY 1, 2",
    "split_query_like": "WITH v AS (SELECT DISTINCT p_brand AS b FROM part WHERE p_brand IS NOT NULL), "
                        "r AS (SELECT b, row_number() OVER (ORDER BY b) AS chunk_no FROM v) "
                        "SELECT r.chunk_no, r.b || '%' AS label, count(p.p_partkey) AS n FROM r LEFT JOIN part p "
                        "ON starts_with(p.p_brand, r.b) GROUP BY 1, 2",
    "split_multi_strategy": "SELECT CASE WHEN c.i < 13 THEN 1 ELSE 2 END AS strategy_no, c.i + 1 AS chunk_no, "
                            "chr(CAST(97 + c.i AS INTEGER)) || '%' AS label, count(p.p_partkey) AS n "
                            "FROM range(0, 26) c(i) LEFT JOIN part p ON left(p.p_name, 1) = chr(CAST(97 + c.i AS INTEGER)) "
                            "GROUP BY 1, 2, 3",
    "split_balanced": "WITH e AS (SELECT l_orderkey AS k, count(*) AS w FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1), "
                      "c AS (SELECT k, w, sum(w) OVER (ORDER BY k) AS cum, sum(w) OVER () AS tot FROM e) "
                      "SELECT CAST((cum * 100 - 1) * 256 // (tot * 100) AS BIGINT) AS grp, min(k) AS lo, max(k) AS hi, "
                      "CAST(sum(w) AS BIGINT) AS weight FROM c GROUP BY 1",
    "split_balanced_partitioned": "WITH e AS (SELECT l_returnflag AS part, l_orderkey AS k, count(*) AS w FROM lineitem "
                                  "WHERE l_orderkey IS NOT NULL GROUP BY 1, 2), "
                                  "c AS (SELECT part, k, w, sum(w) OVER (PARTITION BY part ORDER BY k) AS cum, "
                                  "sum(w) OVER (PARTITION BY part) AS tot FROM e) "
                                  "SELECT part, CAST((cum * 100 - 1) * 16 // (tot * 100) AS BIGINT) AS grp, min(k) AS lo, "
                                  "max(k) AS hi, CAST(sum(w) AS BIGINT) AS weight FROM c GROUP BY 1, 2",
    "split_balanced_subpartitioned": "SELECT l_returnflag, l_linestatus, grp, min(k) AS lo, max(k) AS hi, CAST(sum(w) AS BIGINT) AS weight FROM " + _SUBPARTS + " GROUP BY 1, 2, 3",
    "balanced_chunk_rows": "SELECT row_number() OVER (ORDER BY l_returnflag DESC, l_linestatus DESC, grp) AS chunk_no, l_returnflag, l_linestatus, n FROM "
                           "(SELECT l_returnflag, l_linestatus, grp, CAST(sum(w) AS BIGINT) AS n FROM " + _SUBPARTS + " GROUP BY 1, 2, 3)",
    "union_batches": "WITH b AS (SELECT min(o_orderkey) AS s, max(o_orderkey) AS e FROM orders) "
                     "SELECT DISTINCT CAST(((o_orderkey - s) // 10) // 100 + 1 AS BIGINT) AS batch_no, o_orderstatus, "
                     "o_orderpriority FROM orders, b WHERE o_orderkey BETWEEN s AND greatest(s + 9, e)",
    "split_audit": "SELECT times, count(*) AS n FROM (SELECT o_orderkey, count(c.n) AS times FROM orders "
                   "LEFT JOIN range(1, 13) c(n) ON starts_with(CAST(o_custkey AS VARCHAR), CAST(c.n AS VARCHAR)) "
                   "GROUP BY 1) GROUP BY 1",
    "split_exactly_once": "WITH c AS (SELECT i AS chunk_no, CAST(i AS VARCHAR) || '%' AS label FROM range(1, 13) t(i) "
                          "UNION ALL SELECT 13, 'residual'), "
                          "a AS (SELECT coalesce(min(c.chunk_no), 13) AS cn FROM orders o LEFT JOIN c ON c.chunk_no <= 12 "
                          "AND starts_with(CAST(o.o_custkey AS VARCHAR), CAST(c.chunk_no AS VARCHAR)) GROUP BY o.o_orderkey) "
                          "SELECT c.chunk_no, c.label, count(a.cn) AS n FROM c LEFT JOIN a ON a.cn = c.chunk_no GROUP BY 1, 2",
    # ---------------------------------------------------------------- sinks and statistics
    "avro_roundtrip": _ORDERS_SCAN,
    "avro_codecs": "SELECT c.codec, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders "
                   "CROSS JOIN (VALUES ('null'), ('snappy'), ('deflate')) c(codec) GROUP BY 1",
    "avro_rollover": _ORDERS_SCAN,
    "query_stats": f"WITH b AS {_YEARS}, c AS (SELECT unnest(range(1, yn - y0 + 3)) AS chunk_no FROM b), "
                   "a AS (SELECT CASE WHEN o_orderdate IS NULL THEN yn - y0 + 2 "
                   "ELSE least(greatest(year(o_orderdate) - y0, 0), yn - y0) + 1 END AS cn FROM orders, b) "
                   "SELECT printf('%07d', c.chunk_no) AS query_id, 'Completed' AS status, count(a.cn) AS export_row_count "
                   "FROM c LEFT JOIN a ON a.cn = c.chunk_no GROUP BY c.chunk_no",
    "table_rollup": "SELECT 'orders' AS table_name, year(max(o_orderdate)) - year(min(o_orderdate)) + 2 AS table_query_count, "
                    "count(*) AS export_row_count, count(*) AS db_row_count FROM orders",
    "manifest_json": "SELECT 'orders' AS table_name, year(max(o_orderdate)) - year(min(o_orderdate)) + 2 AS table_query_count, "
                     "count(*) AS export_row_count, count(*) AS db_row_count FROM orders "
                     "UNION ALL SELECT 'region', 1, count(*), count(*) FROM region",
    "validate_row_counts": "SELECT 'orders' AS table_name, count(*) AS db_row_count, count(*) AS export_row_count, "
                           "false AS mismatch FROM orders UNION ALL SELECT 'lineitem', count(*), count(*), false FROM lineitem "
                           "UNION ALL SELECT 'customer', count(*), count(*), false FROM customer",
    "validate_content": "SELECT 'orders' AS table_name, count(*) AS n, count(*) AS n_read, true AS content_match FROM orders "
                        "UNION ALL SELECT 'lineitem', count(*), count(*), true FROM lineitem",
    "failed_chunks": "SELECT 'orders' AS table_name, 'Completed' AS status, count(*) AS export_row_count, count(*) AS db_row_count "
                     "FROM orders UNION ALL SELECT 'part', 'Failed', 0, count(*) FROM part",
    "export_all_tables": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS export_row_count, count(*) AS db_row_count FROM {t}" for t in _TABLES),
    "pre_post_sql": "SELECT 'tx_orders' AS table_name, count(*) AS export_row_count, count(*) AS rows_after FROM orders",
    "resume_partial_table": "SELECT chunk, CASE WHEN chunk <= 2 THEN 1 ELSE 2 END AS run_no, count(*) AS rows_in_files FROM "
                            f"(SELECT CAST(year(o_orderdate) - y0 + 1 AS BIGINT) AS chunk FROM orders, {_YEARS}) GROUP BY chunk",
    "resume_pending_chunks": "SELECT 'orders' AS table_name, year(max(o_orderdate)) - year(min(o_orderdate)) + 2 AS table_query_count, "
                             "count(*) AS export_row_count, count(*) AS rows_in_files FROM orders UNION ALL "
                             "SELECT 'lineitem', 1, count(*), count(*) FROM lineitem UNION ALL SELECT 'region', 1, count(*), count(*) FROM region",
}
# What a query of the catalog names, with the rows of each table.
_COUNTS = "(" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _TABLES) + ")"
for _name in ("list_tables_priority", "tables_existing", "filter_schemas", "filter_tables", "exclude_tables_regex", "split_choice"):
    _ORACLE[_name] = f"SELECT * FROM ({_ORACLE[_name]}) JOIN {_COUNTS} USING (table_name)"
_ORACLE["list_schemas"] = f"SELECT 'dbo' AS schema_name, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM {_COUNTS}"


def oracle_sql() -> dict[str, str]:
    return {**{k: v for k, v in _ORACLE.items() if k in QUERIES}, **_LLM_ORACLE}
