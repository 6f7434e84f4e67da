"""The registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (or data Spark derives from them). Queries that export write to a
fresh folder under the shared checkpoint folder and read the result back
(files, manifest), so the answer covers the whole table every time.

Parameters are fixed here so the DuckDB oracle in ``__spark_entry__``
can state the same computation in SQL.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from .session import local_df

from .functions.columns import chunk_id_col, convert_datetimes, pattern_col, tidy_name_col
from .operators import catalog_ops as co
from .operators.balance import assign_balanced, balanced_chunk_table, balanced_groups
from .operators.content import check_content
from .operators.stats import read_file_index, split_audit, validate_row_counts
from .operators.union_batches import union_batches
from .plans.chunks import CombosStrategy, plan_table
from .plans.job import ExportJob
from .plans.split_spec import SplitSpec
from .run import choose_strategy, export_database
from .session import scratch_path
from .sources.avro_sink import FORMAT, register
from .sources.catalog import DirectoryCatalog, SparkCatalogSource
from .sources.manifest import manifest_tables

ORDERS_SCAN = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
KEYS = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "customer": ["c_custkey"],
        "part": ["p_partkey"], "supplier": ["s_suppkey"], "nation": ["n_nationkey"], "region": ["r_regionkey"],
        "events": ["event_id"], "documents": ["doc_id"], "orders_missing": ["o_nothere"]}


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _cat(spark, sf, **kw) -> DirectoryCatalog:
    return DirectoryCatalog(spark, sf, **kw)


def _plan(df, text: str, exactly_once=False, **kw):
    return plan_table(df, [SplitSpec.parse(text)], exactly_once=exactly_once, **kw)


def _summary(df, text, *aggs, exactly_once=False):
    plan = _plan(df, text, exactly_once)
    return plan.summary(df, *aggs)


def _job(spark, name, **kw) -> ExportJob:
    kw.setdefault("retry_waits", ())
    return ExportJob(destination=scratch_path(spark, name), **kw)


def _read_back(spark, dest) -> DataFrame:
    register(spark)
    return spark.read.format(FORMAT).load(dest)


# ------------------------------------------------------------------ catalog
def list_schemas(spark, sf):
    return _cat(spark, sf).schemas().select(F.col("schema").alias("schema_name"))


PRIORITIES = ("dbo.orders", "dbo.missing", "dbo.orders")
SPLIT_TABLES = ("dbo.lineitem",)


def list_tables_priority(spark, sf):
    t = co.prioritized_tables(_cat(spark, sf).tables(), PRIORITIES, SPLIT_TABLES)
    return t.select(F.col("table").alias("table_name"), "priority")


def tables_existing(spark, sf):
    return co.tables_existing(_cat(spark, sf).tables(), PRIORITIES, SPLIT_TABLES).select(
        F.col("table").alias("table_name"))


def filter_schemas(spark, sf):
    return co.filter_schemas(_cat(spark, sf).tables(), ("dbo",)).select(F.col("table").alias("table_name"))


def filter_tables(spark, sf):
    return co.filter_tables(_cat(spark, sf).tables(), ("dbo.orders", "dbo.part", "dbo.nothere")).select(
        F.col("table").alias("table_name"))


TABLE_EXCLUSIONS = (r"dbo\.(doc|emb).*", r"DBO\.PAGES", r"dbo\.lab")


def exclude_tables_regex(spark, sf):
    return co.exclude_tables(_cat(spark, sf).tables(), TABLE_EXCLUSIONS).select(F.col("table").alias("table_name"))


def describe_columns(spark, sf):
    return _cat(spark, sf).columns().select(
        F.col("table").alias("table_name"), F.col("ordinal").cast("long").alias("ordinal"),
        F.col("column").alias("column_name"), "jdbc_type", "supported")


def primary_key_columns(spark, sf):
    cat = _cat(spark, sf)
    keys = local_df(spark, [("dbo", t, c) for t, cs in KEYS.items() for c in cs],
                                 "schema string, table string, column string")
    marked = co.primary_key_columns(cat.columns(), keys)
    return marked.filter("is_key").select(F.col("table").alias("table_name"), F.col("column").alias("column_name"))


COLUMN_EXCLUSIONS = (r".*\.l_(tax|discount)", r"DBO\.ORDERS\.O_COMMENT", r"dbo\.part\.p_")


def exclude_columns_regex(spark, sf):
    marked = co.mark_excluded(_cat(spark, sf).columns(), COLUMN_EXCLUSIONS)
    return marked.filter(F.col("table").isin("lineitem", "orders", "part")).select(
        F.col("table").alias("table_name"), F.col("column").alias("column_name"), "excluded")


def skip_empty_tables(spark, sf):
    marked = co.mark_excluded(_cat(spark, sf).columns(), (r"dbo\.embeddings\.(vec_id|label)",))
    return co.skip_empty_tables(marked).select(F.col("table").alias("table_name"))


def unsupported_columns(spark, sf):
    return co.unsupported_columns(_cat(spark, sf).columns()).select(F.col("table").alias("table_name"), "unsupported")


def table_row_counts(spark, sf):
    cat = _cat(spark, sf)
    return cat.row_counts([("dbo", "orders"), ("dbo", "lineitem"), ("dbo", "customer")]).select(
        F.col("table").alias("table_name"), F.col("row_count").alias("n"))


def list_partitions(spark, sf):
    return co.list_partitions(_t(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


SPLIT_CHOICE_JOB = dict(split_strategies=("orders,range,o_orderdate,date,12",), tables_split=("dbo.part",),
                        partition_columns={"lineitem": ["l_returnflag"]})


def split_choice(spark, sf):
    job = ExportJob(destination="unused", **SPLIT_CHOICE_JOB)
    rows = []
    for r in _cat(spark, sf).tables().collect():
        part = bool(job.partition_columns.get(r["table"]))
        rows.append((r["table"], choose_strategy(job, r["schema"], r["table"], part)))
    return local_df(spark, rows, "table_name string, strategy string")


# ------------------------------------------------------------------ scans / projections
def scan_table(spark, sf):
    cat = _cat(spark, sf)
    cols = co.mark_excluded(cat.columns(), (r".*\.o_orderdate",))
    keep = co.exportable_columns(cols, "dbo", "orders")
    return cat.read("dbo", "orders").select(*keep)


def scan_chunks(spark, sf):
    """The chunked read of a number split: every row with its chunk, in one scan."""
    orders = _t(spark, sf, "orders")
    plan = plan_table(orders, [SplitSpec.parse("orders,between,o_orderkey,number")], exactly_once=True)
    return plan.assign(orders).select(*ORDERS_SCAN, "chunk_no")


def project_exportable(spark, sf):
    cat = _cat(spark, sf)
    cols = co.mark_excluded(cat.columns(), (r".*\.l_(tax|discount)",))
    keep = co.exportable_columns(cols, "dbo", "lineitem")
    return cat.read("dbo", "lineitem").select(*keep)


def datetime_string_seconds(spark, sf):
    df = _t(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return convert_datetimes(df, "oracle", "__dt_str")


def datetime_string_126(spark, sf):
    df = _t(spark, sf, "events").select("event_id", "ts")
    return convert_datetimes(df, "sqlserver", "__dt_str")


def tidy_names(spark, sf):
    return _t(spark, sf, "part").select(F.col("p_brand").alias("name")).distinct().withColumn(
        "tidy_name", tidy_name_col(F.col("name")))


def _priority_chunks(spark, sf):
    orders = _t(spark, sf, "orders")
    plan = _plan(orders, "orders,query,o_orderpriority")
    st: CombosStrategy = plan.strategies[0]
    return st.combos.select(F.col("o_orderpriority").alias("v"), chunk_id_col(F.col("local_no") + st.offset).alias("chunk_id"))


def chunk_ids(spark, sf):
    return _priority_chunks(spark, sf)


def filename_pattern(spark, sf):
    c = _priority_chunks(spark, sf)
    return c.withColumn("path", pattern_col("%{SCHEMA}.%{TABLE}.avro", None, "dbo", "orders", F.col("chunk_id")))


# ------------------------------------------------------------------ splits
def split_number_between(spark, sf):
    orders = _t(spark, sf, "orders")
    # a given range; keys outside it go to the residual chunk, so the whole table is reported at any scale
    s = _summary(orders, "orders,between,o_orderkey,number,5000,0,14999",
                 F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), exactly_once=True)
    return s.select("chunk_no", "n", "lo", "hi")


def split_number_between_auto(spark, sf):
    li = _t(spark, sf, "lineitem")
    s = _summary(li, "lineitem,between,l_orderkey,number,1000", F.min("l_orderkey").alias("lo"),
                 F.max("l_orderkey").alias("hi"))
    return s.select("chunk_no", "n", "lo", "hi")


def split_number_auto_increment(spark, sf):
    orders = _t(spark, sf, "orders")
    return _summary(orders, "orders,between,o_orderkey,number").select("chunk_no", "n")


def split_number_like(spark, sf):
    orders = _t(spark, sf, "orders")
    return _summary(orders, "orders,like,o_custkey,number,1,1,12").select("chunk_no", "label", "n")


def split_prefix_like(spark, sf):
    cust = _t(spark, sf, "customer")
    return _summary(cust, "customer,like,c_name,number,1,0,1,Customer#00000", exactly_once=True).select(
        "chunk_no", "label", "n")


def split_digit_catch_all(spark, sf):
    orders = _t(spark, sf, "orders")
    return _summary(orders, "orders,like,o_custkey,number,1,10,99").select("chunk_no", "label", "n")


def split_string_like(spark, sf):
    part = _t(spark, sf, "part")
    return _summary(part, "part,like,p_name,string,1,a,z").select("chunk_no", "label", "n")


def split_date_yearly(spark, sf):
    orders = _t(spark, sf, "orders")
    return _summary(orders, "orders,range,o_orderdate,date,12").select("chunk_no", "n")


def split_date_monthly(spark, sf):
    orders = _t(spark, sf, "orders")
    return _summary(orders, "orders,range,o_orderdate,date,3").select("chunk_no", "n")


def split_distinct_combos(spark, sf):
    orders = _t(spark, sf, "orders")
    plan = _plan(orders, 'orders,query,"o_orderstatus;o_orderpriority"')
    st: CombosStrategy = plan.strategies[0]
    counts = plan.assign(orders).groupBy("chunk_no").agg(F.count(F.lit(1)).alias("n"))
    combos = st.combos.select("o_orderstatus", "o_orderpriority", (F.col("local_no") + st.offset).alias("chunk_no"))
    return combos.join(counts, "chunk_no", "left").select(
        "o_orderstatus", "o_orderpriority", "chunk_no", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def split_query_like(spark, sf):
    part = _t(spark, sf, "part")
    return _summary(part, 'part,query,"p_brand",like,p_brand').select("chunk_no", "label", "n")


def split_multi_strategy(spark, sf):
    part = _t(spark, sf, "part")
    plan = plan_table(part, [SplitSpec.parse("part,like,p_name,string,1,a,m"),
                             SplitSpec.parse("part,like,p_name,string,1,n,z")], exactly_once=False)
    return plan.summary(part).select("strategy_no", "chunk_no", "label", "n")


def split_balanced(spark, sf):
    return balanced_groups(_t(spark, sf, "lineitem"), "l_orderkey", 256)


def split_balanced_partitioned(spark, sf):
    return balanced_groups(_t(spark, sf, "lineitem"), "l_orderkey", 16, part="l_returnflag")


def split_balanced_subpartitioned(spark, sf):
    groups = balanced_groups(_t(spark, sf, "lineitem"), "l_orderkey", 16, part=["l_returnflag", "l_linestatus"])
    return groups.select("part.l_returnflag", "part.l_linestatus", "grp", "lo", "hi", "weight")


def balanced_chunk_rows(spark, sf):
    """Every row in the chunk of its partition, sub-partition and key range, ids running on in descending order: rows of each chunk."""
    lines, part = _t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"]
    chunks = balanced_chunk_table(balanced_groups(lines, "l_orderkey", 16, part=part), part=True)
    assigned = assign_balanced(lines, "l_orderkey", chunks, part=part, residual=len(chunks) + 1)
    return assigned.groupBy("chunk_no").agg(F.min("l_returnflag").alias("l_returnflag"), F.min("l_linestatus").alias("l_linestatus"), F.count(F.lit(1)).alias("n"))


def union_batches_q(spark, sf):
    orders = _t(spark, sf, "orders")
    plan = _plan(orders, "orders,between,o_orderkey,number,9")  # windows of 10 keys over MIN..MAX
    assigned = plan.assign(orders)
    return union_batches(assigned, ["o_orderstatus", "o_orderpriority"], "chunk_no", 100)


def split_audit_q(spark, sf):
    orders = _t(spark, sf, "orders")
    plan = _plan(orders, "orders,like,o_custkey,number,1,1,12")
    return split_audit(plan.match_times(orders))


def split_exactly_once(spark, sf):
    """First matching chunk wins; unmatched rows go to the residual chunk."""
    orders = _t(spark, sf, "orders")
    return _summary(orders, "orders,like,o_custkey,number,1,1,12", exactly_once=True).select("chunk_no", "label", "n")


# ------------------------------------------------------------------ exports
def _export_orders(spark, sf, name, tables=("dbo.orders",), **kw):
    kw.setdefault("column_exclusions", (r".*\.o_orderdate",))
    job = _job(spark, name, tables=tables, **kw)
    res = export_database(spark, job, _cat(spark, sf))
    return job, res


def avro_roundtrip(spark, sf):
    job, _ = _export_orders(spark, sf, "roundtrip")
    return _read_back(spark, job.destination).select(*ORDERS_SCAN)


def avro_codecs(spark, sf):
    parts = []
    for codec in ("null", "snappy", "deflate"):
        job, _ = _export_orders(spark, sf, f"codec-{codec}", codec=codec)
        parts.append(_read_back(spark, job.destination).agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum")).select(F.lit(codec).alias("codec"), "n", "key_sum"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def avro_rollover(spark, sf):
    job, _ = _export_orders(spark, sf, "rollover", avro_size=64 * 1024)
    return _read_back(spark, job.destination).select(*ORDERS_SCAN)


YEARLY = "orders,range,o_orderdate,date,12"


def query_stats_q(spark, sf):
    job, res = _export_orders(spark, sf, "stats", split_strategies=(YEARLY,), column_exclusions=())
    return res.stats.select("query_id", "status", "export_row_count")


def table_rollup_q(spark, sf):
    job, res = _export_orders(spark, sf, "rollup", split_strategies=(YEARLY,), column_exclusions=())
    return res.rollup.select(F.col("table").alias("table_name"), "table_query_count", "export_row_count",
                             "db_row_count")


def manifest_json(spark, sf):
    job, res = _export_orders(spark, sf, "manifest", tables=("dbo.orders", "dbo.region"), split_strategies=(YEARLY,))
    m = manifest_tables(spark, res.manifest_path)
    return m.select(F.col("table").alias("table_name"), "table_query_count", "export_row_count", "db_row_count")


def validate_row_counts_q(spark, sf):
    job, res = _export_orders(spark, sf, "validate", tables=("dbo.orders", "dbo.lineitem", "dbo.customer"))
    counts = _cat(spark, sf).row_counts([("dbo", "orders"), ("dbo", "lineitem"), ("dbo", "customer")])
    v = validate_row_counts(res.rollup, counts)
    return v.select(F.col("table").alias("table_name"), "db_row_count", "export_row_count", "mismatch")


def validate_content(spark, sf):
    """Every chunk of lineitem (balanced) and orders (yearly), summed by table: rows as written and as read back, and whether the files hold the values that were read."""
    job, _ = _export_orders(spark, sf, "content", tables=("dbo.orders", "dbo.lineitem"), column_exclusions=(), content_check=True,
                            split_strategies=(YEARLY, "lineitem,between,l_orderkey,number,1000"))
    out = [check_content(spark, job.destination, (None, "dbo", t)).withColumn("table_name", F.lit(t)) for t in ("orders", "lineitem")]
    return out[0].unionByName(out[1]).groupBy("table_name").agg(
        F.sum("rows").alias("n"), F.sum("read_rows").alias("n_read"), F.every("content_match").alias("content_match"))


def failed_chunks(spark, sf):
    """One table of two cannot be split: what is exported of each, next to what is there."""
    job, res = _export_orders(spark, sf, "failed", tables=("dbo.orders", "dbo.part"), continue_on_exception=True,
                              split_strategies=(YEARLY, "part,between,p_nothere,number,10"))
    status = local_df(spark, [(t.schema, t.table, "Completed" if t.ok else "Failed") for t in res.tables],
                      "schema string, table string, status string")
    exported = res.files.groupBy("schema", "table").agg(F.sum("rows").alias("exported"))
    counts = _cat(spark, sf).row_counts([("dbo", "orders"), ("dbo", "part")])
    return (status.join(exported, ["schema", "table"], "left").join(counts, ["schema", "table"])
            .select(F.col("table").alias("table_name"), "status", F.coalesce("exported", F.lit(0).cast("long")).alias("export_row_count"),
                    F.col("row_count").alias("db_row_count")))


def export_all_tables(spark, sf):
    """The whole database with default settings (4 tables at a time): rows exported vs rows at the source."""
    job = _job(spark, "all")
    res = export_database(spark, job, _cat(spark, sf), threads=4)
    return res.rollup.select(F.col("table").alias("table_name"), "export_row_count", "db_row_count")


def pre_post_sql(spark, sf):
    """A view made by the SQL before the export is exported whole; the SQL after it makes another, which is read here."""
    path = f"{sf.rstrip('/')}/orders.parquet"
    job = _job(spark, "prepost", pre_sql=(f"CREATE OR REPLACE TEMP VIEW tx_orders AS SELECT * FROM parquet.`{path}`",),
               post_sql=("CREATE OR REPLACE TEMP VIEW tx_orders_after AS SELECT o_orderstatus, count(*) AS n FROM tx_orders GROUP BY 1",),
               tables=("temp.tx_orders",))
    res = export_database(spark, job, SparkCatalogSource(spark))
    exported = res.rollup.select(F.col("table").alias("table_name"), "export_row_count")
    return exported.crossJoin(F.broadcast(spark.table("tx_orders_after").agg(F.sum("n").alias("rows_after"))))  # one row each


def resume_pending_chunks(spark, sf):
    """A first run exported orders alone; the resumed one leaves its chunks as they are and exports the rest."""
    first, _ = _export_orders(spark, sf, "resume", split_strategies=(YEARLY,))
    job = replace(first, tables=("dbo.orders", "dbo.lineitem", "dbo.region"))
    res = export_database(spark, job, _cat(spark, sf), resume=True)
    files = read_file_index(spark, job.destination).groupBy("table").agg(F.sum("rows").alias("rows_in_files"))
    return (res.rollup.join(files, "table")
            .select(F.col("table").alias("table_name"), "table_query_count", "export_row_count", "rows_in_files"))


def resume_partial_table(spark, sf):
    """A run that stops after one commit of two chunks; the resumed one leaves those as they are. Rows of each chunk and the run that wrote it."""
    job = _job(spark, "partial", tables=("dbo.orders",), split_strategies=(YEARLY,), commit_chunks_files=2, max_commits=1)
    first = export_database(spark, job, _cat(spark, sf), count_rows=False)
    export_database(spark, replace(job, max_commits=0), _cat(spark, sf), resume=True)
    run = F.when(F.col("run_id") == first.tables[0].run_id, 1).otherwise(2)
    return read_file_index(spark, job.destination).groupBy("chunk", run.alias("run_no")).agg(F.sum("rows").alias("rows_in_files"))


# ------------------------------------------------------------------ flagship
def flagship(spark, sf):
    """orders -> yearly split -> ISO date text -> Avro -> per-chunk stats."""
    job = _job(spark, "flagship", tables=("dbo.orders",), split_strategies=(YEARLY,), string_datetime=True,
               flavor="oracle")
    res = export_database(spark, job, _cat(spark, sf))
    return res.stats.select("table", "query_id", "status", "query_file_count", "export_row_count", "total_bytes")


def _counted(listing):
    """A query of the catalog with the rows of the tables that it names."""
    def query(spark, sf):
        named = listing(spark, sf)
        names = [("dbo", r["table_name"]) for r in named.select("table_name").distinct().collect()]
        counts = _cat(spark, sf).row_counts(names).select(F.col("table").alias("table_name"), F.col("row_count").alias("n_rows"))
        return named.join(counts, "table_name")
    return query


def list_schemas_counted(spark, sf):
    counts = _cat(spark, sf).row_counts()
    return list_schemas(spark, sf).join(counts.groupBy(F.col("schema").alias("schema_name")).agg(F.sum("row_count").alias("n_rows")), "schema_name")


QUERIES = {
    "list_schemas": list_schemas_counted,
    "list_tables_priority": _counted(list_tables_priority),
    "tables_existing": _counted(tables_existing),
    "filter_schemas": _counted(filter_schemas),
    "filter_tables": _counted(filter_tables),
    "exclude_tables_regex": _counted(exclude_tables_regex),
    "describe_columns": describe_columns,
    "primary_key_columns": primary_key_columns,
    "exclude_columns_regex": exclude_columns_regex,
    "skip_empty_tables": skip_empty_tables,
    "unsupported_columns": unsupported_columns,
    "table_row_counts": table_row_counts,
    "list_partitions": list_partitions,
    "scan_table": scan_table,
    "scan_chunks": scan_chunks,
    "project_exportable": project_exportable,
    "datetime_string_seconds": datetime_string_seconds,
    "datetime_string_126": datetime_string_126,
    "tidy_names": tidy_names,
    "filename_pattern": filename_pattern,
    "chunk_ids": chunk_ids,
    "split_number_between": split_number_between,
    "split_number_between_auto": split_number_between_auto,
    "split_number_auto_increment": split_number_auto_increment,
    "split_number_like": split_number_like,
    "split_prefix_like": split_prefix_like,
    "split_digit_catch_all": split_digit_catch_all,
    "split_string_like": split_string_like,
    "split_date_yearly": split_date_yearly,
    "split_date_monthly": split_date_monthly,
    "split_distinct_combos": split_distinct_combos,
    "split_query_like": split_query_like,
    "split_multi_strategy": split_multi_strategy,
    "split_balanced": split_balanced,
    "split_balanced_partitioned": split_balanced_partitioned,
    "split_balanced_subpartitioned": split_balanced_subpartitioned,
    "balanced_chunk_rows": balanced_chunk_rows,
    "split_choice": _counted(split_choice),
    "union_batches": union_batches_q,
    "split_audit": split_audit_q,
    "split_exactly_once": split_exactly_once,
    "avro_roundtrip": avro_roundtrip,
    "avro_codecs": avro_codecs,
    "avro_rollover": avro_rollover,
    "manifest_json": manifest_json,
    "query_stats": query_stats_q,
    "table_rollup": table_rollup_q,
    "validate_row_counts": validate_row_counts_q,
    "validate_content": validate_content,
    "failed_chunks": failed_chunks,
    "pre_post_sql": pre_post_sql,
    "export_all_tables": export_all_tables,
    "resume_pending_chunks": resume_pending_chunks,
    "resume_partial_table": resume_partial_table,
}
