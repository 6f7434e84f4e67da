"""Selection and introspection operators over catalog metadata frames.

All inputs are the small metadata DataFrames of ``sources.catalog``
(``tables``: catalog, schema, table, path; ``columns``: ..., column,
jdbc_type, vendor_type, is_key, supported). Regexes are Java regexes run
by Spark (``rlike``), case-insensitive and anchored at both ends — a full
match, as the export tool's filters are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from ..session import local_df


def full_match_any(text: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """True when ``text`` fully matches any pattern, ignoring case."""
    cond = F.lit(False)
    for p in patterns:
        cond = cond | text.rlike(f"(?i)^(?:{p})$")
    return cond


def qualified(*parts: str) -> Column:
    return F.concat_ws(".", *[F.col(p) for p in parts])


# ------------------------------------------------------------------ tables
def filter_schemas(tables: DataFrame, schemas: list[str] | tuple[str, ...]) -> DataFrame:
    """Exact schema whitelist; empty keeps all."""
    return tables if not schemas else tables.filter(F.col("schema").isin(*schemas))


def filter_tables(tables: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """Exact ``schema.table`` whitelist; empty keeps all."""
    return tables if not names else tables.filter(qualified("schema", "table").isin(*names))


def exclude_tables(tables: DataFrame, patterns: list[str] | tuple[str, ...]) -> DataFrame:
    """Drop tables whose ``schema.table`` fully matches an exclusion regex."""
    return tables if not patterns else tables.filter(~full_match_any(qualified("schema", "table"), patterns))


def wish_list(tables: DataFrame, priorities, split_tables) -> DataFrame:
    """Priority names, then split names, per schema; first occurrence wins.

    Returns ``schema, table, wish_rank`` (1-based, over both lists)."""
    spark = tables.sparkSession
    rows, rank = [], 0
    for name in list(priorities) + list(split_tables):
        if "." not in name:
            continue
        sch, tab = name.split(".", 1)
        rank += 1
        rows.append((sch, tab, rank))
    wl = local_df(spark, rows, "schema string, table string, wish_rank int")
    return wl.groupBy("schema", "table").agg(F.min("wish_rank").alias("wish_rank"))


def tables_existing(tables: DataFrame, priorities, split_tables) -> DataFrame:
    """The wished-for tables that exist in the catalog (others dropped)."""
    wl = wish_list(tables, priorities, split_tables)
    return wl.join(tables.select("schema", "table"), ["schema", "table"], "left_semi")


def prioritized_tables(tables: DataFrame, priorities=(), split_tables=()) -> DataFrame:
    """Tables in export order: priority names, split names, then the rest by name.

    Adds ``priority`` (1-based, bigint). Names that do not exist are not kept."""
    wl = wish_list(tables, priorities, split_tables)
    t = tables.join(wl, ["schema", "table"], "left")
    w = Window.partitionBy("schema").orderBy(F.col("wish_rank").asc_nulls_last(), F.col("table"))
    return t.withColumn("priority", F.row_number().over(w).cast("long")).drop("wish_rank")


# ------------------------------------------------------------------ columns
def mark_excluded(columns: DataFrame, patterns: list[str] | tuple[str, ...]) -> DataFrame:
    """Add ``excluded`` (full match on schema.table.column) and ``exportable``."""
    excl = full_match_any(qualified("schema", "table", "column"), patterns) if patterns else F.lit(False)
    return columns.withColumn("excluded", excl).withColumn("exportable", F.col("supported") & ~F.col("excluded"))


def primary_key_columns(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Flag key columns by name from a key metadata frame (schema, table, column)."""
    k = keys.select("schema", "table", "column").distinct().withColumn("_k", F.lit(True))
    return (columns.drop("is_key").join(k, ["schema", "table", "column"], "left")
            .withColumn("is_key", F.coalesce(F.col("_k"), F.lit(False))).drop("_k"))


def table_exportability(columns: DataFrame) -> DataFrame:
    """Per table: number of exportable columns and whether it is exported at all."""
    marked = columns if "exportable" in columns.columns else columns.withColumn("exportable", F.col("supported"))
    return (marked.groupBy("catalog", "schema", "table")
            .agg(F.sum(F.col("exportable").cast("int")).cast("long").alias("exportable_columns"),
                 F.bool_or("exportable").alias("exported")))


def skip_empty_tables(columns: DataFrame) -> DataFrame:
    """Tables that have no exportable column (skipped with a warning)."""
    return table_exportability(columns).filter(~F.col("exported")).select("catalog", "schema", "table")


def unsupported_columns(columns: DataFrame) -> DataFrame:
    """Per table, the ``name (vendorType,jdbcType)`` list of unsupported columns."""
    item = F.concat(F.col("column"), F.lit(" ("), F.col("vendor_type"), F.lit(","), F.col("jdbc_type").cast("string"), F.lit(")"))
    return (columns.filter(~F.col("supported"))
            .groupBy("catalog", "schema", "table")
            .agg(F.array_join(F.sort_array(F.collect_list(F.struct(F.col("ordinal"), item.alias("s")))).getField("s"), ", ")
                 .alias("unsupported")))


def exportable_columns(columns: DataFrame, schema: str, table: str) -> list[str]:
    """Driver-side: the exportable column names of one table in catalog order."""
    rows = (columns.filter((F.col("schema") == schema) & (F.col("table") == table) & F.col("exportable"))
            .select("ordinal", "column").collect())
    return [r["column"] for r in sorted(rows, key=lambda r: r["ordinal"])]


# ------------------------------------------------------------------ partitions
def list_partitions(df: DataFrame, part_col: str, sub_col: str | None = None) -> DataFrame:
    """Distinct (partition, sub-partition) values with a position: 1 = highest partition value.

    Positions come from the distributed numbering helper (no single-task
    window); the join is left to AQE, which broadcasts it when it is small."""
    from .numbering import global_row_number
    cols = [F.col(f"`{part_col}`").alias("part")] + ([F.col(f"`{sub_col}`").alias("sub_part")] if sub_col else [])
    d = df.select(*cols).distinct()
    parts = global_row_number(d.select("part").distinct(), [F.col("part").desc_nulls_last()], "position")
    return d.join(parts, d["part"].eqNullSafe(parts["part"])).select(d["part"], *([d["sub_part"]] if sub_col else []),
                                                                    parts["position"])


def partition_flags(source, tables: list[tuple[str, str]] | None = None) -> DataFrame:
    """Per table: partition columns and the ``partitioned`` / ``sub_partitioned`` flags
    (one or two levels of partitioning), from sources that know their partitions."""
    from ..session import local_df
    todo = tables or [(r["schema"], r["table"]) for r in source.tables().select("schema", "table").collect()]
    rows = []
    for schema, table in todo:
        cols = source.partition_columns(schema, table) if hasattr(source, "partition_columns") else []
        rows.append((schema, table, list(cols), len(cols) >= 1, len(cols) >= 2))
    return local_df(source.spark, rows, "schema string, table string, partition_columns array<string>, "
                                        "partitioned boolean, sub_partitioned boolean")
