"""Catalog sources: what schemas, tables and columns exist.

Two sources give the same metadata DataFrames:

* ``DirectoryCatalog`` — a folder of Parquet tables is a database:
  ``root/<table>.parquet`` belongs to the default schema,
  ``root/<schema>/<table>.parquet`` to ``<schema>``. Column metadata comes
  from each table's footer schema (no data read).
* ``JdbcCatalog`` — INFORMATION_SCHEMA / data-dictionary queries read with
  Spark's JDBC source (SQL Server and Oracle flavors).

Metadata frames (small: one row per table or column):

* tables:  ``catalog, schema, table, path``
* columns: ``catalog, schema, table, ordinal, column, jdbc_type, vendor_type,
  is_key, supported``
"""

from __future__ import annotations

import itertools
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from ..session import local_df, session_wall_clock

# Java.sql.Types codes.
JDBC = {
    "BIT": -7, "TINYINT": -6, "SMALLINT": 5, "INTEGER": 4, "BIGINT": -5, "FLOAT": 6, "REAL": 7, "DOUBLE": 8,
    "NUMERIC": 2, "DECIMAL": 3, "CHAR": 1, "VARCHAR": 12, "LONGVARCHAR": -1, "DATE": 91, "TIME": 92,
    "TIMESTAMP": 93, "BINARY": -2, "VARBINARY": -3, "LONGVARBINARY": -4, "NULL": 0, "OTHER": 1111,
    "JAVA_OBJECT": 2000, "DISTINCT": 2001, "STRUCT": 2002, "ARRAY": 2003, "BLOB": 2004, "CLOB": 2005,
    "REF": 2006, "DATALINK": 70, "BOOLEAN": 16, "ROWID": -8, "NCHAR": -15, "NVARCHAR": -9,
    "LONGNVARCHAR": -16, "NCLOB": 2011, "SQLXML": 2009, "REF_CURSOR": 2012, "TIME_WITH_TIMEZONE": 2013,
    "TIMESTAMP_WITH_TIMEZONE": 2014,
}

# The JDBC types an export accepts (everything else is reported and dropped).
SUPPORTED_TYPES = (
    "BIGINT", "BINARY", "BIT", "BLOB", "CHAR", "CLOB", "DATE", "DECIMAL", "DOUBLE", "FLOAT", "INTEGER",
    "LONGNVARCHAR", "LONGVARBINARY", "LONGVARCHAR", "NCHAR", "NCLOB", "NUMERIC", "NVARCHAR", "REAL",
    "SMALLINT", "TIMESTAMP", "TINYINT", "VARBINARY", "VARCHAR",
)
SUPPORTED_CODES = tuple(JDBC[n] for n in SUPPORTED_TYPES)

TABLES_SCHEMA = "catalog string, schema string, table string, path string"
COLUMNS_SCHEMA = ("catalog string, schema string, table string, ordinal int, column string, jdbc_type int, "
                  "vendor_type string, is_key boolean, supported boolean")


def jdbc_type_of(dt: T.DataType) -> int:
    """java.sql.Types code that Spark's JDBC writer would pick for a Spark type."""
    if isinstance(dt, T.LongType):
        return JDBC["BIGINT"]
    if isinstance(dt, T.IntegerType):
        return JDBC["INTEGER"]
    if isinstance(dt, T.ShortType):
        return JDBC["SMALLINT"]
    if isinstance(dt, T.ByteType):
        return JDBC["TINYINT"]
    if isinstance(dt, T.BooleanType):
        return JDBC["BIT"]
    if isinstance(dt, T.DoubleType):
        return JDBC["DOUBLE"]
    if isinstance(dt, T.FloatType):
        return JDBC["REAL"]
    if isinstance(dt, T.DecimalType):
        return JDBC["DECIMAL"]
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return JDBC["VARCHAR"]
    if isinstance(dt, T.BinaryType):
        return JDBC["VARBINARY"]
    if isinstance(dt, T.DateType):
        return JDBC["DATE"]
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return JDBC["TIMESTAMP"]
    if isinstance(dt, T.ArrayType):
        return JDBC["ARRAY"]
    if isinstance(dt, (T.StructType, T.MapType)):
        return JDBC["STRUCT"]
    return JDBC["OTHER"]


def is_supported_code(code: int) -> bool:
    return code in SUPPORTED_CODES


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, bool, str]]:
    """(name, is_dir, full path) of the entries of a folder, through the same Hadoop
    FileSystem Spark reads with (hdfs://, s3a://, abfss://, file:...); local fallback."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        return sorted((st.getPath().getName(), bool(st.isDirectory()), st.getPath().toString())
                      for st in fs.listStatus(p))
    except Exception:  # noqa: BLE001 - no JVM gateway (remote session): plain local listing
        local = path[len("file:"):] if path.startswith("file:") else path
        return sorted((e, os.path.isdir(os.path.join(local, e)), os.path.join(local, e)) for e in os.listdir(local))


class DirectoryCatalog:
    """A folder of Parquet tables as a database.

    A table is a ``<name>.parquet`` file or folder, or a folder holding
    ``part-*`` data files, ``k=v`` partition folders or ``_SUCCESS``.
    Any other folder at the top level is a schema holding tables. Tables
    directly under the root belong to ``default_schema``. Hive-style
    partition folders are reported by ``partition_columns``."""

    def __init__(self, spark: SparkSession, root: str, *, catalog: str | None = None, default_schema: str = "dbo",
                 primary_keys: dict | None = None, extension: str = ".parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog = catalog
        self.default_schema = default_schema
        self.primary_keys = {k.lower(): [c for c in v] for k, v in (primary_keys or {}).items()}
        self.extension = extension
        self._tables: list[tuple] | None = None

    # ------------------------------------------------------------- listing
    def _table_name(self, name: str, is_dir: bool, full: str) -> str | None:
        if name.startswith(("_", ".")):
            return None
        if name.endswith(self.extension):
            return name[: -len(self.extension)]
        if not is_dir:
            return None
        kids = list_dir(self.spark, full)
        if any(n == "_SUCCESS" or (d and "=" in n) or (not d and n.startswith("part-")) for n, d, _ in kids):
            return name  # a Spark-written table folder
        return None  # a schema folder (its *.parquet entries are tables)

    def _scan(self) -> list[tuple]:
        if self._tables is None:
            found = []
            for name, is_dir, full in list_dir(self.spark, self.root):
                t = self._table_name(name, is_dir, full)
                if t is not None:
                    found.append((self.catalog, self.default_schema, t, full))
                elif is_dir and not name.startswith(("_", ".")):
                    for sub, sdir, sfull in list_dir(self.spark, full):
                        st = self._table_name(sub, sdir, sfull)
                        if st is not None:
                            found.append((self.catalog, name, st, sfull))
            self._tables = found
        return self._tables

    def partition_columns(self, schema: str, table: str) -> list[str]:
        """Hive-style partition columns of a table folder (outermost first)."""
        cols, path = [], self.path(schema, table)
        while True:
            try:
                kids = [(n, f) for n, d, f in list_dir(self.spark, path) if d and "=" in n and not n.startswith(("_", "."))]
            except Exception:  # noqa: BLE001 - a plain file
                return cols
            if not kids:
                return cols
            cols.append(kids[0][0].split("=", 1)[0])
            path = kids[0][1]

    def schemas(self) -> DataFrame:
        rows = sorted({(c, s) for c, s, _, _ in self._scan()}, key=lambda r: r[1])
        return local_df(self.spark, rows, "catalog string, schema string")

    def tables(self) -> DataFrame:
        return local_df(self.spark, self._scan(), TABLES_SCHEMA)

    def path(self, schema: str, table: str) -> str:
        for c, s, t, p in self._scan():
            if s == schema and t == table:
                return p
        raise KeyError(f"{schema}.{table} not in catalog")

    def read(self, schema: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(schema, table))

    def keys_of(self, schema: str, table: str) -> list[str]:
        return self.primary_keys.get(f"{schema}.{table}".lower(), self.primary_keys.get(table.lower(), []))

    # ------------------------------------------------------------- columns
    def column_rows(self, tables: list[tuple[str, str]] | None = None) -> list[tuple]:
        rows = []
        want = None if tables is None else set(tables)
        for c, s, t, p in self._scan():
            if want is not None and (s, t) not in want:
                continue
            keys = set(self.keys_of(s, t))
            for i, f in enumerate(self.spark.read.parquet(p).schema.fields, start=1):
                code = jdbc_type_of(f.dataType)
                rows.append((c, s, t, i, f.name, code, f.dataType.simpleString(), f.name in keys,
                             is_supported_code(code)))
        return rows

    def columns(self, tables: list[tuple[str, str]] | None = None) -> DataFrame:
        """Column metadata of every table, or only of ``tables`` [(schema, table)]."""
        return local_df(self.spark, self.column_rows(tables), COLUMNS_SCHEMA)

    def row_counts(self, tables: list[tuple[str, str]] | None = None) -> DataFrame:
        """Row count per table (Parquet: the scan reads footers/no columns)."""
        todo = tables or [(s, t) for _, s, t, _ in self._scan()]
        parts = [self.read(s, t).agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit(self.catalog).cast("string").alias("catalog"), F.lit(s).alias("schema"),
                         F.lit(t).alias("table"), "row_count") for s, t in todo]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


# ---------------------------------------------------------------- JDBC
# Vendor type names -> java.sql.Types, for the data-dictionary readers.
SQLSERVER_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "bit": "BIT",
    "decimal": "DECIMAL", "numeric": "NUMERIC", "money": "DECIMAL", "smallmoney": "DECIMAL", "float": "DOUBLE",
    "real": "REAL", "char": "CHAR", "varchar": "VARCHAR", "text": "LONGVARCHAR", "nchar": "NCHAR",
    "nvarchar": "NVARCHAR", "ntext": "LONGNVARCHAR", "binary": "BINARY", "varbinary": "VARBINARY",
    "image": "LONGVARBINARY", "date": "DATE", "datetime": "TIMESTAMP", "datetime2": "TIMESTAMP",
    "smalldatetime": "TIMESTAMP", "time": "TIME", "datetimeoffset": "TIMESTAMP_WITH_TIMEZONE",
    "uniqueidentifier": "CHAR", "xml": "LONGNVARCHAR", "timestamp": "BINARY", "rowversion": "BINARY",
}
ORACLE_TYPES = {
    "NUMBER": "DECIMAL", "FLOAT": "FLOAT", "BINARY_FLOAT": "REAL", "BINARY_DOUBLE": "DOUBLE", "CHAR": "CHAR",
    "VARCHAR2": "VARCHAR", "NCHAR": "NCHAR", "NVARCHAR2": "NVARCHAR", "CLOB": "CLOB", "NCLOB": "NCLOB",
    "LONG": "LONGVARCHAR", "RAW": "VARBINARY", "LONG RAW": "LONGVARBINARY", "BLOB": "BLOB", "DATE": "TIMESTAMP",
    "TIMESTAMP": "TIMESTAMP", "ROWID": "ROWID", "XMLTYPE": "SQLXML",
}

SQLSERVER_COLUMNS_SQL = """
SELECT c.TABLE_CATALOG AS catalog, c.TABLE_SCHEMA AS schema_name, c.TABLE_NAME AS table_name,
       c.ORDINAL_POSITION AS ordinal, c.COLUMN_NAME AS column_name, c.DATA_TYPE AS vendor_type,
       CASE WHEN k.COLUMN_NAME IS NULL THEN 0 ELSE 1 END AS is_key
FROM INFORMATION_SCHEMA.COLUMNS c
JOIN INFORMATION_SCHEMA.TABLES t
  ON t.TABLE_CATALOG = c.TABLE_CATALOG AND t.TABLE_SCHEMA = c.TABLE_SCHEMA AND t.TABLE_NAME = c.TABLE_NAME
 AND t.TABLE_TYPE = 'BASE TABLE'
LEFT JOIN (SELECT ku.TABLE_SCHEMA, ku.TABLE_NAME, ku.COLUMN_NAME
             FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS tc
             JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE ku
               ON tc.CONSTRAINT_NAME = ku.CONSTRAINT_NAME AND tc.TABLE_SCHEMA = ku.TABLE_SCHEMA
            WHERE tc.CONSTRAINT_TYPE = 'PRIMARY KEY') k
  ON k.TABLE_SCHEMA = c.TABLE_SCHEMA AND k.TABLE_NAME = c.TABLE_NAME AND k.COLUMN_NAME = c.COLUMN_NAME
"""

ORACLE_COLUMNS_SQL = """
SELECT NULL AS catalog, c.OWNER AS schema_name, c.TABLE_NAME AS table_name, c.COLUMN_ID AS ordinal,
       c.COLUMN_NAME AS column_name, c.DATA_TYPE AS vendor_type,
       CASE WHEN k.COLUMN_NAME IS NULL THEN 0 ELSE 1 END AS is_key
FROM ALL_TAB_COLUMNS c
JOIN ALL_TABLES t ON t.OWNER = c.OWNER AND t.TABLE_NAME = c.TABLE_NAME
LEFT JOIN (SELECT cc.OWNER, cc.TABLE_NAME, cc.COLUMN_NAME
             FROM ALL_CONSTRAINTS ac JOIN ALL_CONS_COLUMNS cc
               ON ac.OWNER = cc.OWNER AND ac.CONSTRAINT_NAME = cc.CONSTRAINT_NAME
            WHERE ac.CONSTRAINT_TYPE = 'P') k
  ON k.OWNER = c.OWNER AND k.TABLE_NAME = c.TABLE_NAME AND k.COLUMN_NAME = c.COLUMN_NAME
"""

def sqlserver_row_counts_sql(catalog: str | None) -> str:
    """Rows by object from the partition metadata of a catalog (the connection's own when none is named)."""
    from .jdbc import Dialect

    d = Dialect("sqlserver")
    where = f"{d.ident(catalog)}." if catalog else ""
    db = f", DB_ID({d.string(catalog)})" if catalog else ""
    return (f"SELECT OBJECT_SCHEMA_NAME(object_id{db}) AS schema_name, OBJECT_NAME(object_id{db}) AS table_name, SUM(rows) AS row_count "
            f"FROM {where}sys.partitions WHERE index_id < 2 GROUP BY object_id")


ORACLE_PARTITIONS_SQL = """
SELECT p.TABLE_OWNER AS schema_name, p.TABLE_NAME AS table_name, p.PARTITION_NAME AS partition_name,
       p.PARTITION_POSITION AS position, s.SUBPARTITION_NAME AS subpartition_name, s.SUBPARTITION_POSITION AS subposition
FROM ALL_TAB_PARTITIONS p
LEFT JOIN ALL_TAB_SUBPARTITIONS s
  ON s.TABLE_OWNER = p.TABLE_OWNER AND s.TABLE_NAME = p.TABLE_NAME AND s.PARTITION_NAME = p.PARTITION_NAME
"""

def sqlserver_partitions_sql(catalog: str | None) -> str:
    """The storage partitions of heaps and clustered indexes, with the function and column that say where a row is."""
    from .jdbc import Dialect

    sys = (f"{Dialect('sqlserver').ident(catalog)}." if catalog else "") + "sys"
    return (f"SELECT s.name AS schema_name, t.name AS table_name, p.partition_number AS position, f.name AS function_name, c.name AS column_name "
            f"FROM {sys}.partitions p JOIN {sys}.tables t ON t.object_id = p.object_id JOIN {sys}.schemas s ON s.schema_id = t.schema_id "
            f"JOIN {sys}.indexes i ON i.object_id = p.object_id AND i.index_id = p.index_id "
            f"JOIN {sys}.partition_schemes ps ON ps.data_space_id = i.data_space_id JOIN {sys}.partition_functions f ON f.function_id = ps.function_id "
            f"JOIN {sys}.index_columns ic ON ic.object_id = i.object_id AND ic.index_id = i.index_id AND ic.partition_ordinal = 1 "
            f"JOIN {sys}.columns c ON c.object_id = ic.object_id AND c.column_id = ic.column_id WHERE p.index_id < 2")


@dataclass(frozen=True)
class Stored:
    """One storage partition (or sub-partition) of a database table: named behind the table (``scope``), or where ``number_sql``, of ``column``, is ``number``."""

    label: str
    scope: str = ""
    number_sql: str = ""
    number: int = 0
    column: str = ""

    @property
    def condition(self) -> str:
        return f"{self.number_sql} = {self.number}" if self.number_sql else ""


STORED_BATCH = 100  # storage partitions counted in one query, where each is a scan of its own


class JdbcCatalog:
    """A live database through Spark's JDBC source (needs a reachable server).

    Metadata comes from the data dictionary; planning questions (MIN/MAX,
    DISTINCT, balanced groups) are pushed to the database as queries; chunked
    reads run one predicate per Spark task (``read_chunks``)."""

    def __init__(self, spark: SparkSession, url: str, properties: dict | None = None, flavor: str = "sqlserver",
                 catalog: str | None = None, fetch_size: int = 2000, dirty_reads: bool = False, snapshot: bool | int = False):
        if snapshot and dirty_reads:
            raise ValueError("snapshot and dirty_reads exclude each other")
        self.snapshot, self._moment = snapshot, ""
        self.spark, self.url, self.props, self.flavor = spark, url, dict(properties or {}), flavor
        self.catalog, self.fetch_size = catalog, fetch_size
        if dirty_reads and flavor == "sqlserver":
            # the portable form of a NOLOCK hint: every chunk connection reads uncommitted
            self.props.setdefault("sessionInitStatement", "SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED")

    @property
    def dialect(self):
        from .jdbc import Dialect
        return Dialect(self.flavor)

    def qualified(self, schema: str, table: str, scope: str = "") -> str:
        """The table as a query names it: of a storage partition, and at the pinned moment, if there are such."""
        d = self.dialect
        catalog = f"{d.ident(self.catalog)}." if self.catalog and self.flavor == "sqlserver" else ""
        return f"{catalog}{d.ident(schema)}.{d.ident(table)}{scope}{self._moment}"

    def pin(self) -> str | None:
        """Let all further queries see one moment (``snapshot``); what it is called, for the manifest.

        Oracle: every query reads AS OF the present system change number, or the one given as ``snapshot``. SQL Server: each
        connection reads under SNAPSHOT isolation, so a chunk is consistent by itself; for one moment of all of them name a
        database snapshot as ``catalog``."""
        if not self.snapshot:
            return None
        if self.flavor == "oracle":
            number = self.snapshot if self.snapshot is not True else \
                int(self._query("SELECT DBMS_FLASHBACK.GET_SYSTEM_CHANGE_NUMBER AS SCN FROM DUAL").collect()[0][0])
            self._moment = f" AS OF SCN {int(number)}"
            return f"SCN {int(number)}"
        if self.flavor == "sqlserver":
            self.props["sessionInitStatement"] = "SET TRANSACTION ISOLATION LEVEL SNAPSHOT"
            return "SNAPSHOT"
        raise ValueError(f"no snapshot reads for {self.flavor}")

    def _props(self) -> dict:
        p = dict(self.props)
        p.setdefault("fetchsize", str(self.fetch_size))
        return p

    def check_connection(self, attempts: int = 1, wait_seconds: float = 5.0) -> None:
        """Fail fast when the database does not answer (polled ``attempts`` times)."""
        from .jdbc import check_connection
        check_connection(self.spark, self.url, self.props, attempts, wait_seconds, self.flavor)

    def chunk_sql(self, schema: str, table: str, columns: list[str], predicate: str | None) -> str:
        """The SQL text a chunk stands for (reported in the manifest)."""
        from .jdbc import scope_of

        d = self.dialect
        scope, predicate = scope_of(predicate)
        sql = f"SELECT {', '.join(d.ident(c) for c in columns)} FROM {self.qualified(schema, table, scope)}"
        return sql if not predicate else f"{sql} WHERE {predicate}"

    def read(self, schema: str, table: str, columns: list[str] | None = None) -> DataFrame:
        """The whole table as one query (the unsplit export), one partition; only ``columns`` are asked for."""
        if not columns:
            return self._read_predicates(self.qualified(schema, table), ["1 = 1"])
        cols = ", ".join(self.dialect.ident(c) for c in columns)
        return self._read_predicates(f"(SELECT {cols} FROM {self.qualified(schema, table)}) tx_q", ["1 = 1"])

    def bounds(self, schema: str, table: str, columns: list[str]) -> dict:
        """MIN/MAX of several columns in ONE query run by the database."""
        d = self.dialect
        sel = ", ".join(f"MIN({d.ident(c)}) AS lo{i}, MAX({d.ident(c)}) AS hi{i}" for i, c in enumerate(columns))
        df = self._query(f"SELECT {sel} FROM {self.qualified(schema, table)}")
        row, types = df.collect()[0], {f.name: f.dataType for f in df.schema.fields}
        return {c: (session_wall_clock(self.spark, row[f"lo{i}"], types.get(f"lo{i}")),
                    session_wall_clock(self.spark, row[f"hi{i}"], types.get(f"hi{i}"))) for i, c in enumerate(columns)}

    def distinct(self, schema: str, table: str, columns: list[str]) -> DataFrame:
        """``SELECT DISTINCT`` run by the database."""
        d = self.dialect
        cols = ", ".join(d.ident(c) for c in columns)
        return self._query(f"SELECT DISTINCT {cols} FROM {self.qualified(schema, table)}")

    def balanced_groups(self, schema: str, table: str, key: str, n: int, parts: list[str] = ()) -> DataFrame:
        """``[part,] grp, lo, hi, weight``: at most ``n`` key ranges of about equal row counts per partition value.

        The database counts, sums in key order and cuts; a row for each group is fetched, never one for each key."""
        d = self.dialect
        over = ", ".join(f"tx_p{i}" for i in range(len(parts)))
        by = f"PARTITION BY {over} " if parts else ""
        cols = "".join(f"{d.ident(p)} AS tx_p{i}, " for i, p in enumerate(parts))
        lead = f"{over}, " if parts else ""
        names = ", ".join(d.ident(c) for c in [*parts, key])
        counted = f"SELECT {cols}{d.ident(key)} AS tx_k, {d.count()} AS tx_w FROM {self.qualified(schema, table)} WHERE {d.ident(key)} IS NOT NULL GROUP BY {names}"
        got = self._query(self._cut_sql(counted, lead, by, n))
        got = got.toDF(*[c.lower() for c in got.columns])  # Oracle gives names back in capitals
        part = [F.struct(*[F.col(f"tx_p{i}").alias(p) for i, p in enumerate(parts)]).alias("part")] if len(parts) > 1 else [F.col("tx_p0").alias("part")] if parts else []
        return got.select(*part, F.col("tx_grp").cast("long").alias("grp"), F.col("tx_lo").alias("lo"), F.col("tx_hi").alias("hi"), F.col("tx_weight").cast("long").alias("weight"))

    def _cut_sql(self, counted: str, lead: str, by: str, n: int) -> str:
        """A query for the groups of keys that ``counted`` gives with their rows (tx_k, tx_w)."""
        summed = (f"SELECT {lead}tx_k, tx_w, SUM(tx_w) OVER ({by}ORDER BY tx_k ROWS UNBOUNDED PRECEDING) AS tx_cum, "
                  f"SUM(tx_w) OVER ({by.strip()}) AS tx_total FROM ({counted}) tx_a")
        cut = f"SELECT {lead}tx_k, tx_w, {self.dialect.whole_part(f'(tx_cum * 100 - 1) * {int(n)}', 'tx_total * 100')} AS tx_grp FROM ({summed}) tx_b"
        return f"SELECT {lead}tx_grp, MIN(tx_k) AS tx_lo, MAX(tx_k) AS tx_hi, SUM(tx_w) AS tx_weight FROM ({cut}) tx_c GROUP BY {lead}tx_grp"

    def storage_partitions(self, schema: str, table: str) -> list[Stored]:
        """The partitions, or sub-partitions where there are any, that the database keeps a table in; the last position first."""
        d = self.dialect
        if self.flavor not in ("oracle", "sqlserver"):
            return []
        rows = [{k.lower(): v for k, v in r.asDict().items()} for r in
                self._query(f"SELECT * FROM ({self._partitions_sql()}) d WHERE d.schema_name = {d.string(schema)} AND d.table_name = {d.string(table)}").collect()]
        rows.sort(key=lambda r: (-r["position"], -(r.get("subposition") or 0)))
        if self.flavor == "sqlserver":
            database = f"{d.ident(self.catalog)}." if self.catalog else ""
            number = lambda r: f"{database}$PARTITION.{d.ident(r['function_name'])}({d.ident(r['column_name'])})"
            return [Stored(f"partition {r['position']}", "", number(r), int(r["position"]), r["column_name"]) for r in rows]
        named = lambda r: ("SUBPARTITION", r["subpartition_name"]) if r["subpartition_name"] is not None else ("PARTITION", r["partition_name"])
        return [Stored(f"{kind.lower()} {name}", f" {kind} ({d.ident(name)})") for kind, name in map(named, rows)]

    def stored_groups(self, schema: str, table: str, key: str, n: int, stored: list[Stored]) -> dict[int, list[tuple]]:
        """place in ``stored`` -> (lo, hi, weight) of at most ``n`` key ranges each, in key order; partitions without a key have none.

        A partition that a function names is a value to group by, one query for all; a named one is a scan of itself,
        STORED_BATCH of them to a query."""
        d = self.dialect
        k = d.ident(key)
        counted = []
        if stored and stored[0].number_sql:
            place = {x.number: i for i, x in enumerate(stored)}
            by = stored[0].number_sql
            counted = [f"SELECT {by} AS tx_p0, {k} AS tx_k, {d.count()} AS tx_w FROM {self.qualified(schema, table)} WHERE {k} IS NOT NULL GROUP BY {by}, {k}"]
        else:
            place = {i: i for i in range(len(stored))}
            one = [f"SELECT {i} AS tx_p0, {k} AS tx_k, {d.count()} AS tx_w FROM {self.qualified(schema, table, x.scope)} WHERE {k} IS NOT NULL GROUP BY {k}"
                   for i, x in enumerate(stored)]
            counted = [" UNION ALL ".join(one[i:i + STORED_BATCH]) for i in range(0, len(one), STORED_BATCH)]
        out: dict[int, list[tuple]] = {}
        for sql in counted:
            got = self._query(self._cut_sql(sql, "tx_p0, ", "PARTITION BY tx_p0 ", n))
            rows = got.toDF(*[c.lower() for c in got.columns]).collect()  # at most n for each partition
            for r in sorted(rows, key=lambda r: (r["tx_p0"], r["tx_grp"])):
                if int(r["tx_p0"]) in place:
                    out.setdefault(place[int(r["tx_p0"])], []).append((r["tx_lo"], r["tx_hi"], int(r["tx_weight"])))
        return out

    def _read_predicates(self, source_sql: str, preds: list[str]) -> DataFrame:
        """One JDBC partition per predicate, in order (isolated for tests)."""
        return self.spark.read.jdbc(self.url, source_sql, predicates=preds, properties=self._props())

    def read_chunks(self, schema: str, table: str, numbered_preds: list[tuple[int, str]], columns: list[str],
                    chunk_col: str = "_tx_chunk", key_columns: list[str] = ()) -> DataFrame:
        """Exported columns of every chunk; partition i holds predicate i, so the
        chunk number is looked up from the partition id (no shuffle). The
        predicates' key columns travel too (the caller's projection drops them)."""
        from .jdbc import scope_of

        d = self.dialect
        wanted = list(columns) + [k for k in key_columns if k not in columns]
        cols = ", ".join(d.ident(c) for c in wanted)
        scoped = [(no, *scope_of(p)) for no, p in numbered_preds]
        out = None
        for scope, chunks in itertools.groupby(scoped, lambda c: c[1]):  # a storage partition is a table of its own
            chunks = list(chunks)
            df = self._read_predicates(f"(SELECT {cols} FROM {self.qualified(schema, table, scope)}) tx_q", [p for _, _, p in chunks])
            nos = F.array(*[F.lit(int(no)).cast("long") for no, _, _ in chunks])
            df = df.withColumn(chunk_col, F.element_at(nos, F.spark_partition_id() + 1))
            out = df if out is None else out.union(df)
        return out

    def _query(self, sql: str) -> DataFrame:
        return (self.spark.read.format("jdbc").option("url", self.url).option("query", sql)
                .options(**self._props()).load())

    def columns(self, tables: list[tuple[str, str]] | None = None) -> DataFrame:
        """Column metadata from the data dictionary; with ``tables`` (up to 1,000 pairs) the
        database filters the dictionary to those tables."""
        sql, types = (SQLSERVER_COLUMNS_SQL, SQLSERVER_TYPES) if self.flavor == "sqlserver" else \
            (ORACLE_COLUMNS_SQL, ORACLE_TYPES)
        if tables and len(tables) <= 1000:
            d = self.dialect
            cond = " OR ".join(f"(d.schema_name = {d.string(sc)} AND d.table_name = {d.string(tb)})" for sc, tb in tables)
            sql = f"SELECT * FROM ({sql}) d WHERE {cond}"
        raw = self._query(sql)
        mapping = F.create_map(*[x for k, v in types.items() for x in (F.lit(k), F.lit(JDBC[v]))])
        vt = F.col("vendor_type")
        name = F.lower(vt) if self.flavor == "sqlserver" else F.regexp_replace(vt, r"\([^)]*\)", "")  # the length alone: what follows it (a time zone) stays
        code = F.coalesce(F.element_at(mapping, name), F.lit(JDBC["OTHER"]))
        return raw.select(
            F.col("catalog").cast("string"), F.col("schema_name").alias("schema"), F.col("table_name").alias("table"),
            F.col("ordinal").cast("int"), F.col("column_name").alias("column"), code.cast("int").alias("jdbc_type"),
            vt.alias("vendor_type"), (F.col("is_key") == 1).alias("is_key"),
            code.isin(*SUPPORTED_CODES).alias("supported"))

    def tables(self) -> DataFrame:
        cols = self.columns()
        return cols.select("catalog", "schema", "table").distinct().withColumn("path", F.lit(None).cast("string"))

    def schemas(self) -> DataFrame:
        return self.tables().select("catalog", "schema").distinct()

    def row_counts(self, tables: list[tuple[str, str]] | None = None) -> DataFrame | None:
        """Catalog row counts (SQL Server partition metadata, one query for all tables), optionally
        limited to ``tables``. Oracle keeps none, as the export tool did: returns None."""
        if self.flavor != "sqlserver":
            return None
        out = self._query(sqlserver_row_counts_sql(self.catalog)).select(
            F.lit(self.catalog).cast("string").alias("catalog"), F.col("schema_name").alias("schema"),
            F.col("table_name").alias("table"), F.col("row_count").cast("long"))
        if tables:
            want = local_df(self.spark, list(tables), "schema string, table string")
            out = out.join(want, ["schema", "table"], "left_semi")
        return out

    def _partitions_sql(self) -> str:
        if self.flavor not in ("oracle", "sqlserver"):
            raise NotImplementedError(f"no partition dictionary is known for {self.flavor}")
        return ORACLE_PARTITIONS_SQL if self.flavor == "oracle" else sqlserver_partitions_sql(self.catalog)

    def partitions(self) -> DataFrame:
        return self._query(self._partitions_sql())


class SparkCatalogSource:
    """Tables and views of the Spark session catalog (``spark.catalog``) as a source.

    Temporary views have no database; they are listed under ``temp_schema``."""

    def __init__(self, spark: SparkSession, database: str | None = None, *, temp_schema: str = "temp",
                 catalog: str | None = None, primary_keys: dict | None = None):
        self.spark, self.database, self.temp_schema, self.catalog = spark, database, temp_schema, catalog
        self.primary_keys = {k.lower(): list(v) for k, v in (primary_keys or {}).items()}

    def _scan(self) -> list[tuple]:
        out = []
        for t in self.spark.catalog.listTables(self.database):
            schema = self.temp_schema if t.isTemporary else (t.namespace[-1] if t.namespace else self.database)
            out.append((self.catalog, schema, t.name, None))
        return sorted(out, key=lambda r: (r[1], r[2]))

    def _name(self, schema: str, table: str) -> str:
        return f"`{table}`" if schema == self.temp_schema else f"`{schema}`.`{table}`"

    def schemas(self) -> DataFrame:
        return local_df(self.spark, sorted({(c, s) for c, s, _, _ in self._scan()}), "catalog string, schema string")

    def tables(self) -> DataFrame:
        return local_df(self.spark, self._scan(), TABLES_SCHEMA)

    def read(self, schema: str, table: str) -> DataFrame:
        return self.spark.table(self._name(schema, table))

    def columns(self, tables: list[tuple[str, str]] | None = None) -> DataFrame:
        rows = []
        want = None if tables is None else set(tables)
        for c, s, t, _ in self._scan():
            if want is not None and (s, t) not in want:
                continue
            keys = set(self.primary_keys.get(f"{s}.{t}".lower(), self.primary_keys.get(t.lower(), [])))
            for i, f in enumerate(self.read(s, t).schema.fields, start=1):
                code = jdbc_type_of(f.dataType)
                rows.append((c, s, t, i, f.name, code, f.dataType.simpleString(), f.name in keys,
                             is_supported_code(code)))
        return local_df(self.spark, rows, COLUMNS_SCHEMA)

    def row_counts(self, tables: list[tuple[str, str]] | None = None) -> DataFrame:
        todo = tables or [(s, t) for _, s, t, _ in self._scan()]
        parts = [self.read(s, t).agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit(self.catalog).cast("string").alias("catalog"), F.lit(s).alias("schema"),
                         F.lit(t).alias("table"), "row_count") for s, t in todo]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
