"""Content check: what was read from the source against what the written files hold.

Every row has a 64-bit hash of its values, taken by Spark on the way to the writer; a
file's ``content`` in the commit log is the sum of its rows' hashes modulo 2^64. A sum
does not depend on the order of rows and, unlike an exclusive or, counts repeated rows. The source
is read once, by the export itself. The check reads the committed files, takes the same
sums per file and reports, for each chunk, whether rows and contents agree.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, CharType, IntegerType, LongType, ShortType, VarcharType

FILE_COL = "_tx_file"
HASH_COL = "_tx_hash"


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """The hash of a row's values in column order, in the types the files give back.

    Integers count as 64-bit; a null is told from an absent value by its own flag."""
    parts = []
    for c in columns:
        col, t = F.col(f"`{c}`"), df.schema[c].dataType
        if isinstance(t, (ByteType, ShortType, IntegerType, LongType)):
            col = col.cast("long")
        elif isinstance(t, (CharType, VarcharType)):
            col = col.cast("string")
        parts += [col.isNull(), col]
    return F.xxhash64(*parts)


def hash_sum(h: Column) -> Column:
    """Sum of 64-bit hashes modulo 2^64, as decimal text: three sums of at most 22 bits a row can't overflow before 2^41 rows."""
    low = F.sum(h.bitwiseAND(F.lit(0x3FFFFF)))
    mid = F.sum(F.shiftrightunsigned(h, 22).bitwiseAND(F.lit(0x3FFFFF)))
    high = F.sum(F.shiftrightunsigned(h, 44))
    wide = lambda x, k: x.cast("decimal(20,0)") * F.lit(1 << k).cast("decimal(15,0)")
    return ((wide(low, 0) + wide(mid, 22) + wide(high, 44)) % F.lit("18446744073709551616").cast("decimal(20,0)")).cast("decimal(20,0)").cast("string")


def file_contents(spark: SparkSession, destination: str, table: tuple) -> DataFrame:
    """(name, read_rows, read_content) of every committed file of ``table`` (catalog, schema, table), as read back."""
    from ..sources.avro_sink import FORMAT, register

    register(spark)
    rows = (spark.read.format(FORMAT).option("of_table", json.dumps(list(table))).option("file_col", FILE_COL).load(destination))
    columns = [c for c in rows.columns if c != FILE_COL]
    return (rows.select(FILE_COL, row_hash(rows, columns).alias("h")).groupBy(F.col(FILE_COL).alias("name"))
            .agg(F.count(F.lit(1)).alias("read_rows"), hash_sum(F.col("h")).alias("read_content")))


def check_content(spark: SparkSession, destination: str, table: tuple) -> DataFrame:
    """One row per chunk of ``table`` that has files: chunk, rows (as written), read_rows, content_match.

    content_match is null for chunks with a file written without the check, false when a
    file is missing, cannot give all of its rows, or gives another value. A file that
    cannot be decoded at all fails the job. A table without files gives no rows."""
    from .stats import read_file_index

    files = read_file_index(spark, destination).where(
        F.col("catalog").eqNullSafe(F.lit(table[0])) & F.col("schema").eqNullSafe(F.lit(table[1])) & (F.col("table") == table[2]))
    if files.isEmpty():
        none = F.lit(0).cast("long")
        return files.select("chunk", "rows", none.alias("read_rows"), F.lit(True).alias("content_match")).limit(0)
    both = files.select("chunk", "name", "rows", "content").join(file_contents(spark, destination, table), "name", "left")
    same = F.coalesce((F.col("rows") == F.col("read_rows")) & (F.col("content") == F.col("read_content")), F.lit(False))
    return both.groupBy("chunk").agg(F.sum("rows").alias("rows"), F.sum(F.coalesce("read_rows", F.lit(0))).alias("read_rows"),
                                     F.when(F.count("content") == F.count(F.lit(1)), F.every(same)).alias("content_match"))
