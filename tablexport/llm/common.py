"""Helpers shared by the operators: tables, frames cut from their lineage, free names, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablexport.session import checkpoint_dir, ship_package

EDGES = 50_000  # links to a partition while components are found
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder as the cluster names it, and the package on the executors' path."""
    checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and go on from the files.

    They outlive lost executors, and the shuffle files of the job that wrote them are
    removed when it ends. ``forget`` deletes the files once nothing reads them any more."""
    spark = df.sparkSession
    path = scratch(spark, "cut")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the files of frames that ``cut`` wrote; no frame that reads them may be used again."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._cut_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by distributed union-find (alternating large and small stars).

    ``edges`` has one row per link; nulls and self-links are ignored, repeats
    and direction don't matter. Returns (node, component): every linked node
    once, with the smallest node it can reach. No edges: no rows. Each round is
    two aggregations and two joins over what is left, and is written to the shared folder; a
    hub's minimum is combined before the shuffle."""
    e = (edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
         .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e, seen = cut(e), None
    while True:
        state = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        few = state[0] // EDGES + 1  # what is left in as few files as it takes
        before, e = e, e.coalesce(few)
        # large star: the larger neighbours of a node link to the smallest node around it
        low = e.select(F.col("u").alias("n"), F.col("v").alias("m")).union(e.select(F.col("v").alias("n"), F.col("v").alias("m")))
        low = low.groupBy("n").agg(F.min("m").alias("m"))
        large = e.join(low, e.v == low.n).select("u", F.col("m").alias("v")).distinct()
        # small star: a node's smaller neighbours link to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "n")
        moved = large.join(least, large.u == least.n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(moved.union(least.select("n", "m")).distinct().coalesce(few))
        forget(before)
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; nothing is made there yet."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
