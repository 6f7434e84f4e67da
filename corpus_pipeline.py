"""A training-data pipeline over ``documents``: five of the llm operators, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablexport.llm import bpe, decontamination, lines, quality, simhash
from tablexport.llm.common import prepare, scratch, table
from tablexport.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor the rules learned from the labels reject."""
    prepare(spark)
    return quality.keep(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line, equal or nearly so, replaces."""
    prepare(spark)
    return lines.keep_first(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each SimHash component."""
    prepare(spark)
    return simhash.keep_first(docs, length=4, k=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document left, and what they decode to, as digests."""
    prepare(spark)
    return docs.select("doc_id", bpe.digests(F.col("text"), VOCABULARY).alias("t")).select("doc_id", "t.*")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("simhash", simhash_dedup), ("decontamination", decontaminate), ("byte_bpe", byte_bpe)]

#: Learned rules, fingerprints and alignments are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what one kept is written as Parquet to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
