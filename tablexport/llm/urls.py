"""URL filters: allow and block rules, and gradient-boosted trees for what no rule covers.

Features are lexical and made by Spark expressions; the trees are Spark ML's,
trained from labelled URLs on a bounded sample. Judging is one projection
(and a join with the statistics of the suffixes), whatever the number of URLs.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablexport.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Labelled URLs that the trees are trained on at most (those of smallest hash).
MAX_LABELLED = 20_000
FEATURES = ("length", "host_length", "depth", "digit_ratio", "entropy", "n_parameters", "n_labels", "n_hyphens", "suffix_count", "suffix_block_rate")


def host(url: Column) -> Column:
    """From after the first :// to the first of / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """From the end of the host to the first of ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _split(rule: str) -> tuple:
    at = rule.find("/")
    return (rule, "") if at < 0 else (rule[:at], rule[at:])


def matched(rules: list, h: Column, p: Column) -> Column:
    """The longest of the rules (host and path, verdict) that fits, as struct<rule, verdict>; null if none does.

    ``rules`` is a list of bounded size: it becomes one conditional expression."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda x: (len(x[0]), x[0])):
        on_host, on_path = _split(rule)
        fits = ((h == on_host) | h.endswith("." + on_host)) & p.startswith(on_path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def suffix(h: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(h, ".", -2)


def _lexical(df: DataFrame) -> DataFrame:
    """The features that a URL has by itself; the columns url, host, path must be there (null urls count as empty)."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    chars = F.array_distinct(F.split(url, ""))
    share = F.transform(chars, lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)
    entropy = F.aggregate(F.filter(share, lambda x: x > 0), F.lit(0.0), lambda a, x: a - x * F.log2(x))
    count = lambda c, of: (F.length(of) - F.length(F.replace(of, F.lit(c), F.lit("")))).cast("double")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return df.withColumns({
        "length": F.length(url).cast("double"), "host_length": F.length("host").cast("double"), "depth": count("/", F.col("path")),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / n, "entropy": entropy,
        "n_parameters": F.when(query == "", 0.0).otherwise(count("&", query) + 1),
        "n_labels": count(".", F.col("host")) + 1, "n_hyphens": count("-", F.col("host")),
    })


def judge(pages: DataFrame, rules: list, labelled: DataFrame | None = None, max_labelled: int = MAX_LABELLED, trees: int = 20, depth: int = 4) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict (allow or block), p_block.

    ``labelled`` (url, blocked: 0 or 1) trains the trees; without it the URLs that
    the rules decide are the labels. Where a rule fits it decides; else the trees
    do (p_block over one half blocks; null p_block where a rule decided). Null urls, and those without ://, have an
    empty host and path and are judged by the trees like any other. Without labels of both kinds nothing can be
    learned: what no rule covers is then allowed, or blocked if every label says so. Repeated rows and null ids
    each get their row; other columns are not read."""
    base = pages.select("page_id", "url").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    base = base.withColumn("m", matched(rules, F.col("host"), F.col("path")))
    if labelled is None:
        known = base.where("m is not null").select("url", "host", "path", (F.col("m.verdict") == "block").cast("double").alias("blocked"))
    else:
        known = labelled.where("blocked is not null").select("url", F.col("blocked").cast("double").alias("blocked"))
        known = known.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    # a bounded sample, put in one order so that the trees come out the same each time
    sample = cut(known.orderBy(F.xxhash64("url", "blocked"), "url", "blocked").limit(max_labelled))
    counts = base.groupBy(suffix(F.col("host")).alias("suffix")).agg(F.count("*").alias("n"))
    blocked = sample.groupBy(suffix(F.col("host")).alias("suffix")).agg(F.sum("blocked").alias("b"), F.count("*").alias("k"))
    classes = {r["blocked"]: r["count"] for r in sample.groupBy("blocked").count().collect()}
    total = sum(classes.values())
    prior = classes.get(1.0, 0) / total if total else 0.0
    stats = cut(counts.join(blocked, "suffix", "left").select(
        "suffix", F.log1p("n").alias("suffix_count"), ((F.coalesce("b", F.lit(0.0)) + prior) / (F.coalesce("k", F.lit(0)) + 1)).alias("suffix_block_rate")))

    def features(df: DataFrame) -> DataFrame:
        return (_lexical(df).withColumn("suffix", suffix(F.col("host"))).join(stats, "suffix", "left")
                .na.fill({"suffix_count": 0.0, "suffix_block_rate": prior}))

    if len(classes) < 2:
        p = F.lit(prior)
        scored = base.withColumn("p_block", p)
    else:
        assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        rows = assemble.transform(features(sample)).select("features", "blocked", "url").coalesce(1).sortWithinPartitions("url", "blocked")
        model = GBTClassifier(labelCol="blocked", featuresCol="features", maxIter=trees, maxDepth=depth, maxBins=64, seed=7).fit(rows)
        out = model.transform(assemble.transform(features(base)))
        scored = out.withColumn("p_block", vector_to_array("probability")[1])
    verdict = F.coalesce("m.verdict", F.when(F.col("p_block") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("m.rule").alias("rule"), verdict.alias("verdict"),
                         F.when(F.col("m").isNull(), F.col("p_block")).alias("p_block"))
