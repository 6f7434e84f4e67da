"""The operators on the given tables: one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablexport.llm import bpe, counts, decontamination, gridjoin, licenses, lines, pii, prefixtrie, quality, simhash, spelling, toolcalls, urls
from tablexport.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# The rules for pages.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules, or else by trees trained on the URLs that the rules decide."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, plain and disguised, with source offsets."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", pii.spans(F.col("text")).alias("s")).select("doc_id", "s.*")


def op3_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as calls and results: linked, ordered, validated, as canonical JSON; turns of other roles beside them."""
    turns = table(spark, sf_dir, "conversations")
    return toolcalls.link(*toolcalls.as_calls(turns), toolcalls.ANSWER, toolcalls.other_turns(turns))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark, copied or edited."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components: 4-word shingles, links of up to 4 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), length=4, k=4)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what fuzzy line dedup leaves of it."""
    out = lines.dedup(table(spark, sf_dir, "documents"))
    n = lambda c: F.size(F.split(c, "\n", -1))
    return out.select("doc_id", n("text").alias("n_lines"), F.when(F.col("kept_text") == "", 0).otherwise(n("kept_text")).alias("n_kept"), "kept_text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the base and by rules learned from the labels."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token count before and after redaction, the second from the first."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", counts.after_edits(F.col("text"), VOCABULARY).alias("c")).select("doc_id", "c.*")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", bpe.digests(F.col("text"), VOCABULARY).alias("t")).select("doc_id", "t.*")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words, the form each is a variant of, and the root of the forms."""
    return spelling.group(spelling.vocabulary(table(spark, sf_dir, "documents"), least=7, times=2, noise=31), ratio=10)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of the conversations' prefixes with what sharing them saves."""
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"), every=100, heads=6)


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its links and component within its label."""
    return gridjoin.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


QUERIES = {f.__name__: f for f in (op1_url_filters, op2_pii, op3_tool_calls, op4_decontamination, op5_simhash, op6_line_dedup,
                                   op7_quality_rules, op8_token_counts, op9_license_scan, op10_byte_bpe,
                                   op11_spelling_variants, op12_prefix_trie, op13_embedding_dedup)}

_OP3 = """
WITH RECURSIVE c AS (SELECT conv_id, turn, min(text) AS text, count(*) AS n_calls FROM conversations WHERE role = 'user' GROUP BY ALL),
r AS (SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results FROM conversations WHERE role = 'assistant' GROUP BY ALL),
d AS (SELECT conv_id, turn, CAST(0 AS BIGINT) AS depth FROM c WHERE (conv_id, turn - 2) NOT IN (SELECT (conv_id, turn) FROM c)
      UNION ALL SELECT c.conv_id, c.turn, d.depth + 1 FROM c JOIN d ON c.conv_id = d.conv_id AND c.turn - 2 = d.turn),
j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv, coalesce(c.turn, r.turn) AS t, c.conv_id, depth, coalesce(c.turn, r.turn + 1) AS turn,
        CASE WHEN n_calls > 0 THEN 'answer' END AS name, CASE WHEN n_calls > 0 THEN c.conv_id || ':' || (c.turn - 2) END AS parent_id,
        coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
        CASE WHEN n_results IS NULL THEN 'no_result' WHEN n_calls IS NULL THEN 'orphan_result' ELSE 'linked' END AS linked,
        CASE WHEN n_calls > 0 THEN 'valid' END AS validity, text, content
      FROM c JOIN d ON c.conv_id = d.conv_id AND c.turn = d.turn FULL JOIN r ON c.conv_id = r.conv_id AND c.turn = r.turn)
SELECT conv_id, depth, turn, conv || ':' || t AS call_id, name, parent_id, n_calls, n_results, linked, validity,
  '{"arguments":' || CASE WHEN name IS NULL THEN 'null' ELSE CAST(to_json({'n_chars': length(text), 'prompt': text}) AS VARCHAR) END || ',' ||
  substr(CAST(to_json({'call_id': conv || ':' || t, 'depth': depth, 'linked': linked, 'name': name, 'result': content, 'validity': validity}) AS VARCHAR), 2) AS json
FROM j
UNION ALL SELECT conv_id, CAST(NULL AS BIGINT), turn, NULL, role, NULL, 0, 0, 'not_a_call', NULL, '{"arguments":null,"call_id":null,"depth":null,"linked":"not_a_call",' ||
  substr(CAST(to_json({'name': role, 'result': text, 'validity': CAST(NULL AS VARCHAR)}) AS VARCHAR), 2)
FROM conversations WHERE coalesce(role, '') NOT IN ('user', 'assistant')"""

ORACLE_SQL = {"op3_tool_calls": _OP3, "op9_license_scan": licenses.oracle_sql(),
              "op11_spelling_variants": spelling.oracle_sql(), "op12_prefix_trie": prefixtrie.oracle_sql(), "op13_embedding_dedup": gridjoin.oracle_sql()}
