import random
import re

import numpy as np
from pyspark.sql import functions as F

from tablexport.llm import quality
from tests.llm import helpers


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_statistics_against_plain_python():
    rnd = random.Random(6)
    for _ in range(400):
        text = "".join(rnd.choice(["a", "b", "é", " ", " ", "\n", "\t", "\x0b", "\x1f", "\xa0", "#", "&"]) for _ in range(rnd.randrange(60)))
        assert quality.measure(text)[:5] == plain(text), repr(text)
    for d in helpers.documents(60):
        assert quality.measure(d["text"])[:5] == plain(d["text"])
    assert quality.measure(None) == quality.measure("") and quality.measure(None)[0] == 0


def test_a_list_is_learned_and_holds_on_other_rows():
    rng = np.random.default_rng(1)
    x = rng.random((4_000, len(quality.FEATURES)))
    names = list(quality.FEATURES)
    bad = (x[:, 2] > 0.8) | ((x[:, 3] > 0.7) & (x[:, 1] <= 0.4))
    rules = quality.cover(x[:2_000], bad[:2_000], names)
    said = np.zeros(2_000, bool)
    for r in rules:
        said |= r.fits(x[2_000:], names)
    assert (said == bad[2_000:]).mean() > 0.97


def test_nothing_to_learn_from_rejects_nothing(spark):
    assert quality.cover(np.zeros((0, 8)), np.zeros(0, bool), list(quality.FEATURES)) == []
    assert quality.cover(np.ones((9, 8)), np.ones(9, bool), list(quality.FEATURES)) == []
    docs = helpers.odd_documents(spark, ["a b " * 60, None, ""])
    assert quality.learn(docs, spark.createDataFrame([], "doc_id long, quality int")) == []
    assert quality.learn(docs, spark.createDataFrame([(0, 1), (None, 0), (1, None)], "doc_id long, quality int")) == []


def test_judge_and_keep_agree_with_the_rules_row_by_row(spark):
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet")
    labels = spark.read.parquet(f"{helpers.SF}/labels.parquet")
    rules = quality.learn(docs, labels)
    assert rules
    names = list(quality.FEATURES)
    out = {r["doc_id"]: r for r in quality.judge(docs, rules).collect()}
    for d in helpers.documents():
        n, chars, symbols, dup, repeat, lines, distinct, digits, upper = quality.measure(d["text"])
        x = np.array([[n, chars / max(n, 1), symbols / max(n, 1), dup / max(lines, 1), repeat / max(n, 1), distinct / max(n, 1), digits / max(chars, 1), upper / max(chars, 1)]])
        first = next((i for i, r in enumerate(rules, 1) if r.fits(x, names)[0]), None)
        failed = n < 50 or 100 * repeat > 50 * n
        r = out[d["doc_id"]]
        assert (r["base_failed"], r["rule"], r["kept"]) == (failed, first, not failed and first is None)
    kept = {r["doc_id"] for r in quality.keep(docs, rules).collect()}
    assert kept == {i for i, r in out.items() if r["kept"]}
    # good labelled documents that the base lets through stay
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    through = [i for i in good if not out[i]["base_failed"]]
    assert np.mean([out[i]["kept"] for i in through]) > 0.97


def test_odd_rows_and_clashing_columns(spark):
    docs = helpers.odd_documents(spark, [None, "", "w " * 49, " ".join(map(str, range(60))), " ".join(map(str, range(60)))], ["_statistics", "n_words", "s"])
    out = quality.keep(docs, [])
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [3, 4]
    judged = {r["doc_id"]: r for r in quality.judge(docs, []).collect()}
    assert judged[0]["n_words"] == 0 and judged[0]["base_failed"] and judged[2]["base_failed"] and not judged[3]["base_failed"]
    assert quality.keep(docs.limit(0), []).count() == 0
    assert docs.select(quality.statistics(F.col("text"))).count() == 5
