"""License scans: an exact set-similarity join of text blocks and templates, in DataFrame functions alone.

Blocks are all runs of words of a text, line breaks or not, that are up to
SLACK times as long as the template: a notice may be wrapped, indented or interspersed.
Words are ordered by how many texts of the corpus have them, rarest
first. A block that holds THRESHOLD or more of a template's words lies in a text that holds one of
its ``|T| - ceil(THRESHOLD |T|) + 1`` rarest words (prefix filter), has enough words at all
(length filter), and enough of them from the first shared word on (positional
filter); of the texts that are left every block that begins with one of the template's words
is verified. A template's distinctive words must be among those that are found.
Templates are a parameter of bounded size; blocks are never paired with each other.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
SLACK = 1.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public license notices, by label.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
            "distribute, sublicense, and/or sell copies of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
            "as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)

# Words that tell one license from another; a template that has one isn't met without it.
DISTINCTIVE = ("apache", "gnu", "mit", "nc", "sharealike")


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased: runs of a-z, 0-9 and whatever isn't ASCII."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), NOT_WORD), lambda w: w != "")


def _template_words(text: str) -> list:
    return list(dict.fromkeys(w for w in re.split(NOT_WORD, text.lower()) if w))


def _array(values: list, kind: str = "string") -> Column:
    return F.array(*map(F.lit, values)).cast(f"array<{kind}>")


def _sets(templates, threshold: float) -> list:
    """(label, distinct words, words that must be there, words that must be shared, words of a block) of each template."""
    out = []
    for label, text in templates:
        if t := _template_words(text):
            run = math.ceil(SLACK * sum(1 for w in re.split(NOT_WORD, text.lower()) if w))
            out.append((label, t, [w for w in t if w in DISTINCTIVE], math.ceil(threshold * len(t) - 1e-9), run))
    return out


def _best_block(w: str) -> tuple:
    """Columns hits, runs and best: the most of ``words`` that a run of ``run`` words of the text holds, among runs with all of ``must``; else null.

    Runs that begin with one of ``words`` suffice: any other holds no more than the next of them."""
    hits = F.filter(F.transform(w, lambda x, i: F.struct(i.alias("at"), x.alias("w"))), lambda x: F.array_contains("words", x["w"]))
    runs = F.transform("hits", lambda x, i: F.array_distinct(F.transform(
        F.filter(F.slice("hits", i + 1, F.col("run")), lambda y: y["at"] < x["at"] + F.col("run")), lambda y: y["w"])))
    full = F.filter("runs", lambda r: F.size(F.array_except("must", r)) == 0)
    return hits, runs, F.array_max(F.transform(full, lambda r: F.size(r)))


def matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_hash, label, score: each document's best containment of a template of the label, ``threshold`` or more.

    Null and empty texts hold no block; null ids are carried; equal rows give one row."""
    sets = _sets(templates, threshold)
    spark = docs.sparkSession
    empty = spark.createDataFrame([], docs.select("doc_id").schema).select("doc_id", F.lit(0).cast("long").alias("text_hash"), F.lit("").alias("label"), F.lit(0.0).alias("score"))
    if not sets:
        return empty
    vocabulary = sorted({w for _, t, *_ in sets for w in t})
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w")).where("size(w) > 0")
    counted = (texts.select(F.explode(F.array_intersect("w", _array(vocabulary))).alias("x")).groupBy("x").agg(F.count("*").alias("n")))
    n_texts = {r["x"]: r["n"] for r in counted.collect()}  # one row for each word of the templates at most
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (n_texts.get(w, 0), w)))}
    by_rank = sorted(vocabulary, key=order.get)
    rows = []
    for label, t, must, need, run in sets:
        t = sorted(t, key=order.get)
        rows += [(w, label, i, len(t), need, run, t, must) for i, w in enumerate(t[:len(t) - need + 1])]
    prefixes = spark.createDataFrame(rows, "first string, label string, place int, n int, need int, run int, words array<string>, must array<string>")
    first_words = sorted({r[0] for r in rows}, key=order.get)
    # the rarest words select the texts; what a text shares with the templates is put in the global order
    near = (texts.where(F.arrays_overlap("w", _array(first_words)))
            .withColumn("shared", F.array_intersect(_array(by_rank), F.col("w"))))
    joined = (near.select("*", F.explode(F.array_intersect("shared", _array(first_words))).alias("first"))
              .join(F.broadcast(prefixes), "first"))  # as many rows as the templates have words, at most
    after = F.size("shared") - F.array_position("shared", F.col("first")) + 1
    common = F.array_intersect("words", "shared")
    kept = joined.where((F.size("w") >= F.col("need")) & (F.least(F.col("n") - F.col("place"), after) >= F.col("need") - F.col("place"))
                        & (F.get(common, F.lit(0)) == F.col("first"))  # each template once, by the rarest word shared
                        & (F.size(common) >= F.col("need")) & (F.size(F.array_except("must", common)) == 0))
    hits, runs, best = _best_block("w")
    return (kept.withColumn("hits", hits).withColumn("runs", runs).withColumn("best", best).where("best >= need")
            .groupBy("doc_id", "text_hash", "label").agg(F.max(F.col("best") / F.col("n")).alias("score")))


def scan(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places where a phrase's words follow each other,
    first_word and last_word are the smallest and largest of them. ``labels``
    adds those of the templates, score is the best containment (0 where none
    reaches the threshold). Null and empty texts have no words and no labels;
    null ids and repeated rows each get their row. Other columns are not read."""
    lists = [(p.split(" "), label) for p, label in PHRASES]
    own = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.coalesce("text", F.lit(""))).alias("w"))
    nothing = _array([], "struct<at:int,label:string>")

    def here(i, phrase):
        out = F.get("w", i) == phrase[0]
        for k, word in enumerate(phrase[1:], 1):
            out = out & (F.get("w", i + k) == word)
        return out

    def label_at(i):
        out = F.lit(None).cast("string")
        for phrase, label in reversed(lists):
            out = F.when(here(i, phrase), label).otherwise(out)
        return out

    found = F.when(F.array_contains("w", "license"), F.filter(
        F.transform(F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: F.get("w", i).isin([p[0] for p, _ in lists])),
                    lambda i: F.struct(i.alias("at"), label_at(i).alias("label"))), lambda x: x["label"].isNotNull())).otherwise(nothing)
    base = own.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"), found.alias("places")).select(
        "doc_id", "text_hash", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").cast("long").alias("first_word"), F.array_max("places.at").cast("long").alias("last_word"),
        F.array_sort(F.array_distinct("places.label")).alias("own"))
    more = (matches(docs, templates, threshold).groupBy("doc_id", "text_hash")
            .agg(F.collect_set("label").alias("added"), F.max("score").alias("score"))
            .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "added", "score"))
    both = base.join(more, base["doc_id"].eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    added = F.coalesce("added", _array([]))
    return both.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("own", ",").alias("base_labels"),
                       F.array_join(F.array_sort(F.array_distinct(F.concat("own", added))), ",").alias("labels"),
                       F.coalesce("score", F.lit(0.0)).alias("score"))


def oracle_sql(templates=TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same in DuckDB's SQL: each text that has enough of a template's words at all, run by run."""
    low = "string_split_regex(translate({}, '%s', '%s'), '%s')" % (UPPER, LOWER, NOT_WORD)
    cut = "list_filter(" + low + ", lambda w: w <> '')"
    values = ", ".join(f"('{label}', {t!r}, CAST({must!r} AS VARCHAR[]), {need}, {run})" for label, t, must, need, run in _sets(templates, threshold))
    cases = " ".join("WHEN " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(p.split(" "), 1)) + f" THEN '{label}'" for p, label in PHRASES)
    return f"""
WITH d AS (SELECT doc_id, {cut.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, len(w) AS n_words, list_filter(list_transform(range(0, len(w)), lambda i: {{'at': i, 'label': CASE {cases} END}}),
      lambda x: x.label IS NOT NULL) AS places FROM d),
s AS (SELECT * FROM (VALUES {values}) v(label, words, must, need, run)),
c AS (SELECT d.*, s.* FROM d, s WHERE len(list_intersect(w, words)) >= need),
r AS (SELECT doc_id, label, words, must, need, unnest(list_transform(list_filter(range(1, len(w) + 1), lambda i: list_contains(words, w[i])),
      lambda i: list_intersect(words, w[i:i + run - 1]))) AS found FROM c),
m AS (SELECT doc_id, label, max(len(found) / len(words)) AS score FROM r WHERE len(found) >= need AND list_has_all(found, must) GROUP BY ALL),
g AS (SELECT doc_id, list(DISTINCT label) AS added, max(score) AS score FROM m GROUP BY ALL)
SELECT p.doc_id, n_words, CAST(len(places) AS BIGINT) AS n_base, list_min(list_transform(places, lambda x: x.at)) AS first_word,
  list_max(list_transform(places, lambda x: x.at)) AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(places, lambda x: x.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(places, lambda x: x.label), coalesce(added, [])))), ',') AS labels,
  coalesce(score, 0.0) AS score
FROM p LEFT JOIN g USING (doc_id)"""
