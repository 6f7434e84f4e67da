import math
import re
import textwrap

import duckdb

from tablexport.llm import licenses
from tests.llm import helpers


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text):
    w = words(text)
    places = sorted((i, label) for p, label in licenses.PHRASES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    base = {label for _, label in places}
    added, best = set(), 0.0
    for label, t in licenses.TEMPLATES:
        of, run = set(words(t)), math.ceil(licenses.SLACK * len(words(t)))
        for i in range(len(w)):
            have = of & set(w[i:i + run])
            if len(have) >= licenses.THRESHOLD * len(of) - 1e-9 and have >= of & set(licenses.DISTINCTIVE):
                added.add(label)
                best = max(best, len(have) / len(of))
    return (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted(base)), ",".join(sorted(base | added)), best)


ODD = [None, "", "\n\n", "MIT LICENSE mit-license; the Apache  License", "mit\nlicense", "License", "éMIT license É general public licenses general public\tlicense",
       "\u212aIT license", "mit license" * 3, "Released under license MIT\nother", "permission is hereby granted", "Licensed under CC BY-NC 4.0", "x\x00mit\x00license",
       "This program is free software you can redistribute it and or modify it under the terms of the GNU General Public as published by the Free Software Foundation",
       *[t for _, t in licenses.TEMPLATES], *[" ".join(t.split()[::-1][:-1]) for _, t in licenses.TEMPLATES]]

ODD += ["some prose before\n" + "\n".join(" * " + x for x in textwrap.wrap(t, 30)) + "\nand after" for _, t in licenses.TEMPLATES]
ODD += [" the of and ".join(t.split()) for _, t in licenses.TEMPLATES]


def test_wrapped_notices_are_found_and_no_other_license(spark):
    wrapped = [("\n".join("# " + x for x in textwrap.wrap(t, 72)), label) for label, t in licenses.TEMPLATES if len(t) > 100 and label in ("mit", "gpl", "bsd")]
    others = [("Released under the Apache License, Version 2.0", "apache"), ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ""),
              ("Licensed under CC BY 4.0.", ""), ("The committee released a report under review; the license of one member, Mr Mit, was mentioned later in it", "")]
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(helpers.odd_documents(spark, [t for t, _ in wrapped + others], [])).collect()}
    assert [found[i] for i in range(len(found))] == [label for _, label in wrapped + others]


def test_odd_texts_and_repeats_against_plain_python(spark):
    docs = helpers.odd_documents(spark, ODD + ["mit license"] * 2, ["text_hash", "label", "w"])
    docs = docs.unionByName(docs.where("doc_id = 3").withColumn("doc_id", docs["doc_id"] * 0 + None if False else docs["doc_id"]))
    out = licenses.scan(docs).collect()
    assert len(out) == len(ODD) + 3
    for r in out:
        text = (ODD + ["mit license"] * 2)[r["doc_id"]]
        assert tuple(r)[1:] == plain(text), text
    assert licenses.scan(docs.limit(0)).count() == 0
    assert {r["labels"] for r in licenses.scan(docs, templates=()).collect()} == {plain(t)[4] for t in ODD}


def test_documents_against_plain_python_and_sql(spark):
    docs = spark.read.parquet(f"{helpers.SF}/documents.parquet")
    out = {r["doc_id"]: tuple(r) for r in licenses.scan(docs).collect()}
    for d in helpers.documents():
        assert out[d["doc_id"]][1:] == plain(d["text"])
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{helpers.SF}/documents.parquet'")
    assert sorted(con.execute(licenses.oracle_sql()).fetchall()) == sorted(out.values())
