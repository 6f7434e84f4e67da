import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tablexport.llm import pii
from tests.llm import helpers


def plain(text):
    """The base patterns as they are written, with re alone."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        luhn = sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and luhn % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.findall("[0-9]", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_random_texts_against_the_patterns():
    rnd = random.Random(5)
    for letters in ("ab.@-_ 1", "0123456789. ", "1 -0+()", "a@.-b%+ é1"):
        for _ in range(2_500):
            text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(60)))
            assert pii.detect(text) == plain(text), text


def test_long_runs_take_one_pass():
    text = "a" * 300_000 + " " + "1" * 300_000 + " " + "1." * 100_000 + "+" * 100_000 + "+1" + " " * 100_000
    assert pii.detect(text) == [x for x in pii.detect(text)] and pii.detect("x" * 200_000 + "@b.c") == [(0, 0, 200_004)]


@pytest.mark.parametrize("text, kind, source", [
    ("write to jane.doe [at] mail (dot) example [dot] org now", "email", "jane.doe [at] mail (dot) example [dot] org"),
    ("write to bob at example dot com now", "email", "bob at example dot com"),
    ("mail: jаne@exаmple.com!", "email", "jаne@exаmple.com"),  # Cyrillic a
    ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("ip １９２.168.0.1 here", "ip", "１９２.168.0.1"),
    ("call plus one five five five one two three four five six seven today", "phone", "plus one five five five one two three four five six seven"),
    ("j​oe@exa­mple.com", "email", "j​oe@exa­mple.com"),
])
def test_disguises_map_back_to_the_source(text, kind, source):
    base = pii.detect(text)
    found = [(pii.KINDS[k], text[s:e]) for s, k, e in pii.disguised(text, base)]
    assert (kind, source) in found or (kind, source) in [(pii.KINDS[k], text[s:e]) for s, k, e in base]
    assert (kind, source) in found


@pytest.mark.parametrize("text", ["we met at the dot of noon", "one two three four", "at [home]", "[1.] first (2.) second", "Привет, мир", "a at b"])
def test_clean_texts_stay_clean(text):
    assert pii.scan(text)[5] == ""


def test_base_spans_stay(spark):
    rows = [(d["doc_id"], d["text"]) for d in helpers.documents()] + [(None, None), (-1, ""), (-1, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    out = df.select("doc_id", pii.spans(F.col("text")).alias("s")).select("doc_id", "s.*").collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    for i, text in rows:
        base, r = plain(text or ""), by_id[i]
        written = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in base) for i in range(4)]
        assert set(written) <= set(r["spans"].split(",")) | {""} and len(r["spans"].split(",")) * bool(r["spans"]) == len(base) + r["n_added"]
