import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tablexport.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long"


def edits(a, b):
    """Exactly one inserted, deleted or replaced code point apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_vocabulary(docs, least=7, times=2, noise=31):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= times}


def plain_groups(words, ratio=10):
    near = {w: [v for v in words if edits(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def rows(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def varied(rnd, word, letters):
    for _ in range(rnd.randrange(3)):
        i = rnd.randrange(len(word))
        word = rnd.choice([word[:i] + word[i + 1:], word[:i] + rnd.choice(letters) + word[i:], word[:i] + rnd.choice(letters) + word[i + 1:]])
    return word


@pytest.mark.parametrize("hot", [64, 1])  # with 1, the words of almost every reduced word are told apart by deletions too
def test_against_all_pairs(spark, monkeypatch, hot):
    monkeypatch.setattr(spelling, "HOT", hot)
    rnd = random.Random(hot)
    letters = "abcéß÷A"
    bases = ["".join(rnd.choice(letters) for _ in range(rnd.choice([7, 8, 12, 40]))) for _ in range(20)]
    docs = [(i, rnd.choice([" ", "_", "1\n"]).join(varied(rnd, rnd.choice(bases[:rnd.choice([2, 20])]), letters) for _ in range(rnd.randrange(60)))) for i in range(120)]
    docs += [(None, bases[0] + " " + bases[0]), (500, None), (501, ""), (502, "Z" * 3000 + " " + "Z" * 2999), (502, "Z" * 3000 + " " + "Z" * 2999)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], SCHEMA)
    words = spelling.vocabulary(df)
    expected = plain_vocabulary(docs)
    assert {r["word"]: r["n"] for r in words.collect()} == expected
    got = rows(spelling.group(words))
    assert len(got) == len(expected) and set(got) == plain_groups(expected)
    assert any(r[1] for r in got) and any(r[4] for r in got)


def test_chains_of_forms_and_ties(spark):
    words = {"aaaaaaa": 1, "aaaaaab": 10, "aaaaabb": 100, "aaaabbb": 1000, "aaabbbb": 9999, "zzzzzzz": 5, "zzzzzzy": 50, "zzzzzzx": 50}
    got = rows(spelling.group(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert set(got) == plain_groups(words)
    by = {r[0]: r for r in got}
    assert by["aaaaaaa"][2] == "aaaabbb" and by["aaaabbb"][1] is None and by["zzzzzzz"][1] == "zzzzzzx"


def test_no_words_and_one(spark):
    docs = spark.createDataFrame([(1, "short words only", "x", 1), (2, None, "x", 1)], SCHEMA)
    assert rows(spelling.group(spelling.vocabulary(docs))) == [] == rows(spelling.group(spelling.vocabulary(docs.limit(0))))
    assert rows(spelling.group(spark.createDataFrame([("allalone", 3)], "word string, n long"))) == [("allalone", None, "allalone", 3, 0, None)]


def test_neighbourhoods_are_full_and_hold_each_key_once():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcxyzäö") for _ in range(rnd.randrange(7, 12))) for _ in range(50)]
    other = [w[:i] + c + w[j:] for w in words for i in range(len(w) + 1) for c, j in (("", i + 1), ("q", i + 1), ("q", i))]
    owner = [w for w in words for i in range(len(w) + 1) for _ in range(3)]
    keys = dict(zip(other, spelling.reduced_keys(other).tolist()))
    found = {w: set() for w in words}
    for row, key in spelling.neighbours(words):
        pairs = list(zip(row.tolist(), key.tolist()))
        assert len(pairs) == len(set(pairs))
        for r, k in pairs:
            found[words[r]].add(k)
    assert all(keys[v] in found[w] for w, v in zip(owner, other))
    assert all(len(found[w]) <= 2 * spelling.SYMBOLS * (len(w) + 1) for w in words)


def test_long_words_cost_in_proportion_to_their_letters():
    words = ["ab" * 400_000]
    sizes = [len(row) for row, _ in spelling.neighbours(words, lambda k: np.zeros(k.shape, bool))]
    assert sizes == [1]
