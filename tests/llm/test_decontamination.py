import random

import pytest

from tablexport.llm import decontamination as d
from tests.llm import helpers


def plain_alignment(a, b):
    """Smith-Waterman cell by cell."""
    best, last = 0, [0] * (len(a) + 1)
    for w in b:
        row = [0]
        for i, x in enumerate(a, 1):
            row.append(max(0, last[i - 1] + (1 if x == w else -1), last[i] - 2, row[i - 1] - 2))
        best, last = max(best, *row), row
    return best


def test_alignment_against_every_cell():
    rnd = random.Random(10)
    for _ in range(400):
        a, b = ([rnd.choice("abcde") for _ in range(rnd.randrange(14))] for _ in range(2))
        assert d.smith_waterman(a, b)[0] == plain_alignment(a, b)


def test_word_hashes_do_not_depend_on_the_place_or_the_part(monkeypatch):
    rnd = random.Random(11)
    texts = ["".join(rnd.choice("ab é\n\t") for _ in range(rnd.randrange(80))).encode() for _ in range(200)]
    whole = [d.hash_words(t) for t in texts]
    names = {}
    for t, (starts, ends, h) in zip(texts, whole):
        assert [t[s:e] for s, e in zip(starts, ends)] == t.split()
        for w, x in zip(t.split(), h.tolist()):
            assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)
    monkeypatch.setattr(d, "MAX_PART", 7)
    for t, (starts, _, h) in zip(texts, whole):
        s2, _, h2 = d.hash_words(t)
        assert s2.tolist() == starts.tolist() and h2.tolist() == h.tolist()


def edited(rnd, words, n):
    words = list(words)
    for _ in range(n):
        i = rnd.randrange(len(words))
        kind = rnd.choice("sdi")
        if kind == "s":
            words[i] = f"new{rnd.randrange(999)}"
        elif kind == "d":
            del words[i]
        else:
            words.insert(i, f"more{rnd.randrange(999)}")
    return words


def test_planted_copies_against_all_pairs(spark):
    rnd = random.Random(12)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [[rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 8, 20, 41, 60]))] for _ in range(25)]
    texts = []
    for i in range(120):
        body = [rnd.choice(vocabulary) for _ in range(rnd.randrange(200))]
        for _ in range(rnd.randrange(3)):
            at, item = rnd.randrange(len(body) + 1), rnd.choice(items)
            body[at:at] = edited(rnd, item, rnd.randrange(max(1, len(item) // 8)))
        texts.append(rnd.choice([" ", "\n", "  "]).join(body).replace("w1 ", "W1 "))
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, item_id string, at int")
    bench = spark.createDataFrame([(i, " ".join(x), "y") for i, x in enumerate(items)], "item_id long, text string, doc_id string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in d.leaks(docs, bench).collect()}
    expected = {}
    for i, t in enumerate(texts):
        words = t.lower().split()
        for j, x in enumerate(items):
            score = plain_alignment(x, words)
            if score >= d.needed(len(x)) - 1e-9:
                expected[i, j] = score / len(x)
    assert len(expected) > 40 and got == pytest.approx(expected)
    left = d.clean(docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == sorted(set(range(120)) - {i for i, _ in expected})


def test_no_alignment_that_counts_breaks_all_seeds():
    rnd = random.Random(13)
    for _ in range(4000):
        item = [f"w{i}" for i in range(rnd.choice([*range(1, 25), 36, 60, 100]))]
        n, n_seeds = d.seeds_of(len(item))
        lost = rnd.randrange(len(item) // 4 + 1)
        step = rnd.choice([2, 3, 4, 5])
        text = [f"x{i}" if i % step == step - 1 and i // step < lost else w for i, w in enumerate(item)][rnd.randrange(3):len(item) - rnd.randrange(len(item) // 2 + 1)]
        if plain_alignment(item, text) >= d.needed(len(item)) - 1e-9:
            left = {tuple(text[i:i + n]) for i in range(len(text) - n + 1)}
            own = [tuple(item[i:i + n]) for i in range(len(item) - n + 1)]
            assert sum(g in left for g in own) > len(own) - n_seeds


def test_edited_copies_and_partial_quotations_are_found(spark):
    rnd = random.Random(14)
    items = [[f"v{rnd.randrange(3000)}" for _ in range(rnd.randrange(20, 60))] for _ in range(60)]
    texts, kinds = [], []
    for item in items:
        for share in (0.1, 0.15, 0.2):
            words = list(item)
            for i in rnd.sample(range(len(item)), int(share * len(item))):
                words[i] = f"new{rnd.randrange(9999)}"
            texts.append(words)
            kinds.append(share)
        third = len(item) // 3
        texts += [item[third:], item[:len(item) - third]]
        kinds += ["head cut", "tail cut"]
        texts.append([f"v{rnd.randrange(3000)}" for _ in range(120)] + item[:len(item) // 3])
        kinds.append("a third")
    around = lambda words: " ".join([f"v{rnd.randrange(3000)}" for _ in range(40)] + words + [f"v{rnd.randrange(3000)}" for _ in range(40)])
    docs = spark.createDataFrame([(i, around(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in d.leaks(docs, bench).collect()}
    found = {k: sum((i, i // 6) in got for i, kind in enumerate(kinds) if kind == k) / len(items) for k in set(kinds)}
    assert found.pop("a third") == 0 and min(found.values()) >= 0.9, found
    assert all(i // 6 == j for i, j in got)


def test_documents_against_all_pairs_with_a_shared_run(spark):
    import pyarrow.parquet as pq

    items = {r["item_id"]: d.words_of(r["text"]) for r in pq.read_table(f"{helpers.SF}/benchmark.parquet").to_pylist()}
    expected = set()
    for row in helpers.documents():
        words = d.words_of(row["text"])
        for i, x in items.items():
            if set(zip(x, x[1:], x[2:])) & set(zip(words, words[1:], words[2:])) and d.smith_waterman(x, words)[0] >= d.needed(len(x)) - 1e-9:
                expected.add((row["doc_id"], i))
    got = d.leaks(spark.read.parquet(f"{helpers.SF}/documents.parquet"), spark.read.parquet(f"{helpers.SF}/benchmark.parquet"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == expected and expected


def test_nulls_repeats_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (2, None), (3, ""), (4, "short item"), (5, "clean words here")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text.upper()), (3, text + " "), (8, None), (9, " "), (None, "x"), (5, "Short  item")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"], r["n_items"]) for r in d.leaks(docs, bench).collect()), key=repr)
    assert got == [(1, 3, 2), (4, 5, 1), (None, 3, 2)]
    assert sorted(r["doc_id"] for r in d.clean(docs, bench).collect()) == [2, 3, 5]
    assert d.leaks(docs, bench.limit(0)).count() == 0 and d.leaks(docs.limit(0), bench).count() == 0
    assert d.clean(docs, bench.limit(0)).count() == 7


def test_clean_with_names_that_clash_and_repeated_rows(spark):
    item = " ".join(f"word{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"see {item} there", 7, 8), (1, f"see {item} there", 7, 8), (2, "nothing", 7, 8), (None, None, 7, 8)], "doc_id long, text string, bad_id int, _bad_text int")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert sorted(map(tuple, d.clean(docs, items).collect()), key=str) == [(2, "nothing", 7, 8), (None, None, 7, 8)]
