import random
import re

import pytest
import xxhash

from tablexport.llm import simhash
from tests.llm import helpers


def plain(text, length=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [words[i:i + length] for i in range(len(words) - length + 1)] or [words]
    h = [xxhash.xxh64_intdigest(" ".join(p).encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_against_plain_python():
    for text in [None, "", " \n", "One", "A b C", "a b c d", "İx É\xa0y a b c d e", "w " * 5_000] + [d["text"] for d in helpers.documents(40)]:
        assert simhash.fingerprint(text) == plain(text)


def test_spark_hash_is_the_same(spark):
    assert spark.sql("select xxhash64('a b c d')").first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


@pytest.mark.parametrize("n", [10, 10_000, 2_000_000, 10**9, 10**12])
def test_masks_miss_no_pair_within_four_bits(n):
    keys = simhash.masks(n, 4)
    rnd = random.Random(n)
    for _ in range(300):
        x = rnd.getrandbits(64)
        y = x
        for b in rnd.sample(range(64), 4):
            y ^= 1 << b
        assert any(x & m == y & m for m in keys)


def test_links_of_dense_and_chained_fingerprints(spark):
    rnd = random.Random(8)
    centre = rnd.getrandbits(64)
    near = {centre} | {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(1, 4))) for _ in range(150)}
    chain = [rnd.getrandbits(64)]
    for _ in range(30):
        chain.append(chain[-1] ^ sum(1 << b for b in rnd.sample(range(64), 4)))
    fps = sorted(near | set(chain) | {rnd.getrandbits(64) for _ in range(100)} | {0, 1, (1 << 64) - 1})
    signed = {x: x - (1 << 64) if x >> 63 else x for x in fps}
    edges = simhash.link(spark.createDataFrame([(signed[x],) for x in fps], "fp long"), 4).collect()
    linked = {frozenset((e["a"], e["b"])) for e in edges}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in map(tuple, linked))
    by_edges = helpers.components(fps, lambda a, b: frozenset((signed[a], signed[b])) in linked)
    assert by_edges == helpers.components(fps, lambda a, b: (a ^ b).bit_count() <= 4)


def test_documents_against_all_pairs(spark):
    docs = helpers.documents()
    rows = [(d["doc_id"], d["text"]) for d in docs] + [(10_000 + d["doc_id"], d["text"]) for d in docs[:5]] + [(-5, None), (-4, ""), (None, docs[3]["text"]), (7, docs[7]["text"])]
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, fp string, component long")
    out = simhash.near_duplicates(df).collect()
    assert len(out) == len(rows)
    fp = {i: plain(t) for i, t in rows if i is not None}
    expected = helpers.components(sorted(fp), lambda a, b: (fp[a] ^ fp[b]).bit_count() <= 4)
    for r in out:
        if r["doc_id"] is not None:
            assert (int(r["fingerprint"], 16), r["component_id"]) == (fp[r["doc_id"]], expected[r["doc_id"]])
        else:
            assert r["component_id"] == expected[docs[3]["doc_id"]]
    assert all(len(r["fingerprint"]) == 16 for r in out)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted(i for i, _ in rows if i is not None and expected[i] == i)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
