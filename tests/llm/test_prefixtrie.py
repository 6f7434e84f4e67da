import hashlib
import random
import zlib

import pytest

from tablexport.llm import prefixtrie

SCHEMA = "conv_id long, turn int, role string, text string, name string, depth int"


def plain(rows, every=100, heads=6):
    """Every node by comparing lists of turns."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    seqs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % every if c >= 0 else -(abs(c) % every))
        seqs[c] = tuple(own.get(base, [])[:h] + t[h:])
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in nodes}, {p: 0 for p in nodes}
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(seqs[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    df = prefixtrie.conversation_trie(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations_against_lists(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for c in [*rnd.sample(range(400), 40), 100, 200, -5, -100, None]:
        for t in range(rnd.choice([1, 2, 5, 9, 17, 33])):
            rows.append((c, None if rnd.random() < 0.05 else rnd.choice([t, t, t, t // 2]), rnd.choice(["u", "a", None]), rnd.choice(["x", "yé", None, ""])))
    rows += rows[:5]  # repeated rows are turns
    assert got(spark, rows) == plain(rows)


def test_one_long_conversation_copies_and_a_hot_end(spark):
    rows = [(7, t, "u", f"t{t}") for t in range(300)]
    rows += [(1000 + 100 * i, t, "u", f"same {t}") for i in range(150) for t in range(3)]  # multiples of 100: heads are their own
    assert got(spark, rows) == plain(rows)


def test_turnless_and_empty(spark, monkeypatch):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)  # loses its only turn; conversation 100 isn't there
    assert got(spark, [(c, 0, "u", "gone")]) == plain([(c, 0, "u", "gone")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert got(spark, [(None, 0, "u", "x")]) == []
    assert prefixtrie.conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_name_does_not_depend_on_where_role_and_text_meet(spark):
    rows = [(100, 0, "ab", "c"), (200, 0, "a", "bc")]
    assert got(spark, rows) == plain(rows)


def test_ends_in_several_segments(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "SEGMENT", 4)
    ends = spark.createDataFrame([(b"a", i) for i in range(-30, 100)] + [(b"b", 5)], "name binary, conv_id long")
    out = {bytes(r["name"]): r["ends_sha256"] for r in prefixtrie.ends_digests(ends).collect()}
    assert out == {b"a": hashlib.sha256(",".join(map(str, range(-30, 100))).encode()).hexdigest(), b"b": hashlib.sha256(b"5").hexdigest()}
