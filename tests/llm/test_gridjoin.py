import math

import numpy as np
import pytest

from tablexport.llm import gridjoin

SCHEMA = "vec_id long, embedding array<double>, label int, id long, tile string"


def cosine(a, b):
    a, b = np.array(a, np.longdouble), np.array(b, np.longdouble)
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def fits(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def plain(rows, least=0.98):
    n, near = len(rows), [set() for _ in rows]
    for i, (_, v, l) in enumerate(rows):
        for j, (_, w, m) in enumerate(rows[:i]):
            if l is not None and l == m and fits(v) and fits(w) and len(v) == len(w) and cosine(v, w) >= least:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        low = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(near[i]), low, rows[i][0] == low))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted(map(tuple, gridjoin.near_duplicates(df, **kw).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)


def clustered(rnd, n, dims, labels, spread):
    centres = rnd.normal(size=(12, dims))
    return [(i, (centres[rnd.integers(12)] + rnd.normal(size=dims) * spread).tolist(), int(rnd.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dims,spread", [(5, 0.12), (24, 0.06), (40, 0.02)])
def test_many_small_tiles_against_all_pairs(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(gridjoin, "TILE", 16)
    monkeypatch.setattr(gridjoin, "LEAF", 4)
    monkeypatch.setattr(gridjoin, "PARTNERS", 2)
    monkeypatch.setattr(gridjoin, "FAN", 4)
    rnd = np.random.default_rng(dims)
    rows = clustered(rnd, 260, dims, 2, spread)
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(40)]  # copies
    expected = plain(rows)
    assert got(spark, rows) == expected and len({r[2] for r in expected}) < len(rows) and any(r[1] for r in expected)


def test_vectors_that_link_with_nothing_and_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(9, v, 1), (3, v, 1), (3, v, 1), (4, [x * 1e200 for x in v], 1), (5, [x * 1e-200 for x in v], 1), (6, v, 2), (7, v, None), (8, v, None), (None, v, 1),
            (None, [-1.0, 2.0, 3.0], 1), (10, None, 1), (11, [], 1), (12, [0.0, -0.0, 0.0], 1), (13, [0.0, 0.0, 0.0], 1), (14, [1.0, None, 3.0], 1),
            (15, [math.nan, 2.0, 3.0], 1), (16, [math.inf, 2.0, 3.0], 1), (17, [1.0, 2.0, 3.0, 0.0], 1), (18, [2.0], 3), (19, [-2.0], 3), (20, [0.5], 3)]
    expected = [(i, n, c, True if i is None and c is None else k) for i, n, c, k in plain(rows)]
    assert got(spark, rows) == sorted(expected, key=str)


def test_the_border_belongs_to_the_links(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [3.0, 4.0], 0), (2, [3.0, 4.0000001], 0)]
    assert {r[0]: r[1] for r in got(spark, rows, least=0.6)} == {0: 1, 1: 2, 2: 1}


def test_a_chain_is_one_component_and_empty_tables_give_no_rows(spark):
    rows = [(100 - i, [math.cos(0.1 * i), math.sin(0.1 * i)], 0) for i in range(40)]
    out = got(spark, rows)
    assert out == plain(rows) and {r[2] for r in out} == {61}
    assert gridjoin.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert gridjoin.near_duplicates(spark.createDataFrame([(1, None, 2, 3, "x")], SCHEMA)).count() == 1


def test_distant_tiles_are_not_joined(spark, monkeypatch):
    monkeypatch.setattr(gridjoin, "TILE", 16)
    rnd = np.random.default_rng(5)
    rows = [(i, [math.cos(a), math.sin(a), 0.01], 0) for i, a in enumerate(rnd.uniform(0, 6, 600))]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>, label int").selectExpr("id", "label", "1L as w", "vector")
    eps = 0.2
    placed = gridjoin._sequence(gridjoin._placed(vectors, {3: gridjoin.principal_axes(vectors, 3)}, eps))
    tiles, pairs = placed.select("tile").distinct().count(), gridjoin.tile_pairs(placed, eps).count()
    assert tiles >= 38 and pairs < tiles * (tiles + 1) / 6
