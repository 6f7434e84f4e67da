import random

import pytest

from tablexport.llm.common import components, free_name
from tests.llm import helpers


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(rnd.randrange(10, 60))]
    df = spark.createDataFrame(edges + edges[:3] + [(None, 4), (7, None)], "a int, b int")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    linked = {tuple(sorted(e)) for e in edges if e[0] != e[1]}
    nodes = {x for e in linked for x in e}
    assert got == helpers.components(sorted(nodes), lambda a, b: (a, b) in linked)


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain + star, "a int, b int")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_free_name(spark):
    df = spark.createDataFrame([(1, 2)], "x int, X_ int")
    assert free_name(df, "x") == "x__" and free_name(df, "y") == "y"
