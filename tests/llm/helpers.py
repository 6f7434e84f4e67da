"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def documents(n=None):
    rows = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return rows[:n]


def odd_documents(spark, texts, clash=()):
    """doc_id from 0, text, and columns whose names an operator might use itself."""
    schema = "doc_id long, text string" + "".join(f", {c} string" for c in clash)
    return spark.createDataFrame([(i, t, *["x"] * len(clash)) for i, t in enumerate(texts)], schema)


def components(nodes, linked):
    """node -> smallest node that it reaches, by trying every pair."""
    nodes = list(nodes)
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {x: find(x) for x in nodes}
