"""Connected components against a plain union-find, and the tables that they take."""

import random

import numpy as np
import pytest

from zonepulse.llm import components as C

SHUFFLED = random.Random(3).sample(range(400), 400)
GRAPHS = {
    "no edge": [],
    "loop": [(1, 1)],
    "path": [(i, i + 1) for i in range(400)],
    "path in no order": list(zip(SHUFFLED, SHUFFLED[1:], strict=False)),
    "two lower neighbours": [(a, a - d) for a in range(2, 400) for d in (1, 2)],
    "small trees": [(random.Random(i).randrange(500), random.Random(-i).randrange(500)) for i in range(400)],
    "hub above all": [(10**12, i) for i in range(400)],
    "wide numbers": [(-5, 3), (3, -7), (2**62, -5), (3, -7)],
}


def plain(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


@pytest.mark.parametrize("name", GRAPHS)
def test_components_equal_union_find(spark, name):
    edges = GRAPHS[name]
    found = C.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    assert sorted((r["node"], r["component"]) for r in found) == sorted(plain(edges).items())


def test_task_joins_up_its_edges():
    for edges in GRAPHS.values():
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        assert dict(zip(*(x.tolist() for x in C.roots(a, b)), strict=True)) == {x: y for x, y in plain(edges).items() if x != y}


def test_edges_of_one_task_take_no_round(spark, monkeypatch):
    """Two tables: the edges joined up, and each node's least neighbour; the steps before took a table a round."""
    written, kept = [], C.stored
    monkeypatch.setattr(C, "stored", lambda df, name: written.append(name) or kept(df, name))
    edges = GRAPHS["path"]
    found = C.components(spark.createDataFrame(edges, "a long, b long").coalesce(1)).collect()
    assert {r["node"]: r["component"] for r in found} == plain(edges)
    assert len(written) <= 2, written
