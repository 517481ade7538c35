import random

import pytest

from tallyframe.llm import graph


@pytest.mark.parametrize("small", [0, 10**6])
def test_components_by_rounds_and_in_one_task(spark, small, monkeypatch):
    monkeypatch.setattr(graph, "SMALL_EDGES", small)
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(25)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    got = {r.node: r.label for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: top(x) for x in joined}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
