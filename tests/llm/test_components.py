import random

import pytest

from gleanery.llm.components import components


def plain(edges):
    root = {v: v for e in edges for v in e if None not in e and e[0] != e[1]}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        if a in root and b in root:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {v: find(v) for v in root}


@pytest.mark.parametrize("edges", [
    [],
    [(1, 1)],
    [(i, i + 1) for i in range(200)],
    [(0, i) for i in range(1, 300)] + [(500, 501), (501, 500)],
    [(random.Random(i).randrange(80), random.Random(i + 999).randrange(80) + 40) for i in range(60)],
    [(-5, 3), (3, 9), (None, 4), (4, None)],
])
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.component for r in found} == plain(edges)
