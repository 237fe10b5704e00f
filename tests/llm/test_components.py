import random

import numpy as np

from trellis.llm.components import block_components, connected_components, star_edges


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1080)] + [(None, 3), (4, None), (5, 5)]
    edges += [(2000, i) for i in range(2001, 2200)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    out = connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in out} == {x: find(x) for x in root} and len(out) == len(root)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_block_components_and_stars():
    link = np.zeros((4, 5), bool)
    link[[0, 1, 1, 3], [0, 0, 2, 4]] = True
    a, b = block_components(link)
    assert a[0] == a[1] == b[0] == b[2] and a[3] == b[4] and len({a[0], a[2], a[3]}) == 3
    x, y = star_edges(link, np.arange(4), np.arange(10, 15))
    assert sorted(zip(x.tolist(), y.tolist())) == [(1, 0), (10, 0), (12, 0), (14, 3)]
    assert len(star_edges(np.zeros((0, 3), bool), np.arange(0), np.arange(3))[0]) == 0
