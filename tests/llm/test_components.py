import random

from pagelathe.llm.components import connected


def by_hand(edges):
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {a: find(a) for a in list(root)}


def test_random_graphs_chains_and_stars(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(80)]
    edges += [(7, 7), (None, 3), (4, None)]
    found = connected(spark.createDataFrame(edges, "u bigint, v bigint"))
    assert {r.node: r.component for r in found.collect()} == by_hand(edges)
    assert found.count() == len(by_hand(edges))


def test_no_edges(spark):
    assert connected(spark.createDataFrame([], "u bigint, v bigint")).count() == 0
