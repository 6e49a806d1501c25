import random

from quire.llm.components import components, stars


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in list(root) if find(x) != x}


def test_equal_to_union_find(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(1, 60)]
    hub = [(1000 + i, 1000) for i in range(1, 40)]
    mixed = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(110)]
    edges = chain + hub + mixed + [(5, 5), (1001, 1000), (1000, 1001)]  # a loop, and edges that repeat
    got, _ = components(spark.createDataFrame(edges, "u long, v long"))
    assert {(r.node, r.root) for r in got.collect()} == plain(edges)


def test_stars_and_nothing(spark):
    frame = lambda rows: spark.createDataFrame(rows, "u long, v long")
    assert stars(frame([(3, 1), (4, 1), (9, 2)])) and stars(frame([]))
    assert not stars(frame([(3, 2), (2, 1)])) and not stars(frame([(3, 2), (3, 1)]))
    assert components(frame([]))[0].collect() == []
