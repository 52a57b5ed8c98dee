import random

from tavolo.llm.components import components


def test_against_union_find(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(90)]
    edges += edges[:10] + [(7, 7)] + [(b, a) for a, b in edges[:5]]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
