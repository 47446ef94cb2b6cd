import random

from tidemark.llm.components import components


def solved(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def test_paths_stars_and_random_graphs(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(200)]
    links += [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(200)]
    links += [(3000, 3000), (5, 4), (4, 5)]
    found = components(spark.createDataFrame(links, "a long, b long"))
    want = {x: c for x, c in solved([l for l in links if l[0] != l[1]]).items()}
    assert {r["id"]: r["component"] for r in found.collect()} == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
