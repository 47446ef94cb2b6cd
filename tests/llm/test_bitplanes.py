import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import bitplanes


def brute_force(rows, clusters=8, rounds=10):
    kept = [(key, [int(np.floor(1024 * float(x))) for x in v]) for key, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    seeds = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:clusters]
    centroids = [v for _, v in seeds]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            mine = [v for (_, v), c in zip(kept, of) if c == k]
            if mine:
                centroids[k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(key, *near(v)) for key, v in kept]
    inertia = {k: sum(d for _, d, c in found if c == k) for k in range(len(centroids))}
    return sorted(((key, k, d, inertia[k], sum(inertia.values()), centroids[k]) for key, d, k in found), key=repr)


def clustered(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "vec_id AS id", "embedding AS planes", "1 AS norm", "'x' AS cluster", "0.5 AS distance")
    return sorted((tuple(r) for r in bitplanes.cluster(table, **options).collect()), key=repr)


def drawn(n, spread=1.0, seed=1):
    draw = random.Random(seed)
    return [(i, [draw.gauss(i % 5, spread) for _ in range(64)]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = drawn(300)
    assert clustered(spark, rows) == brute_force(rows)
    assert clustered(spark, rows, clusters=3, rounds=2) == brute_force(rows, 3, 2)


def test_cases(spark):
    one = [0.25] * 64
    odd = [(1, None), (2, []), (3, [1.0] * 63), (4, [1.0] * 65), (5, [*one[:-1], None]), (6, [*one[:-1], float("nan")]),
           (7, [*one[:-1], float("-inf")]), (None, one), (None, None)]
    # Ties: equal vectors take every centroid, the others follow the first; zeros and tiny negative numbers.
    rows = [*odd, *((i, one) for i in range(10, 40)), (10, one), (50, [0.0] * 64), (51, [-1e-9] * 64), (52, [-0.0] * 64), (53, [1000.0] * 64)]
    assert clustered(spark, rows) == brute_force(rows)
    assert clustered(spark, odd[:7]) == [] and clustered(spark, []) == []
    assert clustered(spark, rows[:9]) == brute_force(rows[:9])


def test_large_components(spark):
    rows = [(i, [x * 2e4 for x in v]) for i, v in drawn(40)]
    assert clustered(spark, rows) == brute_force(rows)
    with pytest.raises(ValueError, match="do not fit"):
        clustered(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])


def test_planes_and_products():
    draw = np.random.default_rng(2)
    values = draw.integers(-5000, 5000, (50, 64))
    words = bitplanes.packed(values, 14)
    assert (bitplanes.unpacked(words) == values).all()
    assert (bitplanes.dots(words, words[:7]) == values @ values[:7].T).all()
