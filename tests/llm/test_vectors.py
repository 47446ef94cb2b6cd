import numpy as np

from tidemark.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id long, size int, vector string"


def table(spark, rows):
    return spark.createDataFrame([(key, v, 0, key, 1, "x") for key, v in rows], SCHEMA)


def brute_force(rows, cosine=0.95):
    keys = [k for k, _ in rows]
    unit = np.array([np.array(v, np.float32).astype(float) for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    label = np.array(keys)
    while True:
        new = np.array([min(label[i], *label[linked[i]]) if linked[i].any() else label[i] for i in range(len(keys))])
        if (new == label).all():
            break
        label = new
    return {k: (int(linked[i].sum()), int(label[i]), bool(label[i] == k)) for i, k in enumerate(keys)}


def found(spark, rows, **options):
    return {r["id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(table(spark, rows), **options).collect()}


def drawn(count=1500, groups=6):
    random = np.random.default_rng(4)
    rows = random.normal(size=(count, 32))
    for g in range(groups):
        rows[g * 60:(g + 1) * 60] = rows[g * 60] + random.normal(size=(60, 32)) * 0.02 * (g + 1)
    rows[700:720] = rows[700]
    return [(int(k), v.tolist()) for k, v in zip(random.permutation(count), rows)]


def test_all_links_in_one_window_or_many(spark):
    rows = drawn()
    want = brute_force(rows)
    assert found(spark, rows) == want
    small = found(spark, rows, block=128)
    assert sum(n for n, _, _ in small.values()) >= 0.99 * sum(n for n, _, _ in want.values())
    assert all(small[k][0] <= want[k][0] for k in want)


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, []), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.0]), (None, [1.0, 0.0])]
    want = {k: (0, k, True) for k in range(3, 10)} | {1: (2, 1, True), 2: (2, 1, False), 10: (2, 1, False), None: (0, None, True)}
    assert found(spark, rows) == want
    assert found(spark, []) == {}


def test_passes_grow_with_the_logarithm():
    assert vectors.passes(400, 0.95) == 1
    assert 1 < vectors.passes(10**5, 0.95) < vectors.passes(10**9, 0.95) < 200


def test_links_inside_a_dense_cone_are_all_met(spark):
    # A third of the vectors at cosine 0.90 of each other, in pairs at 0.951: signs hardly tell them apart.
    random = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    first = unit(random.normal(size=(700, 63)))
    other = random.normal(size=(700, 63))
    other = unit(other - (other * first).sum(axis=1, keepdims=True) * first)
    second = 0.51 * first + np.sqrt(1 - 0.51 ** 2) * other
    cone = np.column_stack([np.full(1400, np.sqrt(0.9)), np.sqrt(0.1) * np.concatenate([first, second])])
    rows = [(int(k), v.tolist()) for k, v in zip(random.permutation(4200), np.concatenate([cone, random.normal(size=(2800, 64))]))]
    want = brute_force(rows)
    assert sum(n for n, _, _ in want.values()) >= 1400
    got = found(spark, rows, block=64)
    assert got == want
