import itertools
import random
import re

import numpy as np
from helpers import CASES, LONG, documents

from tidemark.llm import minhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    sets = [(key, shingle_set(text)) for key, text in rows]
    parent = {key: key for key, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and None not in (a, b) and 100 * len(s & t) >= 75 * len(s | t):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return sorted(((k, len(s), root(k) if k is not None else None, k is None or root(k) == k) for k, s in sets), key=repr)


def found(spark, rows):
    return sorted(map(tuple, minhash.near_duplicates(documents(spark, rows)).collect()), key=repr)


def test_cases(spark):
    rows = [*CASES, (20, "a plain TEXT, with some words."), (21, "one"), (22, "One"), (23, LONG + " more")]
    assert found(spark, rows) == brute_force(rows)


def test_groups_of_copies_and_shared_passages(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(500)]
    base, passage = draw.choices(words, k=120), draw.choices(words, k=40)
    rows = [(i, " ".join(base)) for i in range(40)]
    for i in range(40, 400):
        copy = list(base)
        for at in draw.sample(range(120), draw.randrange(1, 8)):
            copy[at] = "edit" + str(draw.randrange(10_000))
        rows.append((i, " ".join(copy)))
    for i in range(400, 600):
        rows.append((i, " ".join(draw.choices(words, k=draw.randrange(5, 60)) + passage)))
    draw.shuffle(rows)
    assert found(spark, rows) == brute_force(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_signatures_are_minima_of_permuted_levels():
    sets = [np.array([1, 2, 3], np.uint64), np.array([3, 4], np.uint64), np.empty(0, np.uint64), np.arange(5000, dtype=np.uint64)]
    each = [minhash.signatures([s])[0] for s in sets]
    assert (minhash.signatures(sets) == np.stack(each)).all()
    # A union's signature is the minimum of the parts', and similarity is the share of equal slots.
    assert (minhash.signatures([np.array([1, 2, 3, 4], np.uint64)])[0] == np.minimum(each[0], each[1])).all()
    a, b = minhash.signatures([np.arange(600, dtype=np.uint64), np.arange(200, 800, dtype=np.uint64)])
    assert abs((a == b).mean() - 0.5) < 0.15
    assert each[3].max() >> np.uint64(32) < 3
