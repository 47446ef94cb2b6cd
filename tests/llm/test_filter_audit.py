from fractions import Fraction
from itertools import permutations
from math import factorial

from helpers import CASES, LONG, documents

from tidemark.llm import filter_audit


def failures(rows):
    """The letters each row fails, by the plain definitions."""
    found = []
    for key, text, lang, *_ in rows:
        text = text or ""
        words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), "D": any(c in "#$%&*|" for c in text),
                 "E": key is not None and any(k is not None and k < key and (t or "") == text for k, t, *_ in rows)}
        found.append((lang or "", {f for f, bad in fails.items() if bad}))
    return found


def brute_force(rows, labels):
    good = {k for k, quality, _ in labels if quality == 1 and k is not None}
    toxic = {k for k, _, bad in labels if bad == 1 and k is not None}
    found, marks = failures(rows), [(r[0] in good, r[0] in toxic) for r in rows]
    out, worth = [], {}
    for part in {p for p, _ in found}:
        for order in permutations("ABCDE"):
            left = [(fails, mark) for (p, fails), mark in zip(found, marks) if p == part]
            everyone = left
            for step, letter in enumerate(order, 1):
                gone = [mark for fails, mark in left if letter in fails]
                left = [x for x in left if letter not in x[0]]
                failing = sum(letter in fails for fails, _ in everyone)
                alone = sum(fails == {letter} for fails, _ in everyone)
                worth[part, letter] = worth.get((part, letter), 0) + len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), alone, sum(g for g, _ in gone), sum(t for _, t in gone)])
    return sorted((*row, worth[row[0], row[1][row[2] - 1]]) for row in out)


def audited(spark, rows, labels):
    docs = documents(spark, rows).selectExpr("*", "'x' AS mask", "1 AS digest", "2 AS quality", "3 AS good", "4 AS part_", "5 AS doc")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'y' AS text", "0 AS n", "'z' AS doc")
    return sorted(tuple(r) for r in filter_audit.filter_audit(docs, marks).collect())


def test_cases(spark):
    words = " ".join(f"word{i}" for i in range(250))
    rows = [(*row, "en", "s", None) for row in CASES]
    rows += [(20, words, "de", "s", None), (21, words, "de", "s", None), (22, words, None, "s", None), (22, words, "", "s", None), (19, "", "fr", "s", None),
             (23, words + " #", "de", "s", None), (24, (words + " ").upper(), "de", "s", None), (25, "a\x0bb\x0cc d\x85e " * 90, "de", "s", None),
             (26, " " + "x" * 97 + "AB", "de", "s", None), (27, " " + "x" * 96 + "ABC", "de", "s", None), (28, "y" * 96 + "ABCD", "de", "s", None),
             (None, words, "de", "s", None), (None, words, "de", "s", None), (6, LONG, "de", "s", None), (60, LONG, "de", "s", None)]
    labels = [(20, 1, 0), (21, 1, 1), (22, 0, 1), (22, 1, 1), (21, 1, 1), (None, 1, 1), (23, None, None), (99, 1, 1), (5, 1, None), (60, 1, 1)]
    assert audited(spark, rows, labels) == brute_force(rows, labels)


def test_large_groups_of_copies(spark):
    rows = [(i, "same text" if i % 3 else f"text {i} &" * (i % 7), ("en", "de")[i % 2], "s", None) for i in range(500)]
    labels = [(i, i % 2, i % 5 == 0) for i in range(0, 500, 3)]
    labels = [(k, q, int(t)) for k, q, t in labels]
    assert audited(spark, rows, labels) == brute_force(rows, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == []
    rows = [(1, "a", "en", "s", None)]
    assert audited(spark, rows, []) == brute_force(rows, [])


def test_least_squares_give_the_shapley_weights():
    for filters in (2, 3, 5):
        for at, row in enumerate(filter_audit.shapley_weights(filters)):
            expected = [Fraction(0)] * (1 << filters)
            for s in range(1 << filters):
                if not s >> at & 1:
                    share = Fraction(factorial(s.bit_count()) * factorial(filters - s.bit_count() - 1), factorial(filters))
                    expected[s | 1 << at] += share
                    expected[s] -= share
            # What the empty coalition removes is nothing, whatever it counts for.
            assert row[1:] == expected[1:]
