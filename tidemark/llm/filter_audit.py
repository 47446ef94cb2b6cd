"""What filters remove together, one after the other in every order, and what each is worth.

Documents are counted by the set of filters they fail, and a part's counts give what each of the 32
coalitions of filters removes. A filter's removals at a step of an order are the difference of two
coalitions. Its Shapley value solves a least-squares problem over all coalitions, weighted by their
sizes and bound to add up to what all filters remove; the normal equations are the same for every part,
so they are solved once, in rational numbers, for all right-hand sides, and applied to each part's table.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, Window, functions as F

# What separates words, the signs a document must not hold, and the limits.
SPACE = r"[ \x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SIGNS = "[#$%&*|]"
LEAST_WORDS, DISTINCT_SHARE, CAPITAL_SHARE = 200, 50, 3

FILTERS = "ABCDE"


def text_failures(text: Column) -> list[Column]:
    """Conditions A to D of a text: too short, repetitive, many capitals, signs."""
    words = F.split(F.btrim(text, F.lit(BLANKS)), SPACE)
    blank = F.btrim(text, F.lit(BLANKS)) == ""
    count, distinct = (F.when(blank, 0).otherwise(F.size(x)) for x in (words, F.array_distinct(words)))
    letters = F.char_length(text).cast("long")
    capitals = letters - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [count < LEAST_WORDS, 100 * distinct.cast("long") < DISTINCT_SHARE * count,
            100 * capitals > CAPITAL_SHARE * letters, text.rlike(SIGNS)]


def _mask(conditions: list[Column]) -> Column:
    found = F.lit(0)
    for at, condition in enumerate(conditions):
        found = found + F.when(condition, 1 << at).otherwise(0)
    return found


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part STRING, mask INT (bits of failed filters, A lowest), n, good, toxic LONG: one row per part and mask.

    Filter E fails a document whose text stands under a smaller id anywhere in the table. Texts meet as
    digests, counted per part before they are compared, so copies in any number are one row of each task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc"),
                       F.sha2(text, 256).alias("digest"), _mask(text_failures(text)).alias("mask"))
    rows = rows.groupBy("digest", "mask", "part", "doc").agg(F.count(F.lit(1)).alias("n"))
    marked = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int")).alias(c)
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc")).agg(marked("quality"), marked("toxic"))
    rows = rows.join(marks, "doc", "left").select(
        "digest", "mask", "part", "doc", "n", *((F.coalesce(c, F.lit(0)) * F.col("n")).alias(name) for c, name in (("quality", "good"), ("toxic", "bad"))))
    first = F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "n", "good", "bad"))).alias("first")
    # Rows without an id are copies of nothing smaller; they have no labels either.
    nameless = F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("nameless")
    texts = rows.groupBy("digest", "mask", "part").agg(first, nameless, *(F.sum(c).alias(c) for c in ("n", "good", "bad")))
    smallest = F.min("first.doc").over(Window.partitionBy("digest", "mask"))
    texts = texts.withColumn("leads", F.coalesce(F.col("first.doc") == smallest, F.lit(False)))
    own = lambda c: F.when(F.col("leads"), F.col(f"first.{c}")).otherwise(0)
    stays = F.struct("mask", (own("n") + F.col("nameless")).alias("n"), own("good").alias("good"), own("bad").alias("toxic"))
    copy = 1 << FILTERS.index("E")
    goes = F.struct((F.col("mask") + copy).alias("mask"), (F.col("n") - own("n") - F.col("nameless")).alias("n"),
                    (F.col("good") - own("good")).alias("good"), (F.col("bad") - own("bad")).alias("toxic"))
    both = texts.select("part", F.inline(F.array(stays, goes)))
    return both.groupBy("part", "mask").agg(*(F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")))


def coalitions(counts: DataFrame, filters: int) -> DataFrame:
    """part, total and, for n, good and toxic, an array over all coalitions: how many documents it removes."""
    removed = lambda c: F.array(*(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(c)).otherwise(0)) for s in range(1 << filters)))
    return counts.groupBy("part").agg(F.sum("n").alias("total"), *(removed(c).alias(c) for c in ("n", "good", "toxic")))


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solutions of a square system for several right-hand sides, by exact elimination."""
    rows = [[*a, *b] for a, b in zip(matrix, right)]
    for at in range(len(rows)):
        lead = next(r for r in range(at, len(rows)) if rows[r][at])
        rows[at], rows[lead] = rows[lead], rows[at]
        rows[at] = [x / rows[at][at] for x in rows[at]]
        for r, row in enumerate(rows):
            if r != at and row[at]:
                rows[r] = [x - row[at] * y for x, y in zip(row, rows[at])]
    return [row[len(matrix):] for row in rows]


def shapley_weights(filters: int) -> list[list[Fraction]]:
    """For each filter what every coalition's removal counts for in its Shapley value.

    The values minimise, over all proper coalitions s, the sum of (k - 1) / (C(k, |s|) |s| (k - |s|)) times
    the squared difference of what s removes and what its filters are worth together, among those that
    add up to what all filters remove. The bound enters the normal equations with a multiplier.
    """
    every = (1 << filters) - 1
    proper = range(1, every)
    kernel = {s: Fraction(filters - 1, comb(filters, s.bit_count()) * s.bit_count() * (filters - s.bit_count())) for s in proper}
    shared = lambda i, j: sum(w for s, w in kernel.items() if s >> i & 1 and s >> j & 1)
    matrix = [[*(Fraction(shared(i, j)) for j in range(filters)), Fraction(1)] for i in range(filters)]
    matrix.append([*[Fraction(1)] * filters, Fraction(0)])
    right = [[kernel[s] if s in kernel and s >> i & 1 else Fraction(0) for s in range(every + 1)] for i in range(filters)]
    right.append([Fraction(s == every) for s in range(every + 1)])
    return solved(matrix, right)[:filters]


def _whole(value: Fraction) -> int:
    if value.denominator != 1:
        raise ValueError(f"{value} is no whole number of removals")
    return value.numerator


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters (two or more) and step: see ``filter_audit``. ``counts`` is what ``failures`` gives."""
    size = len(filters)
    every, orders = (1 << size) - 1, factorial(size)
    worth = lambda row: sum((F.col("n")[s] * F.lit(_whole(w * orders)) for s, w in enumerate(row) if w), F.lit(0).cast("long"))
    table = coalitions(counts, size).withColumn("shapley", F.array(*map(worth, shapley_weights(size))))
    steps = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            after = before | 1 << filters.index(letter)
            steps.append(f"named_struct('filter_order', '{''.join(order)}', 'step', {step}, 'at', {filters.index(letter)}, "
                         f"'before', {before}, 'after', {after})")
            before = after
    rows = table.selectExpr("*", f"inline(array({', '.join(steps)}))")
    step_of = lambda c: F.expr(f"{c}[after] - {c}[before]")
    alone, others = F.expr("n[shiftleft(1, at)]"), F.expr(f"n[{every}] - n[{every} - shiftleft(1, at)]")
    return rows.select(
        "part", "filter_order", "step", F.expr("total - n[after]").alias("kept"), step_of("n").alias("removed"),
        (alone - step_of("n")).alias("redundant"), others.alias("unique_fails"), step_of("good").alias("good_lost"),
        step_of("toxic").alias("toxic_lost"), F.expr("shapley[at]").alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step INT, and LONG counts of documents: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley (removed by the step's filter, summed over all orders).

    A null text is an empty one: it fails A only, and E if a smaller id's text is null or empty too. A part is
    a language, null and '' being one. Rows are documents: repeated rows count each, and of rows with one id
    none is smaller. A null id is smaller than nothing and nothing is smaller than it. A document is good or
    toxic if any row of its id in ``labels`` says so. Long texts are read whole. An empty table gives no rows.
    Other columns are not read.
    """
    return audit(failures(docs, labels))
