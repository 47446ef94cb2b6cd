"""Sources mixed to target weights by the windows of proportionate fair scheduling.

A source's rows are cut into blocks. With weight w of a period of D slots, its block i is released
at slot floor(i D / w) and is due by slot ceil((i + 1) D / w); of the released blocks the one with
the earliest deadline goes next. So at any slot each source has had its share up to less than one
block. The order repeats every D slots, where all shares are met exactly: one period, of bounded
length, is laid out once, and the slot of every block of any corpus follows from it by arithmetic.
"""

from __future__ import annotations

import heapq
from math import floor

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.plans.staging import broadcast_if_small

# Slots of a period: weights are rounded to these shares.
RESOLUTION = 1000
BLOCK_ROWS = 64
# Rows of a source that are numbered in one task.
ROWS_PER_RANGE = 10_000


def shares(weights: dict, resolution: int = RESOLUTION) -> dict:
    """Weights as whole numbers of slots of a period, by the largest remainders; each has one slot at least."""
    total = sum(weights.values())
    exact = {s: w * max(resolution, len(weights)) / total for s, w in weights.items()}
    slots = {s: max(1, floor(x)) for s, x in exact.items()}
    left = max(resolution, len(weights)) - sum(slots.values())
    for s in sorted(exact, key=lambda s: (-(exact[s] - floor(exact[s])), str(s)))[:max(0, left)]:
        slots[s] += 1
    return slots


def period(slots: dict) -> list[tuple]:
    """(source, block, slot, release, deadline) of every block of one period."""
    length = sum(slots.values())
    names = sorted(slots, key=str)
    release = lambda s, i: i * length // slots[s]
    coming = [(0, at, 0) for at in range(len(names))]
    heapq.heapify(coming)
    ready: list[tuple] = []
    out = []
    for slot in range(length):
        while coming and coming[0][0] <= slot:
            _, at, i = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(i + 1) * length // slots[names[at]]), at, i))
        deadline, at, i = heapq.heappop(ready)
        out.append((names[at], i, slot, release(names[at], i), deadline))
        if i + 1 < slots[names[at]]:
            heapq.heappush(coming, (release(names[at], i + 1), at, i + 1))
    return out


def mix(docs: DataFrame, weights: dict | None = None, key: str = "doc_id", source: str = "source", power: float = 0.5,
        block_rows: int = BLOCK_ROWS, resolution: int = RESOLUTION) -> DataFrame:
    """``docs`` with mix_block, mix_slot, mix_release, mix_deadline and mix_place; the mix is the order of (slot, place).

    ``weights`` gives each source's target; a source that it lacks, and a null source, which is one
    of its own, gets the smallest given weight. Without weights a source's target is its number of
    rows to the power ``power``. No row is dropped or repeated: when a source has run out its slots
    stay empty, and the others keep their shares among each other. A source's rows follow in the
    order of a hash of their key; rows of equal keys in any order. Columns of these names are
    replaced. Every row gives one row.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if not c.startswith("mix_")]
    # One entry per source: the mix is defined for a number of sources that can be listed.
    sizes = {r["source"]: r["n"] for r in docs.groupBy(F.col(source).alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if weights is None:
        weights = {s: n ** power for s, n in sizes.items()}
    given = {s: weights.get(s, min(weights.values())) for s in sizes}
    slots = shares(given, resolution) if given else {}
    length = sum(slots.values())
    kind = docs.schema[source].dataType
    plan = spark.createDataFrame(period(slots), f"of {kind.simpleString()}, i int, slot int, release int, deadline int")
    facts = spark.createDataFrame([(s, slots[s], n // ROWS_PER_RANGE + 1) for s, n in sizes.items()],
                                  f"of {kind.simpleString()}, share int, ranges int")

    # Both tables are bounded, by the number of sources and by the period.
    rows = docs.select(F.struct(*names).alias("kept"), F.col(source).alias("source"), F.xxhash64(F.lit(3), F.col(key)).alias("order"))
    rows = rows.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    # The place of a hash in its range, from 0 to 1, cut to the source's number of ranges.
    part = F.least(F.floor((F.col("order") / 2.0**64 + 0.5) * F.col("ranges")), F.col("ranges") - 1).cast("int")
    rows = rows.withColumn("part", part)
    counts = docs.select(F.col(source).alias("source"), F.xxhash64(F.lit(3), F.col(key)).alias("order")).join(
        F.broadcast(facts), F.col("source").eqNullSafe(F.col("of"))).withColumn("part", part).groupBy("source", "part").agg(
        F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("of"), F.col("part").alias("at"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "part").orderBy("order"))
    # Sent to the rows while it is short, so that these are not shuffled once more to meet it.
    ranked = rows.withColumn("inside", inside).join(
        broadcast_if_small(counts), F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at"))).drop("of")
    ranked = ranked.select("kept", "source", "share", (F.col("before") + F.col("inside") - 1).alias("rank"))
    block = F.floor(F.col("rank") / block_rows)
    ranked = ranked.withColumn("block", block).withColumn("round", F.floor(F.col("block") / F.col("share")))
    placed = ranked.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") % F.col("share") == F.col("i")))
    at = lambda c: (F.col("round") * length + F.col(c)).cast("long")
    return placed.select(*(F.col("kept").getField(c).alias(c) for c in names), F.col("block").cast("long").alias("mix_block"),
                         at("slot").alias("mix_slot"), at("release").alias("mix_release"), at("deadline").alias("mix_deadline"),
                         (F.col("rank") % block_rows).cast("int").alias("mix_place"))
