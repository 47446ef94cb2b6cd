"""Near-duplicate vectors by sorted passes over random hashes.

A pass writes the signs of random projections of a vector one after the other and sorts the vectors
by that string, so that close vectors come to lie near each other. The order is cut into blocks, and
a block is compared with itself and the next one: every vector meets at least a block's length of
neighbours. The links of all passes are united. The number of vectors gives the number of passes that
evenly spread vectors need. How many leading signs its windows really ask of a vector is then read off
the blocks' borders; the vectors for which the passes do not suffice, those of dense groups, are
compared with each other in full, in pairs of cells. Only pairs of cells that the triangle inequality
of angles rules out are left out. Equal vectors are one class from the start.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.components import components
from tidemark.plans.staging import stored

BLOCK = 1024
BITS = 62
# Probability that a pair just at the threshold lies in no pass's windows.
MISS = 1e-4
# Blocks of the first pass that make up a cell of dense vectors.
CELL_BLOCKS = 4
# Cosines that are looked at in one go.
COSINES = 2**20


def passes(vectors: int, cosine: float, block: int = BLOCK) -> int:
    """Passes needed: a pair is met once it agrees on so many leading signs that a block holds all who do."""
    depth = max(0.0, log2(max(vectors, 1) / block) + 1)
    met = (1 - acos(cosine) / pi) ** depth
    return 1 if met >= 1 - MISS else ceil(log(MISS) / log(1 - met))


def _numbers(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix of unit rows."""
    matrix = np.array(column.to_pylist(), np.float64)
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _hashed(batches, count, seed):
    """id, dim, pass, code: the leading signs of each vector under each pass's projections."""
    weights = 2 ** np.arange(BITS - 1, -1, -1, dtype=np.int64)
    for batch in batches:
        ids, vectors = batch.column(0).to_numpy(), batch.column(1)
        dims = np.array([len(v) for v in vectors])
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            unit = _numbers(vectors.take(pa.array(rows)))
            for number in range(count):
                planes = np.random.default_rng([seed, number, dim]).standard_normal((dim, BITS))
                code = ((unit @ planes) > 0) @ weights
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows]), pa.array(np.full(len(rows), dim, np.int32)),
                     pa.array(np.full(len(rows), number, np.int32)), pa.array(code)], ["id", "dim", "pass", "code"])


def _linked(group: pa.Table, cosine: float) -> pa.Table:
    """id, links, root for the vectors of a block (and its guests) that have a link here.

    A pair is counted in the first pass that meets it. The links of a group go out as one row per
    vector, whatever their number: how many it has, and the smallest id it hangs together with.
    """
    guest = group["guest"].to_numpy()
    group = group.take(pa.array(np.argsort(guest, kind="stable")))
    own = int((~guest).sum())
    ids, size, number = group["id"].to_numpy(), group["size"].to_numpy(), group["pass"][0].as_py()
    unit, blocks = _numbers(group["vector"].combine_chunks()), np.array(group["blocks"].to_pylist(), np.int32)
    # Two different cells are only compared with each other; each is compared with itself in a group of its own.
    least = own if "cell" in group.column_names and group["cell"][0] != group["other_cell"][0] else 0
    links, touched = np.zeros(len(ids), np.int64), np.zeros(len(ids), bool)
    # Every vector points to one of no greater place in the order of ids.
    order = np.argsort(ids, kind="stable")
    place, root = np.argsort(order, kind="stable"), np.arange(len(ids))
    step = max(1, COSINES // len(ids))
    for start in range(0, own, step):
        a, b = np.nonzero(unit[start:min(start + step, own)] @ unit.T >= cosine)
        a += start
        met = (a < b) & (b >= least)
        a, b = a[met], b[met]
        touched[a] = touched[b] = True
        fresh = np.ones(len(a), bool)
        for column in range(number):
            fresh &= np.abs(blocks[a, column] - blocks[b, column]) > 1
        np.add.at(links, a[fresh], size[b[fresh]])
        np.add.at(links, b[fresh], size[a[fresh]])
        a, b = root[place[a]], root[place[b]]
        while (apart := a != b).any():
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not ((jumped := root[root]) == root).all():
                root = jumped
            a, b = root[a], root[b]
    found = np.flatnonzero(touched)
    return pa.table({"id": pa.array(ids[found]), "links": pa.array(links[found]), "root": pa.array(ids[order[root[place[found]]]])})


def _ball(group: pa.Table) -> pa.Table:
    """dim, cell, centre, radius: the mean direction of a cell and the greatest angle to it."""
    unit = _numbers(group["vector"].combine_chunks())
    centre = unit.sum(axis=0)
    length = np.sqrt((centre * centre).sum())
    centre = centre / length if length > 1e-9 else unit[0]
    radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
    return pa.table({"dim": group["dim"][:1], "cell": group["cell"][:1], "centre": pa.array([centre.tolist()]), "radius": pa.array([radius])})


def _dense_seats(dense: DataFrame, count: int, cosine: float) -> DataFrame:
    """The dense vectors beside all others that may link with them, as groups of two cells for ``_linked``."""
    balls = stored(dense.select("dim", "cell", "vector").groupBy("dim", "cell").applyInArrow(
        _ball, "dim int, cell int, centre array<double>, radius double"), "balls")
    other = balls.select("dim", *(F.col(c).alias(f"other_{c}") for c in ("cell", "centre", "radius")))
    between = F.aggregate(F.zip_with("centre", "other_centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    angle = F.acos(F.greatest(F.least(between, F.lit(1.0)), F.lit(-1.0)))
    # The slack is far above the rounding of the angles.
    near = (F.col("cell") <= F.col("other_cell")) & (angle <= F.col("radius") + F.col("other_radius") + acos(cosine) + 1e-6)
    pairs = stored(balls.repartition("dim", "cell").join(other, "dim").where(near).select("dim", "cell", "other_cell"), "cells")
    columns = ("id", "size", "vector", "blocks", "dim", F.lit(count).alias("pass"))
    own = dense.join(pairs, ["dim", "cell"]).select(*columns, "cell", "other_cell", F.lit(False).alias("guest"))
    guests = dense.withColumnRenamed("cell", "other_cell").join(pairs.where("cell != other_cell"), ["dim", "other_cell"])
    return own.union(guests.select(*columns, "cell", "other_cell", F.lit(True).alias("guest")))


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95,
                 block: int = BLOCK, seed: int = 20) -> DataFrame:
    """id, n_links, component_id, kept: one row per row of ``vectors``.

    Vectors that are null, empty, zero, or hold null or non-finite numbers are linked with nothing,
    and so are rows without key, which have no component and are kept. Vectors of different lengths
    are never linked. Equal vectors are linked with each other and have the same other links.
    Repeated rows count as different vectors. Other columns are not read.
    """
    read = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    sound = F.exists("vector", lambda x: x != 0) & F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = read.withColumn("sound", F.coalesce(sound & F.col("id").isNotNull(), F.lit(False)))
    classes = stored(rows.where("sound").groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("size")), "classes")
    count = passes(classes.count(), cosine, block)

    codes = classes.select("id", "vector").mapInArrow(lambda b: _hashed(b, count, seed), "id long, dim int, pass int, code long")
    # Vectors of the same code follow in an order of the pass's own, so that each pass has other neighbours.
    tie = F.xxhash64("pass", "id").alias("tie")
    in_order = codes.select("*", tie).repartitionByRange("dim", "pass", "code", "tie").sortWithinPartitions("dim", "pass", "code", "tie")
    placed = stored(in_order.select("id", "dim", "pass", "code", F.monotonically_increasing_id().alias("at")), "placed")
    # One row per partition and pass: how many rows of the pass lie before it.
    part = F.shiftright("at", 33).alias("part")
    runs = placed.groupBy("dim", "pass", part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("dim", "pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    ranked = stored(placed.withColumn("part", F.shiftright("at", 33)).join(runs, ["dim", "pass", "part"]).select(
        "id", "dim", "pass", "code", F.floor((F.col("before") + F.col("at") - F.col("first")) / block).cast("int").alias("block")), "ranked")
    # A vector meets all that share more leading signs with it than the nearest codes beyond its windows do.
    at_block = Window.partitionBy("dim", "pass").orderBy("block")
    edges = ranked.groupBy("dim", "pass", "block").agg(F.min("code").alias("low"), F.max("code").alias("high")).select(
        "dim", "pass", "block", F.lag("high", 2).over(at_block).alias("below"), F.lead("low", 2).over(at_block).alias("above"))

    def asked(edge: str) -> Column:
        unlike = F.col("code").bitwiseXOR(F.col(edge))
        return F.when(F.col(edge).isNull(), 0).otherwise(BITS + 1 - F.when(unlike == 0, 0).otherwise(F.length(F.bin(unlike))))

    depth = F.greatest(asked("below"), asked("above"))
    met = F.when(depth > BITS, 0.0).otherwise(F.pow(F.lit(1 - acos(cosine) / pi), depth))
    seen = ranked.join(edges, ["dim", "pass", "block"]).select("id", "pass", "block", F.log(F.greatest(1 - met, F.lit(1e-300))).alias("unmet"))
    blocks = stored(seen.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pass", "block")))["block"].alias("blocks"),
                                           F.sum("unmet").alias("unmet")), "blocks")

    seat = F.explode(F.expr("flatten(transform(blocks, (b, p) -> array(struct(p AS pass, b AS block, false AS guest),"
                            " struct(p AS pass, b - 1 AS block, true AS guest))))")).alias("seat")
    seated = classes.join(blocks, "id").select("id", "size", "vector", "blocks", F.size("vector").alias("dim"), seat).select(
        "id", "size", "vector", "blocks", "dim", F.col("seat.pass").alias("pass"), F.col("seat.block").alias("block"),
        F.col("seat.guest").alias("guest")).where("block >= 0")
    link = "id long, links long, root long"
    found = stored(seated.groupBy("dim", "pass", "block").applyInArrow(lambda group: _linked(group, cosine), link), "links")
    cell = F.floor(F.get("blocks", F.lit(0)) / CELL_BLOCKS).cast("int").alias("cell")
    dense = stored(classes.join(blocks.where(F.col("unmet") > log(MISS)), "id").select(
        "id", "size", "vector", "blocks", F.size("vector").alias("dim"), cell), "dense")
    if not dense.isEmpty():
        more = _dense_seats(dense, count, cosine).groupBy("dim", "cell", "other_cell").applyInArrow(lambda group: _linked(group, cosine), link)
        found = found.union(stored(more, "dense_links"))

    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())
    grouped = classes.join(linked, "id", "left").join(joined, "id", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    whole = rows.join(grouped.withColumnRenamed("vector", "of"), F.col("sound") & (F.col("vector") == F.col("of")), "left")
    component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("id"))
    return whole.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
