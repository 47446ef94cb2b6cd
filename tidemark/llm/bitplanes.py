"""Clusters of whole-number vectors by bit planes.

Every component is a whole number in two's complement; plane ``j`` of a vector holds bit ``j`` of its 64
components in one 64-bit word. The dot product of two vectors is then a weighted sum, over pairs of
planes, of the bits that both words have: exact, with an AND and a bit count per pair. Distances and
sums of clusters follow from the planes, so rounds read the planes only, and what a round gives the
driver is one row of sums per cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.plans.staging import stored

DIM = 64
# A squared distance has to fit a LONG.
LARGEST = 2**63 - 1


def weights(planes: int) -> np.ndarray:
    """What a bit of each plane counts for; the last one is the sign."""
    return np.array([1 << j for j in range(planes - 1)] + [-(1 << (planes - 1))], np.int64)


def packed(values: np.ndarray, planes: int) -> np.ndarray:
    """Rows of 64 whole numbers as rows of planes."""
    words = [np.packbits((values >> j & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8") for j in range(planes)]
    return np.concatenate(words, axis=1)


def bits(words: np.ndarray) -> np.ndarray:
    """The bits of planes: row, plane, component."""
    rows, planes = words.shape
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(rows, planes, 8), axis=2, bitorder="little")


def unpacked(words: np.ndarray) -> np.ndarray:
    """``packed`` undone."""
    return np.einsum("rpc,p->rc", bits(words).astype(np.int64), weights(words.shape[1]))


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dot products of all rows of planes with all of a few others."""
    found, weight = np.zeros((len(a), len(b)), np.int64), weights(a.shape[1])
    for i, w in enumerate(weight):
        row = np.zeros_like(found)
        for j, v in enumerate(weight):
            row += v * np.bitwise_count(a[:, i, None] & b[None, :, j]).astype(np.int64)
        found += w * row
    return found


def nearest(words: np.ndarray, norms: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centroid, the first of equals, and its squared distance."""
    own = np.array([dots(c[None], c[None])[0, 0] for c in centroids])
    distance = norms[:, None] - 2 * dots(words, centroids) + own
    cluster = distance.argmin(axis=1)
    return cluster, distance[np.arange(len(words)), cluster]


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind)


def planes_of(vectors: DataFrame, scale: int, key: str, column: str) -> tuple[DataFrame, int]:
    """id, planes, norm (squared length) of every kept vector, as a stored table, and the number of planes."""
    given = F.col(column)
    fine = F.forall(given, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    kept = vectors.where(F.coalesce(F.size(given) == DIM, F.lit(False))).where(fine)
    numbers = F.transform(given, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    kept = kept.select(F.col(key).cast("long").alias("id"), numbers.alias("v"))
    low, high = kept.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    low, high = (0, 0) if low is None else (low, high)
    if DIM * (high - low) ** 2 > LARGEST or DIM * max(low * low, high * high) > LARGEST:
        raise ValueError(f"components from {low} to {high}: squared distances do not fit a LONG")
    planes = 1 + max(high.bit_length(), (-low - 1).bit_length(), 1)

    def rows(batches):
        for batch in batches:
            words = packed(_matrix(batch.column(1), DIM, np.int64), planes)
            norms = _norms(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), _listed(words), pa.array(norms)], ["id", "planes", "norm"])

    return stored(kept.mapInArrow(rows, "id long, planes array<long>, norm long"), "planes"), planes


def _norms(words: np.ndarray) -> np.ndarray:
    found, weight = np.zeros(len(words), np.int64), weights(words.shape[1])
    for i, w in enumerate(weight):
        for j, v in enumerate(weight):
            found += w * v * np.bitwise_count(words[:, i] & words[:, j]).astype(np.int64)
    return found


def _listed(words: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(0, words.size + 1, words.shape[1]), pa.int32())
    return pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(words).view(np.int64).ravel()))


def _sums(table: DataFrame, planes: int, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Of each cluster that has vectors: their number, inertia and sums, exact."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        totals = [[0, 0, [0] * DIM] for _ in centroids]
        for batch in batches:
            words = _matrix(batch.column(0), planes, np.int64).view(np.uint64)
            cluster, distance = nearest(words, batch.column(1).to_numpy(), centroids)
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                # The plane's bits are counted per component before they are weighted.
                counted = bits(words[mine]).sum(axis=0, dtype=np.int64)
                totals[c][0] += int(mine.sum())
                totals[c][1] += sum(distance[mine].tolist())
                totals[c][2] = [x + y for x, y in zip(totals[c][2], (weights(planes) @ counted).tolist())]
        found = [(c, n, str(inertia), [str(x) for x in sums]) for c, (n, inertia, sums) in enumerate(totals) if n]
        if found:
            yield pa.RecordBatch.from_pylist([dict(zip(("cluster", "n", "inertia", "sums"), row)) for row in found])

    read = table.select("planes", "norm").mapInArrow(rows, "cluster long, n long, inertia string, sums array<string>")
    exact = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(DIM)]
    read = read.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum(F.col("inertia").cast("decimal(38,0)")).alias("inertia"), *exact)
    return {row["cluster"]: (row["n"], int(row["inertia"]), [int(row[f"s{k}"]) for k in range(DIM)]) for row in read.collect()}


def cluster(vectors: DataFrame, clusters: int = 8, rounds: int = 10, scale: int = 1024, salt: str = "3:",
            key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id LONG, cluster INT, distance LONG (squared), cluster_inertia LONG, inertia LONG, centroid ARRAY<LONG>.

    Kept are vectors of exactly 64 components, none of them null, NaN or infinite; a component x becomes
    floor(scale * x). Centroids start as the vectors with the smallest sha256 of salt and id, move to the
    floors of their clusters' means ``rounds`` times, and an empty cluster's centroid stays. Of equal
    distances the smaller number wins. Repeated rows count each; a null id is kept and hashed as an empty
    one, equal hashes are ordered by the vectors themselves. Fewer vectors than clusters give fewer
    centroids; an empty table, or one without a kept vector, gives no rows. Components so large that a
    squared distance does not fit a LONG fail the job. Other columns are not read.
    """
    table, planes = planes_of(vectors, scale, key, column)
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    seeds = table.select("planes").orderBy(hashed, "planes").limit(clusters).collect()
    if not seeds:
        return table.selectExpr("id", "0 AS cluster", "norm AS distance", "0L AS cluster_inertia", "0L AS inertia", "planes AS centroid")
    centroids = unpacked(np.array([row["planes"] for row in seeds], np.int64).view(np.uint64))
    for _ in range(rounds):
        for c, (n, _, sums) in _sums(table, planes, packed(centroids, planes)).items():
            centroids[c] = [x // n for x in sums]
    words = packed(centroids, planes)
    inertia = {c: total for c, (_, total, _) in _sums(table, planes, words).items()}

    def rows(batches):
        for batch in batches:
            found, distance = nearest(_matrix(batch.column(1), planes, np.int64).view(np.uint64), batch.column(2).to_numpy(), words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int32()), pa.array(distance)], ["id", "cluster", "distance"])

    found = table.mapInArrow(rows, "id long, cluster int, distance long")
    each = F.array(*(F.lit(inertia.get(c, 0)).cast("long") for c in range(len(words))))
    places = F.array(*(F.array(*(F.lit(x).cast("long") for x in row)) for row in centroids.tolist()))
    return found.select("id", "cluster", "distance", each[F.col("cluster")].alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"), places[F.col("cluster")].alias("centroid"))
