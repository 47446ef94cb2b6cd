"""Sequences of past rows, stored once.

A table of sequences holds every row as often as a sequence is long. Here a series is stored as chunks:
one row per chunk, one array per column, each chunk headed by the ``lookback`` rows in front of it. A
sequence is then a place in a chunk, and a reader sees all sequences of a chunk as one strided view of
its arrays, without copying a row. Feature sets are choices of columns of the same store.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.series import SEGMENT_ROWS, arrange

# Columns of a store besides its keys, order and values.
LAYOUT = ("chunk", "first", "halo", "total")


def sequence_store(df: DataFrame, features: Sequence[str], target: str = "Future_Return", lookback: int = 60,
                   keys: str | Sequence[str] = "company", order: str = "dt", chunk_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row per chunk of a series: keys, chunk, first (place in the series of the chunk's first row, from 0), halo
    (rows in front of the chunk's own), total (rows of the series), and ``order``, every feature and
    ``target`` as arrays in time order.

    A series of at most ``chunk_rows`` rows is one chunk. Longer ones are cut, and the halo adds
    ``lookback`` rows to each chunk: at the default size well below a hundredth.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    values = list(dict.fromkeys([*features, target]))
    if clash := set(LAYOUT) & {*names, order, *values}:
        raise ValueError(f"names of the store's own columns: {sorted(clash)}")
    narrow = df.select(*names, order, *(F.col(v).cast("double").alias(v) for v in values))
    series = arrange(narrow, names, order, before=lookback, segment_rows=chunk_rows)
    rows = F.sort_array(F.collect_list(F.struct(order, *values)))
    if series.cut:
        own = F.col("_segment") == F.col("_own_segment")
        # The key of a short series is cut nowhere and has no total.
        chunks = series.rows.groupBy(*names, F.col("_segment").alias("chunk")).agg(
            rows.alias("rows"), F.min(F.when(own, F.col("_rows_before"))).alias("start"), F.count_if(own).alias("own"),
            F.max("_rows_total").alias("total"))
    else:
        chunks = series.rows.groupBy(*names).agg(
            rows.alias("rows"), F.lit(0).cast("long").alias("start"), F.count(F.lit(1)).alias("own"), F.lit(None).cast("long").alias("total"))
        chunks = chunks.withColumn("chunk", F.lit(0).cast("long"))
    halo = F.least(F.size("rows") - F.col("own"), F.lit(lookback)).cast("int")
    chunks = chunks.withColumn("halo", halo)
    kept = F.slice("rows", (F.size("rows") - F.col("own") - F.col("halo") + 1).cast("int"), (F.col("own") + F.col("halo")).cast("int"))
    chunks = chunks.withColumn("rows", kept)
    return chunks.select(*names, "chunk", (F.col("start") - F.col("halo")).alias("first"), "halo", F.coalesce("total", "own").alias("total"),
                         *(F.col(f"rows.{name}").alias(name) for name in (order, *values)))


@dataclass(frozen=True)
class Chunk:
    """The sequences of one chunk. ``x`` is a view of shape (sequence, step, feature), the oldest step first."""

    row: dict
    kinds: dict[str, pa.DataType]
    first: int
    total: int
    times: pa.Array
    x: np.ndarray
    y: np.ndarray
    matrix: np.ndarray

    @property
    def places(self) -> np.ndarray:
        """The places in the series of the rows that the sequences lead to."""
        return self.first + np.arange(len(self.y))


def chunk_of(row: dict, features: Sequence[str], target: str, lookback: int, times: pa.Array, kinds: dict[str, pa.DataType] | None = None) -> Chunk:
    """One row of a store as sequences: ``row`` has its arrays and ``times`` the array of its order."""
    matrix = np.column_stack([np.asarray(row[name], np.float64) for name in features])
    count = max(0, len(matrix) - lookback)
    windows = sliding_window_view(matrix, lookback, axis=0)[:count] if count else np.empty((0, matrix.shape[1], lookback))
    return Chunk(row, kinds or {}, row["first"] + lookback, row["total"], times.slice(lookback), windows.transpose(0, 2, 1),
                 np.asarray(row[target], np.float64)[lookback:], matrix)


def map_sequences(store: DataFrame, reader: Callable[[Chunk], Iterable[pa.RecordBatch]], schema, features: Sequence[str],
                  target: str = "Future_Return", lookback: int = 60, order: str = "dt", carried: Sequence[str] = ("company",)) -> DataFrame:
    """What ``reader`` makes of every chunk of a store.

    Only the named features are read. ``carried`` columns stand in the chunk's ``row``, their types in its ``kinds``. A chunk's sequences
    are a view of its arrays, so a reader holds a chunk's rows and not ``lookback`` times as many.
    """
    arrays = list(dict.fromkeys([*features, target]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {name: batch.column(at) for at, name in enumerate(batch.schema.names)}
            kinds = {name: column.type for name, column in columns.items()}
            for at in range(batch.num_rows):
                row = {name: columns[name][at].as_py() for name in dict.fromkeys([*carried, *LAYOUT])}
                row |= {name: columns[name][at].values.to_numpy(zero_copy_only=False) for name in arrays}
                yield from reader(chunk_of(row, features, target, lookback, columns[order][at].values, kinds))

    return store.select(*dict.fromkeys([*carried, *LAYOUT, order, *arrays])).mapInArrow(rows, schema)


def expanded(store: DataFrame, features: Sequence[str], target: str = "Future_Return", lookback: int = 60,
             keys: str | Sequence[str] = "company", order: str = "dt") -> DataFrame:
    """The sequences of a store as rows: keys, order, position (from 1), size, sequence and target.

    For learners that want a table of sequences; it is made while it is read and need not be stored.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    at = F.col("at")

    def step(place: Column) -> Column:
        return F.array(*(F.get(name, place) for name in features))

    places = F.when(F.size(order) > lookback, F.sequence(F.lit(lookback), F.size(order) - 1)).otherwise(F.array().cast("array<int>"))
    found = store.select(*names, *LAYOUT, order, *dict.fromkeys([*features, target]), F.explode(places).alias("at"))
    sequence = F.transform(F.sequence(at - lookback, at - 1), step)
    return found.select(*names, F.get(order, at).alias(order), (F.col("first") + at - lookback + 1).alias("position"),
                        (F.col("total") - lookback).alias("size"), sequence.alias("sequence"), F.get(target, at).alias("target"))
