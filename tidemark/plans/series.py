"""Ordered series that never put more than a fixed number of rows into one task.

A window over ``partitionBy(company)`` sorts a whole company in one task, which fails as soon
as one company holds a large share of the data. ``arrange`` counts the rows per key first
(partial counts are combined before the shuffle):

* if no key holds more than ``segment_rows`` rows, the plain window is within its bound;
* otherwise the long keys are cut into time-ordered segments of about ``segment_rows`` rows.
  The rows a segment needs from its neighbours (``before`` rows of history, ``after`` rows of
  future) are copied into it, so every row still sees exactly the frame it would see in the
  uncut series, and the copies are dropped again by ``trim``.

Segments are unions of time slices, so the rows are shuffled once, by (key, segment). The slice
table of the long keys is written to the shared scratch folder: Catalyst then knows its size
and broadcasts it only when it is below the session's broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window, WindowSpec

from tidemark.session import scratch_folder

SEGMENT_ROWS = 20_000

_SEGMENT, _OWN, _SLICE, _TARGETS = "_segment", "_own_segment", "_slice", "_targets"
_ROWS_BEFORE, _ROWS_TOTAL = "_rows_before", "_rows_total"


@dataclass(frozen=True)
class Series:
    """Rows arranged for window functions, with the window to use on them."""

    rows: DataFrame
    keys: tuple[str, ...]
    order: str
    cut: bool

    @property
    def _partition(self) -> list[str]:
        return [*self.keys, _SEGMENT] if self.cut else list(self.keys)

    @cached_property
    def w(self) -> WindowSpec:
        return Window.partitionBy(*self._partition).orderBy(self.order)

    @property
    def position(self) -> Column:
        """1-based place of the row in its whole series."""
        local = F.row_number().over(self.w).cast("long")
        if not self.cut:
            return local
        running = self.w.rowsBetween(Window.unboundedPreceding, 0)
        return local + F.first(_ROWS_BEFORE).over(running)

    @property
    def size(self) -> Column:
        """Number of rows of the whole series."""
        local = F.count(F.lit(1)).over(Window.partitionBy(*self._partition))
        return F.coalesce(F.col(_ROWS_TOTAL), local) if self.cut else local

    def trim(self, df: DataFrame) -> DataFrame:
        """Drop the copied rows and the helper columns."""
        if not self.cut:
            return df
        kept = df.where(F.col(_SEGMENT) == F.col(_OWN))
        return kept.drop(_SEGMENT, _OWN, _SLICE, _ROWS_BEFORE, _ROWS_TOTAL)


def arrange(df: DataFrame, keys: str | Sequence[str] = "company", order: str = "dt",
            before: int = 0, after: int = 0, segment_rows: int = SEGMENT_ROWS,
            slice_minutes: int | None = None) -> Series:
    """Prepare ``df`` for windows that look ``before`` rows back and ``after`` rows ahead.

    (keys, order) must identify a row. ``slice_minutes`` is the width of a time slice, 32 days for
    dates and one day for timestamps by default. Where a slice of a long key holds more rows than
    fit into a segment, slices are made narrower until none does, down to single microseconds.
    """
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    long_keys = df.groupBy(*keys).count().where(F.col("count") > segment_rows)
    if long_keys.isEmpty():
        return Series(df, keys, order, cut=False)

    limit = segment_rows - max(before, after)
    if limit <= 0:
        raise ValueError("segment_rows must be larger than the rows looked back or ahead")
    width = _width(df, order, slice_minutes)
    while True:
        sliced = df.withColumn(_SLICE, _slice_of(df, order, width))
        most = sliced.where(F.col(order).isNotNull()).groupBy(*keys, _SLICE).count().agg(F.max("count")).first()[0]
        if most is None or most <= limit or width == 1:
            break
        width = max(1, int(width * limit / most) // 2)
    spark = df.sparkSession
    path = scratch_folder(spark, "slices")
    _slice_table(sliced, keys, before, after, segment_rows).write.parquet(path)
    targets = F.coalesce(F.col(_TARGETS), F.array(F.lit(0).cast("long")))
    rows = (
        sliced.join(spark.read.parquet(path), [*keys, _SLICE], "left")
        .withColumns({
            _SEGMENT: F.explode(targets),
            _OWN: F.coalesce(F.col(_OWN), F.lit(0).cast("long")),
            _ROWS_BEFORE: F.coalesce(F.col(_ROWS_BEFORE), F.lit(0).cast("long")),
        })
        .drop(_TARGETS)
    )
    return Series(rows, keys, order, cut=True)


def time_slice(df: DataFrame, order: str, slice_minutes: int | None = None) -> Column:
    """Number of the time slice a row falls into: 32 days for dates, one day for timestamps."""
    return _slice_of(df, order, _width(df, order, slice_minutes))


def _width(df: DataFrame, order: str, slice_minutes: int | None) -> int:
    """Width of a slice in microseconds."""
    is_date = isinstance(df.schema[order].dataType, T.DateType)
    return (slice_minutes or (32 * 1440 if is_date else 1440)) * 60_000_000


def _slice_of(df: DataFrame, order: str, width: int) -> Column:
    # Whole division: the quotient of two large numbers as floating point would mix up neighbours.
    micros = _micros(df, order)
    return ((micros - F.pmod(micros, F.lit(width))) / width).cast("long")


def with_key_facts(df: DataFrame, keys: Sequence[str], order: str, per_slice: Sequence[Column],
                   per_key: dict[str, Callable[[WindowSpec], Column]]) -> DataFrame:
    """Adds facts about a row's whole key (such as its newest day) to each row.

    Joining a table of keys to the rows would bring all rows of a long key to one task. Here the
    facts are aggregated per (key, time slice), combined over the slices of a key on that short
    table, and joined back by (key, time slice), of which none is large. ``per_slice`` are the
    aggregates of a slice and ``per_key`` the window expressions that combine them.
    """
    keys = [*keys, _SLICE]
    sliced = df.withColumn(_SLICE, time_slice(df, order))
    by_key = Window.partitionBy(*keys[:-1])
    slices = sliced.groupBy(*keys).agg(*per_slice)
    facts = slices.select(*(F.col(k).alias(f"_of_{k}") for k in keys), *(combine(by_key).alias(n) for n, combine in per_key.items()))
    # Rows whose key or time is NULL belong together and keep their place.
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    return sliced.join(facts, same).drop(_SLICE, *(f"_of_{k}" for k in keys))


def _micros(df: DataFrame, order: str) -> Column:
    """Microseconds since the epoch, growing with ``order`` in every time zone."""
    kind, value = df.schema[order].dataType, F.col(order)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long") * 86_400_000_000
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value.cast("timestamp_ntz"))


def _slice_table(sliced: DataFrame, keys: tuple[str, ...], before: int, after: int,
                 segment_rows: int) -> DataFrame:
    """For each slice of a long key: its own segment, all segments that need its rows, and the
    number of rows of the key before it."""
    by_key = Window.partitionBy(*keys)
    running = by_key.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, 0)
    own = Window.partitionBy(*keys, _OWN)
    too_dense = F.raise_error(F.concat(
        F.lit("more rows of one key at one time than fit into a segment; (keys, order) must identify a row. Rows: "),
        F.col("count").cast("string")))
    start, end = F.min(_ROWS_BEFORE).over(own), F.max("_rows_after").over(own)
    needed = F.array(
        F.col(_OWN),
        # History of the next segment, and future of the previous one.
        F.when((F.col("_rows_after") > end - before) & (end < F.col(_ROWS_TOTAL)), F.col(_OWN) + 1),
        F.when((F.col(_ROWS_BEFORE) < start + after) & (F.col(_OWN) > 0), F.col(_OWN) - 1),
    )
    return (
        sliced.groupBy(*keys, _SLICE).count()
        .withColumns({"_rows_after": F.sum("count").over(running),
                      _ROWS_TOTAL: F.sum("count").over(by_key)})
        .where(F.col(_ROWS_TOTAL) > segment_rows)
        .withColumn("count", F.when(F.col("count") > segment_rows - max(before, after), too_dense.cast("long")).otherwise(F.col("count")))
        .withColumn(_ROWS_BEFORE, F.col("_rows_after") - F.col("count"))
        .withColumn(_OWN, F.floor(F.col(_ROWS_BEFORE) / segment_rows))
        .withColumn(_TARGETS, F.array_compact(needed))
        .select(*keys, _SLICE, _OWN, _TARGETS, _ROWS_BEFORE, _ROWS_TOTAL)
    )


def over_series(df: DataFrame, build: Callable[[Series], DataFrame], **layout) -> DataFrame:
    """Arrange ``df``, add columns with ``build`` and drop the copied rows again."""
    series = arrange(df, **layout)
    return series.trim(build(series))
