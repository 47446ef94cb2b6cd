"""Recursive means over series of any length, as a scan of affine maps.

A recursive mean takes a row's value into a state: ``state = (1 - alpha) * state + alpha * value``. What
a run of rows does to the state is then one affine map, ``state -> factor * state + offset``, and maps of
neighbouring runs combine into one. So nothing is copied from segment to segment, whatever the span:

* inside a segment the mean is computed as if the state before it were zero;
* the segments' maps, one short row each, are combined along the series by doubling: after k steps each
  row holds the map of the 2^k segments up to it, so the number of steps is the logarithm of the number
  of segments;
* every row adds what its segment's incoming state has left over.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.series import span_to_alpha
from tidemark.plans.series import SEGMENT_ROWS, Series, arrange
from tidemark.plans.staging import stored

# Powers of ten that the weights may span on either side of one.
DECADES = 280


def longest_segment(alpha: float) -> int:
    """Rows of a segment whose weights stay far inside the range of a double, also if its last slice doubles it."""
    return max(2, int(DECADES * math.log(10) / -math.log1p(-alpha)))


def _power(base: float, exponent: Column) -> Column:
    return F.exp(exponent * math.log(base))


def scanned(maps: DataFrame, keys: Sequence[str], order: str, factor: str = "factor", offset: str = "offset") -> DataFrame:
    """``maps`` with factor and offset replaced by those of all maps of the key up to and including the row.

    One row is one affine map; (keys, order) identify it. The table is read several times: store it first.
    A key's maps share a task, which is meant for summaries: one row stands for thousands.
    """
    longest = maps.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    w, reach = Window.partitionBy(*keys).orderBy(order), 1
    while reach < longest:
        before = {"_factor": F.lag(factor, reach).over(w), "_offset": F.lag(offset, reach).over(w)}
        maps = maps.withColumns(before).withColumns({
            offset: F.when(F.col("_factor").isNull(), F.col(offset)).otherwise(F.col(factor) * F.col("_offset") + F.col(offset)),
            factor: F.when(F.col("_factor").isNull(), F.col(factor)).otherwise(F.col(factor) * F.col("_factor")),
        }).drop("_factor", "_offset")
        reach *= 2
    return maps


def recursive_mean(df: DataFrame, value: str, name: str, *, span: int | None = None, alpha: float | None = None,
                   keys: str | Sequence[str] = "company", order: str = "dt", segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Adds ``name``: y0 = x0, then y = alpha * x + (1 - alpha) * the previous y, over each key's rows in order.

    ``alpha``, between 0 and 1, is given or follows from the ``span`` as 2 / (span + 1). Rows before the
    first value get NULL, and a later row without a value keeps the mean of the row before it. Series
    longer than ``segment_rows`` are cut; the result is that of the uncut series, for any span.
    """
    if (span is None) == (alpha is None):
        raise ValueError("give either a span or alpha")
    alpha = span_to_alpha(span) if alpha is None else alpha
    if not 0 < alpha < 1:
        raise ValueError("alpha must lie between 0 and 1")
    keys = [keys] if isinstance(keys, str) else list(keys)
    limit = min(segment_rows, longest_segment(alpha))
    series = arrange(df, keys, order, segment_rows=limit)
    local = _local_means(series, F.col(value).cast("double"), alpha, limit)
    left = _power(1.0 - alpha, F.col("_seen"))
    if not series.cut:
        return local.withColumn(name, F.when(F.col("_seen") > 0, F.col("_local") + left * F.col("_first"))).drop(*_HELPERS)
    states = _incoming(local, keys, order, alpha)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys, "_segment"]))
    joined = local.join(states, same, "left")
    mean = F.when((F.col("_seen") > 0) | F.col("_started"), F.coalesce("_local", F.lit(0.0)) + left * F.col("_state"))
    return series.trim(joined.withColumn(name, mean)).drop(*_HELPERS, *(f"_of_{k}" for k in [*keys, "_segment"]), "_state", "_started")


_HELPERS = ("_local", "_first", "_seen")


def _local_means(series: Series, x: Column, alpha: float, limit: int) -> DataFrame:
    """Per row the values seen in its segment, their first, and their mean from a state of zero.

    The powers are taken relative to the row number ``limit``, so that none leaves the range of a double.
    """
    running = series.w.rowsBetween(Window.unboundedPreceding, 0)
    counted = series.rows.withColumns({"_seen": F.count(x).over(running), "_first": F.first(x, ignorenulls=True).over(running)})
    place = F.col("_seen") - limit
    weighted = F.sum(x * _power(1.0 - alpha, -place)).over(running)
    return counted.withColumn("_local", alpha * weighted * _power(1.0 - alpha, place))


def _incoming(local: DataFrame, keys: list[str], order: str, alpha: float) -> DataFrame:
    """Per key and segment the state in front of it, and whether any value came before it."""
    by = [*keys, "_segment"]
    maps = local.groupBy(*by).agg(
        F.max("_seen").alias("_values"), F.max_by("_local", F.when(F.col("_local").isNotNull(), F.col(order))).alias("_end"),
        F.any_value("_first", ignoreNulls=True).alias("_start"))
    maps = stored(maps.select(*by, "_values", "_start", _power(1.0 - alpha, F.col("_values")).alias("factor"),
                              F.coalesce("_end", F.lit(0.0)).alias("offset")), "segment_maps")
    w = Window.partitionBy(*keys).orderBy("_segment")
    first = F.first("_start", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = scanned(maps, keys, "_segment").withColumn("_start", first)
    after = after.withColumn("_after", F.col("factor") * F.col("_start") + F.col("offset"))
    before = F.sum("_values").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return after.select(
        *(F.col(k).alias(f"_of_{k}") for k in by), F.coalesce(F.lag("_after").over(w), F.col("_start")).alias("_state"),
        (F.coalesce(before, F.lit(0)) > 0).alias("_started"))
