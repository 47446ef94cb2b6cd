"""Column builders for ordered series.

Every builder takes a window ``w`` that is partitioned and ordered but has no frame, and
returns a Column. Missing values are NULL throughout.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, functions as F
from pyspark.sql.window import Window, WindowSpec

# Weights below this share of the newest one do not change a double any more.
NEGLIGIBLE_WEIGHT = 1e-17


def finite(x: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def rolling(agg, x: Column, n: int, w: WindowSpec) -> Column:
    """``agg`` over the last ``n`` rows, NULL unless all ``n`` of them hold a value."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(frame) == n, agg(x).over(frame))


def rolling_blocks(agg: Callable, name: str, x: Column, size: int, w: WindowSpec) -> dict[str, Column]:
    """Helper columns about the last ``size`` rows of ``x``, the first step towards a longer rolling window.

    For every row Spark goes through all rows of a sliding frame again, which makes long frames dear. So a
    window of n rows is put together from the blocks that end 0, ``size``, 2 * ``size``, ... rows
    back: ``rolling_blocks``, then ``earlier_blocks`` and ``over_blocks``, each a stage of its own.
    """
    if agg is F.stddev_samp:
        return {**rolling_blocks(F.sum, name, x, size, w), f"_{name}_squares_{size}": rolling(F.var_samp, x, size, w) * (size - 1)}
    return {block: rolling(F.sum if agg is F.avg else agg, x, size, w) for block in _blocks(agg, name, size)}


def earlier_blocks(agg: Callable, name: str, n: int, size: int, w: WindowSpec) -> dict[str, Column]:
    """Helper columns with the earlier blocks of a window of ``n`` rows."""
    if n % size:
        raise ValueError(f"{n} rows are no whole number of blocks of {size}")
    return {f"{block}_{back}_back": shift(F.col(block), back, w) for block in _blocks(agg, name, size) for back in range(size, n, size)}


def over_blocks(agg: Callable, name: str, n: int, size: int) -> Column:
    """``rolling`` over ``n`` rows from their blocks; ``agg`` is sum, avg, min, max or stddev_samp."""
    first, *rest = ([F.col(block), *(F.col(f"{block}_{back}_back") for back in range(size, n, size))]
                    for block in _blocks(agg, name, size))
    if agg in (F.min, F.max):
        # ``least`` and ``greatest`` would skip a missing block.
        return F.when(reduce(and_, (block.isNotNull() for block in first)), (F.least if agg is F.min else F.greatest)(*first))
    if agg is F.stddev_samp:
        # Squares inside the blocks, and those of the blocks' means about the mean of all.
        return F.sqrt((reduce(add, rest[0]) + _squares(first) / size) / (n - 1))
    return reduce(add, first) if agg is F.sum else reduce(add, first) / n


def _blocks(agg: Callable, name: str, size: int) -> list[str]:
    kinds = {F.sum: ["sum"], F.avg: ["sum"], F.min: ["min"], F.max: ["max"], F.stddev_samp: ["sum", "squares"]}
    return [f"_{name}_{kind}_{size}" for kind in kinds[agg]]


def _squares(values: Sequence[Column]) -> Column:
    """Sum of squared differences from the mean, taken from the first value so that large values lose no digits."""
    moved = [v - values[0] for v in values[1:]]
    total = reduce(add, moved)
    return reduce(add, (d * d for d in moved)) - total * total / len(values)


def shift(x: Column, n: int, w: WindowSpec) -> Column:
    """The value ``n`` rows earlier; a negative ``n`` looks ahead."""
    return F.lag(x, n).over(w) if n >= 0 else F.lead(x, -n).over(w)


def relative_change(now: Column, before: Column, inf_to_null: bool = False) -> Column:
    """``now / before - 1``. A zero base gives a signed infinity (0/0 gives NULL)."""
    from_zero = F.when((now == 0) | inf_to_null, None).otherwise(F.signum(now) * float("inf"))
    return F.when(before == 0, from_zero).otherwise(now / before - 1)


def gain(delta: Column) -> Column:
    """Upward part of a move; NULL stays NULL (``greatest`` alone would skip it)."""
    return F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0)))


def loss(delta: Column) -> Column:
    """Downward part of a move as a non-negative number; NULL stays NULL."""
    return F.when(delta.isNotNull(), F.greatest(-delta, F.lit(0.0)))


def span_to_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def ema_memory(alpha: float) -> int:
    """Rows after which an older value has no weight left in the recursive mean."""
    return math.ceil(math.log(NEGLIGIBLE_WEIGHT) / math.log(1.0 - alpha))


def _weighted_mean(x: Column, alpha: float) -> Column:
    """Spark's own window function behind ``ewm`` in the pandas API."""
    try:
        from pyspark.sql.internal import InternalFunction as spark_functions  # Spark 4.1
    except ImportError:
        from pyspark.pandas.spark import functions as spark_functions  # Spark 3.4 - 4.0
    return spark_functions.ewm(x, alpha, False)


def _mean_name(name: str, alpha: float) -> str:
    return f"_{name}_mean_{round(alpha * 1e9)}"


def ema_parts(name: str, x: Column, alphas: Iterable[float], w: WindowSpec) -> dict[str, Column]:
    """Window expressions that ``ema_value`` turns into recursive exponential means of ``x``.

    ``x`` may be NULL only before its first value. All parts are running window expressions, so
    they are computed in the same pass as every other indicator.
    """
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return {
        f"_{name}_rows": F.count(x).over(running),
        f"_{name}_first": F.first(x, ignorenulls=True).over(running),
        **{_mean_name(name, alpha): _weighted_mean(x, alpha).over(w) for alpha in alphas},
    }


def ema_value(name: str, alpha: float) -> Column:
    """Recursive exponential mean: y0 = x0, y = alpha * x + (1 - alpha) * previous y.

    Spark's function normalises by the sum of the weights; with k rows since the first value,
    giving that value the weight (1 - alpha)^k which the recursion leaves on it turns one form
    into the other.
    """
    mean, first = F.col(_mean_name(name, alpha)), F.col(f"_{name}_first")
    left_on_first = F.exp(F.col(f"_{name}_rows") * math.log(1.0 - alpha))
    return mean + (first - mean) * left_on_first
