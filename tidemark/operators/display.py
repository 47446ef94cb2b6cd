"""Indicators of the chart view. They follow other conventions than the feature table: Wilder
smoothing for RSI, and warm-up rows masked by a minimum number of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.series import (
    earlier_blocks, ema_memory, ema_parts, ema_value, gain, loss, over_blocks, rolling_blocks, shift,
)
from tidemark.operators.indicator import Indicator, Stage, add_indicators
from tidemark.operators.technical import BLOCK, FAST, SIGNAL, SLOW
from tidemark.operators.windows import recent_days
from tidemark.plans.series import Series, arrange, with_key_facts

# Days shown per time frame; None shows everything.
TIME_FRAMES = {"1W": 7, "1M": 30, "3M": 90, "6M": 180, "1Y": 365, "ALL": None}
MIN_ROWS, MIN_ROWS_MACD = 20, 26

WILDER = 1.0 / 14


def _close() -> Column:
    return F.col("close")


def _rsi_wilder(s: Series) -> list[Stage]:
    delta = _close() - F.col("_close_1_back")
    up, down = ema_value("up", WILDER), ema_value("down", WILDER)
    index = F.when(down == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + up / down))
    return [
        {"_close_1_back": shift(_close(), 1, s.w), "_position": s.position},
        {"_up": F.coalesce(gain(delta), F.lit(0.0)), "_down": F.coalesce(loss(delta), F.lit(0.0))},
        {**ema_parts("up", F.col("_up"), (WILDER,), s.w),
         **ema_parts("down", F.col("_down"), (WILDER,), s.w)},
        {"RSI": F.when(F.col("_position") >= 14, index)},
    ]


def _macd_display(s: Series) -> list[Stage]:
    macd = ema_value("close", FAST) - ema_value("close", SLOW)
    return [
        {**ema_parts("close", _close(), (FAST, SLOW), s.w), "_position": s.position},
        {"MACD": F.when(F.col("_position") >= 26, macd)},
        ema_parts("macd", F.col("MACD"), (SIGNAL,), s.w),
        {"MACD_Signal": F.when(F.col("_position") >= 26 + 9 - 1, ema_value("macd", SIGNAL))},
    ]


rsi_wilder = Indicator(("RSI",), ("close",), _rsi_wilder, before=ema_memory(WILDER) + 1)
macd_display = Indicator(
    ("MACD", "MACD_Signal"), ("close",), _macd_display,
    before=ema_memory(SLOW) + ema_memory(SIGNAL))
simple_average = Indicator(
    ("SMA_20",), ("close",), lambda s: [
        rolling_blocks(F.avg, "close", _close(), BLOCK, s.w),
        {},
        earlier_blocks(F.avg, "close", 20, BLOCK, s.w),
        {"SMA_20": over_blocks(F.avg, "close", 20, BLOCK)},
    ], before=19)

CHART = (simple_average, rsi_wilder, macd_display)


def time_frame(bars: DataFrame, frame: str, companies: list[str] | None = None,
               key: str = "company", order: str = "dt") -> DataFrame:
    """The chosen companies' rows within a preset number of days of each one's newest row."""
    days = TIME_FRAMES[frame]
    if companies is not None:
        bars = bars.where(F.col(key).isin(companies))
    return bars if days is None else recent_days(bars, days, key, order)


def time_frames(bars: DataFrame, frames: Sequence[str] = tuple(TIME_FRAMES), companies: list[str] | None = None,
                key: str = "company", order: str = "dt") -> DataFrame:
    """The rows of several preset frames, each under its name in ``frame``; a company's newest row is looked for once."""
    if companies is not None:
        bars = bars.where(F.col(key).isin(companies))
    known = with_key_facts(bars, [key], order, [F.max(order).alias("_top")], {"_newest": lambda w: F.max("_top").over(w)})

    def inside(name: str) -> Column:
        days = TIME_FRAMES[name]
        shown = F.lit(True) if days is None else F.col(order) >= F.col("_newest") - F.expr(f"INTERVAL '{days}' DAY")
        return F.when(shown, F.lit(name))

    return known.withColumn("frame", F.explode(F.array_compact(F.array(*map(inside, frames))))).drop("_newest")


def chart_series(bars: DataFrame, frame: str = "ALL", companies: list[str] | None = None,
                 key: str = "company", order: str = "dt", **layout) -> DataFrame:
    """OHLC with the chart's indicator lines, computed on the visible rows only.

    Companies with too few visible rows get no lines, or no MACD lines.
    """
    visible = time_frame(bars, frame, companies, key, order)
    series = arrange(visible, key, order, before=max(i.before for i in CHART), **layout)
    lines = add_indicators(series.rows.withColumn("_rows", series.size), series, CHART)
    kept = {name: _if_long_enough(name, MIN_ROWS) for name in ("SMA_20", "RSI")}
    kept |= {name: _if_long_enough(name, MIN_ROWS_MACD) for name in ("MACD", "MACD_Signal")}
    return series.trim(lines.withColumns(kept)).drop("_rows")


def _if_long_enough(name: str, rows: int) -> Column:
    return F.when(F.col("_rows") >= rows, F.col(name))
