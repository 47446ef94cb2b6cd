"""Technical indicators over price bars (company, dt, open, high, low, close, volume)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.series import (
    earlier_blocks, ema_memory, ema_parts, ema_value, finite, gain, loss, over_blocks, relative_change, rolling,
    rolling_blocks, shift, span_to_alpha,
)
from tidemark.operators.indicator import Indicator, Stage
from tidemark.plans.scan import recursive_mean
from tidemark.plans.series import Series

# Keeps a ratio defined when its denominator is zero.
EPSILON = 1e-9

# Rows looked back by returns and momentum, and the spans of the MACD.
RETURN_PERIODS = (1, 3, 5, 10)
FAST, SLOW, SIGNAL = (span_to_alpha(span) for span in (12, 26, 9))

# Rows per block of the rolling windows of 14 rows, and of the others.
HALF_14, BLOCK = 7, 5


def _close() -> Column:
    return F.col("close")


def _ratio(top: Column, bottom: Column) -> Column:
    return top / (bottom + EPSILON)


def _earlier(name: str, periods: int, s: Series) -> Stage:
    """Helper column with the value ``periods`` rows earlier, named alike wherever it is used."""
    return {f"_{name}_{periods}_back": shift(F.col(name), periods, s.w)}


def _mean_of_close(s: Series, *sizes: int) -> list[Stage]:
    return [
        rolling_blocks(F.avg, "close", _close(), BLOCK, s.w),
        {},
        earlier_blocks(F.avg, "close", max(sizes), BLOCK, s.w),
        {f"MA_{n}": over_blocks(F.avg, "close", n, BLOCK) for n in sizes},
    ]


def _exponential_averages(s: Series) -> list[Stage]:
    return [
        ema_parts("close", _close(), (FAST, SLOW), s.w),
        {"EMA_12": ema_value("close", FAST), "EMA_26": ema_value("close", SLOW)},
    ]


def _one_day_delta() -> Column:
    return _close() - F.col("_close_1_back")


def _macd(s: Series) -> list[Stage]:
    return [
        ema_parts("close", _close(), (FAST, SLOW), s.w),
        {"MACD": ema_value("close", FAST) - ema_value("close", SLOW)},
        ema_parts("macd", F.col("MACD"), (SIGNAL,), s.w),
        {"MACD_Signal": ema_value("macd", SIGNAL),
         "MACD_Hist": F.col("MACD") - ema_value("macd", SIGNAL)},
    ]


def _rsi(s: Series) -> list[Stage]:
    ups, downs = (over_blocks(F.avg, name, 14, HALF_14) for name in ("gain", "loss"))
    return [
        _earlier("close", 1, s),
        {"_gain": gain(_one_day_delta()), "_loss": loss(_one_day_delta())},
        {**rolling_blocks(F.avg, "gain", F.col("_gain"), HALF_14, s.w),
         **rolling_blocks(F.avg, "loss", F.col("_loss"), HALF_14, s.w)},
        {},
        {},
        {**earlier_blocks(F.avg, "gain", 14, HALF_14, s.w), **earlier_blocks(F.avg, "loss", 14, HALF_14, s.w)},
        {"RSI": 100 - 100 / (1 + _ratio(ups, downs))},
    ]


def _bollinger(s: Series) -> list[Stage]:
    middle, spread = F.col("MA_20"), F.col("BB_Std")
    upper, lower = middle + 2 * spread, middle - 2 * spread
    return [
        rolling_blocks(F.stddev_samp, "close", _close(), BLOCK, s.w),
        {},
        earlier_blocks(F.stddev_samp, "close", 20, BLOCK, s.w),
        {"MA_20": over_blocks(F.avg, "close", 20, BLOCK), "BB_Std": over_blocks(F.stddev_samp, "close", 20, BLOCK)},
        {
            "BB_Mid": middle,
            "BB_Upper": upper,
            "BB_Lower": lower,
            "BB_Width": _ratio(upper - lower, middle),
            "BB_Pos": _ratio(_close() - lower, upper - lower),
        },
    ]


def _returns(s: Series) -> list[Stage]:
    lags: Stage = {}
    moves: Stage = {}
    for periods in RETURN_PERIODS:
        lags.update(_earlier("close", periods, s))
        base = F.col(f"_close_{periods}_back")
        moves[f"Return_{periods}"] = relative_change(_close(), base)
        moves[f"Momentum_{periods}"] = _close() - base
    return [lags, moves]


def _volatility(s: Series) -> list[Stage]:
    return [
        _earlier("close", 1, s),
        {"_move": finite(relative_change(_close(), F.col("_close_1_back")))},
        rolling_blocks(F.stddev_samp, "move", F.col("_move"), BLOCK, s.w),
        {},
        {},
        earlier_blocks(F.stddev_samp, "move", 20, BLOCK, s.w),
        {f"Vol_{n}": over_blocks(F.stddev_samp, "move", n, BLOCK) for n in (10, 20)},
    ]


def _true_range() -> Column:
    high, low, prior = F.col("high"), F.col("low"), F.col("_close_1_back")
    known = high.isNotNull() & low.isNotNull() & prior.isNotNull()
    return F.when(known, F.greatest(high - low, F.abs(high - prior), F.abs(low - prior)))


def _atr(s: Series) -> list[Stage]:
    return [
        _earlier("close", 1, s),
        {"_true_range": _true_range()},
        rolling_blocks(F.avg, "true_range", F.col("_true_range"), HALF_14, s.w),
        {},
        {},
        earlier_blocks(F.avg, "true_range", 14, HALF_14, s.w),
        {"ATR_14": over_blocks(F.avg, "true_range", 14, HALF_14)},
    ]


def _price_ratios(s: Series) -> list[Stage]:
    short, middle, long = F.col("MA_10"), F.col("MA_20"), F.col("MA_50")
    return [
        *_mean_of_close(s, 10, 20, 50),
        {
            "Price_vs_MA20": _ratio(_close() - middle, middle),
            "Price_vs_MA50": _ratio(_close() - long, long),
            "MA_spread": _ratio(short - middle, middle),
        },
    ]


def _volume(s: Series) -> list[Stage]:
    volume = F.col("volume")
    return [
        {**rolling_blocks(F.avg, "volume", volume, BLOCK, s.w), **_earlier("volume", 1, s)},
        {},
        earlier_blocks(F.avg, "volume", 10, BLOCK, s.w),
        {"Volume_MA10": over_blocks(F.avg, "volume", 10, BLOCK)},
        {
            "Volume_Ratio": _ratio(volume, F.col("Volume_MA10")),
            "Volume_Change": relative_change(volume, F.col("_volume_1_back")),
        },
    ]


def _stochastic(s: Series) -> list[Stage]:
    floor, ceiling = F.col("_low_14"), F.col("_high_14")
    return [
        {**rolling_blocks(F.min, "low", F.col("low"), HALF_14, s.w),
         **rolling_blocks(F.max, "high", F.col("high"), HALF_14, s.w)},
        {},
        {**earlier_blocks(F.min, "low", 14, HALF_14, s.w), **earlier_blocks(F.max, "high", 14, HALF_14, s.w)},
        {"_low_14": over_blocks(F.min, "low", 14, HALF_14), "_high_14": over_blocks(F.max, "high", 14, HALF_14)},
        {"Stoch_K": _ratio(100 * (_close() - floor), ceiling - floor)},
        {"Stoch_D": rolling(F.avg, F.col("Stoch_K"), 3, s.w)},
    ]


def _candles(_: Series) -> list[Stage]:
    body = _close() - F.col("open")
    return [
        {},
        {"Candle_Body": F.abs(body), "Candle_Range": F.col("high") - F.col("low"),
         "Candle_Dir": F.signum(body)},
    ]


moving_averages = Indicator(
    ("MA_10", "MA_20", "MA_50"), ("close",), lambda s: _mean_of_close(s, 10, 20, 50), before=49)
exponential_averages = Indicator(
    ("EMA_12", "EMA_26"), ("close",), _exponential_averages, before=ema_memory(SLOW))
macd = Indicator(
    ("MACD", "MACD_Signal", "MACD_Hist"), ("close",), _macd,
    before=ema_memory(SLOW) + ema_memory(SIGNAL))
rsi = Indicator(("RSI",), ("close",), _rsi, before=14)
bollinger = Indicator(
    ("BB_Mid", "BB_Std", "BB_Upper", "BB_Lower", "BB_Width", "BB_Pos"), ("close",), _bollinger,
    before=19)
returns_and_momentum = Indicator(
    tuple(f"{kind}_{n}" for kind in ("Return", "Momentum") for n in RETURN_PERIODS), ("close",),
    _returns, before=max(RETURN_PERIODS))
volatility = Indicator(("Vol_10", "Vol_20"), ("close",), _volatility, before=20)
average_true_range = Indicator(("ATR_14",), ("close", "high", "low"), _atr, before=14)
price_ratios = Indicator(
    ("Price_vs_MA20", "Price_vs_MA50", "MA_spread"), ("close",), _price_ratios, before=49)
volume_features = Indicator(
    ("Volume_MA10", "Volume_Ratio", "Volume_Change"), ("volume",), _volume, before=9)
stochastic = Indicator(("Stoch_K", "Stoch_D"), ("close", "high", "low"), _stochastic, before=15)
candles = Indicator(
    ("Candle_Body", "Candle_Range", "Candle_Dir"), ("open", "high", "low", "close"), _candles)

TECHNICAL = (
    moving_averages, exponential_averages, macd, rsi, bollinger, returns_and_momentum, volatility,
    average_true_range, price_ratios, volume_features, stochastic, candles,
)


def exponential_average(bars: DataFrame, span: int, value: str = "close", name: str | None = None, **layout) -> DataFrame:
    """Adds ``EMA_<span>`` of any span, however long the series: segments hand on their state instead of rows."""
    return recursive_mean(bars, value, name or f"EMA_{span}", span=span, **layout)


def long_macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, **layout) -> DataFrame:
    """Adds MACD, MACD_Signal and MACD_Hist of any spans, however long the series."""
    for span, name in ((fast, "_fast"), (slow, "_slow")):
        bars = exponential_average(bars, span, name=name, **layout)
    bars = bars.withColumn("MACD", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    bars = exponential_average(bars, signal, "MACD", "MACD_Signal", **layout)
    return bars.withColumn("MACD_Hist", F.col("MACD") - F.col("MACD_Signal"))
