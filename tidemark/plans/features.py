"""The feature table: bars, technical indicators, daily sentiment and its features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.indicator import add_indicators
from tidemark.operators.sentiment import SENTIMENT, join_sentiment
from tidemark.operators.technical import TECHNICAL
from tidemark.plans.series import arrange

# Column names of the finished table that differ from the canonical ones.
TABLE_NAMES = {
    "company": "Company", "dt": "Date", "open": "Open", "high": "High", "low": "Low",
    "close": "Close", "volume": "Volume", "sentiment": "Sentiment",
}


def all_features(bars: DataFrame, daily: DataFrame | None, **layout) -> DataFrame:
    """Bars with every indicator whose input columns exist; warm-up rows keep their NULLs.

    Sentiment is joined on (company, day), which spreads evenly however long one company is;
    the indicators then share one shuffle by (company, segment).
    """
    available = {*bars.columns, "sentiment"}
    chosen = [i for i in (*TECHNICAL, *SENTIMENT) if available.issuperset(i.needs)]
    series = arrange(bars, before=max(i.before for i in chosen), **layout)
    joined = join_sentiment(series.rows, daily)
    return series.trim(add_indicators(joined, series, chosen))


def feature_table(bars: DataFrame, daily: DataFrame | None, **layout) -> DataFrame:
    """The complete rows of ``all_features`` under their final names.

    The longest warm-up removes the first 49 rows of each company; infinite changes stay.
    """
    return all_features(bars, daily, **layout).dropna().withColumnsRenamed(TABLE_NAMES)


def merge_prices_and_sentiment(prices: DataFrame, daily: DataFrame) -> DataFrame:
    """The small merged table: OHLCV with ``daily_sentiment``."""
    merged = join_sentiment(prices, daily)
    return merged.select("company", "dt", "open", "high", "low", "close", "volume", "sentiment") \
        .withColumnsRenamed({"company": "ticker", "dt": "date", "sentiment": "daily_sentiment"})
