"""Joining prices with daily sentiment, and sentiment features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.series import finite, relative_change, rolling, shift
from tidemark.operators.indicator import Indicator, Stage
from tidemark.plans.series import Series


def _sentiment() -> Column:
    return F.col("sentiment")


def join_sentiment(bars: DataFrame, daily: DataFrame | None, company: str = "company",
                   order: str = "dt") -> DataFrame:
    """All bars with that day's sentiment, 0.0 where there is none (or no table at all).

    ``daily`` has one row per company and day, so the join never multiplies rows. Both dates
    are compared as dates. Its keys may have other names: ``ticker`` and ``date``.
    """
    if daily is None:
        return bars.withColumn("sentiment", F.lit(0.0))
    names = {"ticker": company, "date": order}
    daily = daily.withColumnsRenamed({old: new for old, new in names.items() if old in daily.columns})
    daily = daily.select(company, F.col(order).cast("date").alias(order), "sentiment")
    return bars.join(daily, [company, order], "left").fillna(0.0, ["sentiment"])


def _windows(s: Series) -> list[Stage]:
    first, second = F.col("Sentiment_Lag1"), F.col("Sentiment_Lag2")
    return [
        {
            **{f"Sentiment_Lag{n}": shift(_sentiment(), n, s.w) for n in (1, 2, 3)},
            "Sentiment_MA3": rolling(F.avg, _sentiment(), 3, s.w),
            "Sentiment_MA7": rolling(F.avg, _sentiment(), 7, s.w),
            "Sentiment_Std5": rolling(F.stddev_samp, _sentiment(), 5, s.w),
            "Sentiment_Cum5": rolling(F.sum, _sentiment(), 5, s.w),
        },
        {
            "Sentiment_Change": _sentiment() - first,
            "Sentiment_Accel": (_sentiment() - first) - (first - second),
        },
    ]


def _interactions(s: Series) -> list[Stage]:
    close = F.col("close")
    weighted = _sentiment() * F.log1p("volume")
    return [
        {
            "_close_1_back": shift(close, 1, s.w),
            "_close_5_back": shift(close, 5, s.w),
            "Sentiment_Weighted_MA": rolling(F.avg, finite(weighted), 3, s.w),
        },
        {
            "Sent_x_Return1": _sentiment() * relative_change(close, F.col("_close_1_back")),
            "Sent_x_Momentum": _sentiment() * (close - F.col("_close_5_back")),
            "Sentiment_Weighted": weighted,
            "Sentiment_Pos": F.coalesce(_sentiment() > 0, F.lit(False)).cast("int"),
            "Sentiment_Neg": F.coalesce(_sentiment() < 0, F.lit(False)).cast("int"),
        },
    ]


sentiment_windows = Indicator(
    ("Sentiment_Lag1", "Sentiment_Lag2", "Sentiment_Lag3", "Sentiment_MA3", "Sentiment_MA7",
     "Sentiment_Std5", "Sentiment_Change", "Sentiment_Accel", "Sentiment_Cum5"),
    ("sentiment",), _windows, before=6)
sentiment_interactions = Indicator(
    ("Sent_x_Return1", "Sent_x_Momentum", "Sentiment_Weighted", "Sentiment_Weighted_MA",
     "Sentiment_Pos", "Sentiment_Neg"),
    ("sentiment", "close", "volume"), _interactions, before=5)

SENTIMENT = (sentiment_windows, sentiment_interactions)
