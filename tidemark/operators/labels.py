"""Targets for training, and sequences of past rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.series import finite, relative_change, rolling, shift
from tidemark.plans.series import Series, arrange, over_series

HORIZON = 5
LOOKBACK = 60
POOLED_LOOKBACK = 10


def direction_label(df: DataFrame, value: str = "Return_1", horizon: int = HORIZON, **layout) -> DataFrame:
    """Adds ``Future_Return``, the one-day return ``horizon`` rows ahead, and ``Target``, 1 where
    it is positive; rows without a future return are dropped."""
    def build(s: Series) -> DataFrame:
        return s.rows.withColumn("Future_Return", shift(F.col(value), -horizon, s.w))

    labelled = over_series(df, build, after=horizon, **layout)
    return (
        labelled.dropna(subset=["Future_Return"])
        .withColumn("Target", (F.col("Future_Return") > 0).cast("int"))
    )


def return_targets(bars: DataFrame, horizon: int = HORIZON, **layout) -> DataFrame:
    """Adds ``Return`` recomputed on the given rows and ``Future_Return``; rows with any missing
    value are dropped."""
    def build(s: Series) -> DataFrame:
        returned = s.rows.withColumn("_prior", shift(F.col("close"), 1, s.w))
        returned = returned.withColumn("Return", relative_change(F.col("close"), F.col("_prior")))
        return returned.withColumn("Future_Return", shift(F.col("Return"), -horizon, s.w)).drop("_prior")

    return over_series(bars, build, before=1, after=horizon, **layout).dropna()


def log_return_features(bars: DataFrame, **layout) -> DataFrame:
    """The compact feature set of the pooled classifier: log return, its five-day spread, the
    three-day relative change, volume change and next-day direction.

    Infinite values count as missing and rows with missing values are dropped. The last row of
    a company keeps direction 0.
    """
    close, gated = F.col("close"), "volume" in bars.columns

    def build(s: Series) -> DataFrame:
        lags = {"_prior": shift(close, 1, s.w), "_prior_3": shift(close, 3, s.w)}
        if gated:
            lags["_prior_volume"] = shift(F.col("volume"), 1, s.w)
        volume_change = relative_change(F.col("volume"), F.col("_prior_volume")) if gated else F.lit(0.0)
        df = s.rows.withColumns(lags).withColumns({
            "log_return": F.log(F.try_divide(close, F.col("_prior"))),
            "Momentum_3": relative_change(close, F.col("_prior_3")),
            "Volume_Change": volume_change,
        })
        ahead = F.coalesce(shift(F.col("log_return"), -1, s.w) > 0, F.lit(False))
        df = df.withColumns({
            "Volatility_5": rolling(F.stddev_samp, finite(F.col("log_return")), 5, s.w),
            "Direction": ahead.cast("int"),
        })
        return df.drop(*lags)

    built = over_series(bars, build, before=5, after=1, **layout)
    numbers = [f.name for f in built.schema if f.dataType.typeName() in ("double", "float")]
    return built.withColumns({name: finite(F.col(name)) for name in numbers}).dropna()


def sequences(df: DataFrame, features: Sequence[str], target: str = "Future_Return",
              lookback: int = LOOKBACK, keys: str | Sequence[str] = "company", order: str = "dt",
              **layout) -> DataFrame:
    """Per row the feature rows of the ``lookback`` rows before it, oldest first, and its target.

    Rows with fewer predecessors are dropped. The result holds ``lookback`` times the feature
    columns by nature; project ``df`` to what is needed first.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    series = arrange(df.select(*names, order, *dict.fromkeys([*features, target])), keys, order,
                     before=lookback, **layout)
    past = F.collect_list(F.array(*(F.col(f).cast("double") for f in features)))
    built = series.rows.withColumn("sequence", past.over(series.w.rowsBetween(-lookback, -1)))
    built = series.trim(built.where(F.size("sequence") == lookback))
    return built.select(*names, order, "sequence", F.col(target).alias("target"))
