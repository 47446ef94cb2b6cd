"""Splits along time. Nothing is drawn at random."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.plans.series import Series, over_series

TRAIN_SHARE = 0.8
VALIDATION_SHARE = 0.1


def by_position(df: DataFrame, share: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE,
                **layout) -> DataFrame:
    """Adds ``is_train`` (the first ``share`` of each series' rows), ``is_validation`` (the tail of
    the training rows), ``position`` and ``train_rows``."""
    def build(s: Series) -> DataFrame:
        return s.rows.withColumns({"position": s.position, "_size": s.size})

    return flagged(over_series(df, build, **layout), "_size", share, validation).drop("_size")


def flagged(placed: DataFrame, size: str = "size", share: float = TRAIN_SHARE, validation: float = VALIDATION_SHARE) -> DataFrame:
    """Adds the flags of ``by_position`` to rows that know their ``position`` and the ``size`` of their series."""
    fitted = F.floor(F.col("train_rows") * F.lit(1.0 - validation))
    return (
        placed.withColumn("train_rows", F.floor(F.col(size) * F.lit(share)))
        .withColumn("is_train", F.col("position") <= F.col("train_rows"))
        .withColumn("is_validation", F.col("is_train") & (F.col("position") > fitted))
    )


def seen_by_sequences(df: DataFrame, lookback: int, share: float = TRAIN_SHARE, **layout) -> DataFrame:
    """Adds ``is_seen``: the row lies inside the window of some training sequence.

    With n rows there are n - ``lookback`` sequences; scalers of sequence features are fitted on
    the rows the first ``share`` of them cover.
    """
    def build(s: Series) -> DataFrame:
        return s.rows.withColumns({"_position": s.position, "_size": s.size})

    train_sequences = F.floor((F.col("_size") - lookback) * F.lit(share))
    return (
        over_series(df, build, **layout)
        .withColumn("is_seen", F.col("_position") <= train_sequences + (lookback - 1))
        .drop("_position", "_size")
    )


def by_date_quantile(df: DataFrame, share: float = TRAIN_SHARE, order: str = "dt") -> DataFrame:
    """Adds ``is_train``: the day or time is not after the interpolated ``share`` quantile of all.

    The exact quantile keeps one counter per distinct value. Of days there are few; times, of which
    there may be very many, are first narrowed down to the days that hold the two ranks around it.
    """
    if isinstance(df.schema[order].dataType, T.DateType):
        day = F.unix_date(order)
        return df.withColumn("is_train", day <= df.agg(F.percentile(day, share)).scalar())
    start = F.lit("1970-01-01").cast(df.schema[order].dataType)
    at = F.timestamp_diff("MICROSECOND", start, F.col(order))
    day = F.floor(at / 86_400_000_000)
    counts = {row["day"]: row["n"] for row in df.where(F.col(order).isNotNull()).groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return df.withColumn("is_train", F.lit(None).cast("boolean"))
    rank, before, days = share * (sum(counts.values()) - 1), 0, []
    for number in sorted(counts):
        if before <= rank + 1 and before + counts[number] > int(rank):
            days.append((number, before))
        before += counts[number]
    # The quantile over all is the quantile at the rank that is left inside these days.
    inside = sum(counts[number] for number, _ in days) - 1
    left = (rank - days[0][1]) / inside if inside else 0.0
    near = df.where(day.isin([number for number, _ in days]))
    return df.withColumn("is_train", at <= near.agg(F.percentile(at, left)).scalar())
