"""Row selection by time and position inside a series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.series import with_key_facts


def recent_days(df: DataFrame, days: int, key: str = "company", order: str = "dt") -> DataFrame:
    """Rows within ``days`` days of the newest row of the same key, both ends included."""
    newest = with_key_facts(
        df, [key], order, [F.max(order).alias("_top")], {"_newest": lambda w: F.max("_top").over(w)})
    cutoff = F.col("_newest") - F.expr(f"INTERVAL '{int(days)}' DAY")
    return newest.where(F.col(order) >= cutoff).drop("_newest")


def recent_years(df: DataFrame, years: int, key: str = "company", order: str = "dt") -> DataFrame:
    """Rows of the last ``years`` times 365 days of each key."""
    return recent_days(df, 365 * years, key, order)


def recent_days_overall(df: DataFrame, days: int, order: str = "dt") -> DataFrame:
    """Rows within ``days`` days of the newest row of the whole table."""
    newest = df.agg(F.max(order)).scalar()
    return df.where(F.col(order) >= newest - F.expr(f"INTERVAL '{int(days)}' DAY"))


def period_start(period: str, as_of: Column | date | None = None) -> Column | None:
    """First day of a history period such as ``5d``, ``6mo``, ``1y`` or ``max`` (no limit).

    A year is 365 days, as in the trailing windows.
    """
    end = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    if period == "max":
        return None
    if period.endswith("mo"):
        return F.add_months(end, -int(period[:-2]))
    if period.endswith("y"):
        return F.date_sub(end, 365 * int(period[:-1]))
    if period.endswith("d"):
        return F.date_sub(end, int(period[:-1]))
    raise ValueError(f"unknown period: {period}")


def newest_row(df: DataFrame, key: str = "company", order: str = "dt") -> DataFrame:
    """The last row of each key, as an aggregate that combines before the shuffle."""
    rest = [name for name in df.columns if name != key]
    last = F.max_by(F.struct(*rest), F.col(order)).alias("_last")
    return df.groupBy(key).agg(last).select(*(
        F.col(key) if name == key else F.col(f"_last.{name}").alias(name) for name in df.columns))
