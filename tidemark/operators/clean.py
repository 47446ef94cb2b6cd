"""From raw column names and text cells to canonical bars."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.cleaning import to_day, to_number

# Accepted names of the date and the ticker column, and the numeric fields.
DATE_NAMES = ("date", "Date", "timestamp", "Datetime", "Price", "dt")
TICKER_NAMES = ("company", "Company", "ticker")
NUMERIC = ("open", "high", "low", "close", "volume")


def trim_names(df: DataFrame) -> DataFrame:
    """Column names without surrounding blanks."""
    return df.toDF(*(name.strip() for name in df.columns))


def pick_column(df: DataFrame, candidates: Iterable[str], what: str) -> str:
    """The first candidate among the columns; an error when there is none."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"could not find a {what} column among {df.columns}")


def clean_bars(raw: DataFrame) -> DataFrame:
    """Canonical bars (company, dt and the numeric fields present) from any accepted naming.

    Dates and numbers that cannot be read become NULL, and rows without a date or a close are
    dropped.
    """
    df = trim_names(raw)
    date = pick_column(df, DATE_NAMES, "date")
    ticker = pick_column(df, TICKER_NAMES, "ticker")
    by_name = {name.lower(): name for name in df.columns}
    numbers = [to_number(F.col(f"`{by_name[name]}`")).alias(name) for name in NUMERIC if name in by_name]
    bars = df.select(F.col(ticker).alias("company"), to_day(F.col(f"`{date}`")).alias("dt"), *numbers)
    return bars.dropna(subset=["dt", "close"])


def require_unique(df: DataFrame, keys: Iterable[str] = ("company", "dt")) -> DataFrame:
    """The same rows; the job fails when two of them share ``keys``.

    Partial counts are combined before the shuffle, so many copies of one key cost one row per
    task. The check is a join on the counts of keys that occur twice, which is empty in good data.
    """
    keys = list(keys)
    repeated = df.groupBy(*keys).count().where("count > 1").select(
        *keys, F.lit(True).alias("_repeated"))
    message = F.concat(F.lit("duplicate key: "), F.to_json(F.struct(*keys)))
    fine = F.when(F.col("_repeated"), F.raise_error(message).cast("boolean")).otherwise(True)
    return df.join(repeated, keys, "left").where(fine).drop("_repeated")


def drop_empty_columns(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Without the columns that are NULL in every row. Reads one row of counts on the driver."""
    counts = df.agg(*(F.count(f"`{name}`").alias(name) for name in df.columns)).first()
    keep = set(keep)
    return df.select(*(f"`{name}`" for name in df.columns if name in keep or counts[name] > 0))
