"""Between long bars (one row per company and day) and wide tables (one row per day)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.clean import DATE_NAMES, NUMERIC, pick_column

SEPARATOR = "|"


def flat_names(names: Sequence[Sequence[str] | str]) -> list[str]:
    """Lower-case first level of two-level column names."""
    return [(name if isinstance(name, str) else name[0]).lower() for name in names]


def to_wide(bars: DataFrame, tickers: Sequence[str] | None = None,
            fields: Sequence[str] = NUMERIC, order: str = "dt") -> DataFrame:
    """One row per day with a ``TICKER|Field`` column per ticker and field.

    All series are aligned on the day by one aggregation instead of a chain of outer joins.
    Naming the tickers also saves the extra job that finds them; without names Spark refuses
    more than ``spark.sql.pivotMaxValues`` of them.
    """
    # Spark joins ticker and field by "_", and leaves the field out where there is one only.
    cells = [F.first(name, ignorenulls=True).alias(SEPARATOR + name.capitalize()) for name in fields]
    wide = bars.groupBy(order).pivot("company", list(tickers) if tickers is not None else None).agg(*cells)
    titles = wide.columns[1:]
    if len(cells) == 1:
        titles = [f"{ticker}{SEPARATOR}{fields[0].capitalize()}" for ticker in titles]
    else:
        titles = [SEPARATOR.join(title.rsplit("_" + SEPARATOR, 1)) for title in titles]
    return wide.toDF(order, *titles)


def to_long(wide: DataFrame, fields: Sequence[str] = NUMERIC) -> DataFrame:
    """Long bars from ``TICKER|Field`` columns, with the day as ISO text.

    Tickers lacking one of the fields are skipped, and so are rows with a missing value. Each
    input row is expanded in place, so nothing is shuffled.
    """
    date = pick_column(wide, DATE_NAMES, "date")
    present: dict[str, set[str]] = {}
    for name in wide.columns:
        ticker, mark, field = name.rpartition(SEPARATOR)
        if mark:
            present.setdefault(ticker, set()).add(field)
    titles = [field.capitalize() for field in fields]
    complete = [ticker for ticker, found in present.items() if found.issuperset(titles)]
    if not complete:
        raise ValueError("no ticker has all of " + ", ".join(titles))
    bars = F.explode(F.array(*(
        F.struct(F.lit(ticker).alias("ticker"), *(
            F.col(f"`{ticker}{SEPARATOR}{title}`").alias(field) for field, title in zip(fields, titles)))
        for ticker in complete))).alias("bar")
    day = F.date_format(F.col(f"`{date}`"), "yyyy-MM-dd").alias("date")
    return wide.select(day, bars).select("date", "bar.*").dropna()
