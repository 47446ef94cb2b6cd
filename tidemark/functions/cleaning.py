"""Coercions that turn bad input into NULL instead of raising."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters removed before a price is read as a number.
PRICE_NOISE = ",₹$"

# Layouts of dates other than ISO that are read, in the order they are tried.
DATE_LAYOUTS = ("MM/dd/yyyy", "M/d/yyyy", "yyyy/MM/dd", "MMM d, yyyy", "MMMM d, yyyy", "d-MMM-yyyy", "yyyyMMdd")


def to_number(text: Column) -> Column:
    """Strip separators and currency signs, then read a double; NULL when it is not one, or NaN.

    A letter for the type behind the digits, as in ``1.0d``, is no number.
    """
    stripped = F.trim(F.translate(text.cast("string"), PRICE_NOISE, ""))
    plain = F.when(~stripped.rlike("[0-9.][dDfF]$"), stripped)
    return F.nullif(plain.try_cast("double"), F.lit(float("nan")))


def to_day(value: Column) -> Column:
    """Read a date (or the date part of a timestamp), ISO or of ``DATE_LAYOUTS``; NULL when it is not one."""
    text = F.trim(value.cast("string"))
    return F.coalesce(F.when(~text.rlike("^[0-9]{8}$"), text.try_cast("date")), *(F.try_to_date(text, layout) for layout in DATE_LAYOUTS))


def exchange_ticker(symbol: Column) -> Column:
    """Ticker spelling of the price feed: ``BRK.B`` becomes ``BRK-B``."""
    return F.replace(symbol, F.lit("."), F.lit("-"))
