"""Text helpers for headlines and articles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def split_words(text: Column) -> Column:
    """Lower-case words of a text, with an empty one where it starts or ends with other signs."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")


def words(text: Column) -> Column:
    """Lower-case words of a text: runs of letters and digits of any script."""
    return F.filter(split_words(text), lambda part: part != "")


def runs_of_words(tokens: Column, n: int) -> Column:
    """For each word, it and the ``n`` - 1 words after it joined by blanks; NULL where too few follow."""
    def run(first: Column, at: Column) -> Column:
        rest = [part for i in range(1, n) for part in (F.lit(" "), F.get(tokens, at + i))]
        return F.concat(first, *rest)

    return F.transform(tokens, run)
