"""What an indicator is, and how several of them share one pass over the series."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import zip_longest

from pyspark.sql import Column, DataFrame

from tidemark.plans.series import Series, arrange

Stage = dict[str, Column]


@dataclass(frozen=True)
class Indicator:
    """Columns derived from an ordered series.

    ``stages`` lists what to add step by step, alternating window expressions and plain
    arithmetic; names with a leading underscore are helpers. Indicators applied together are
    merged stage by stage, so all of them need one shuffle, one sort and one window operator
    per window stage. ``before`` is how many earlier rows the outputs depend on, and ``needs``
    the input columns without which the indicator is left out of a feature table.
    """

    outputs: tuple[str, ...]
    needs: tuple[str, ...]
    stages: Callable[[Series], list[Stage]]
    before: int = 0

    def __call__(self, bars: DataFrame, **layout) -> DataFrame:
        return apply_indicators(bars, [self], **layout)


def apply_indicators(bars: DataFrame, indicators: Iterable[Indicator], **layout) -> DataFrame:
    """Arrange the series once and add the outputs of all ``indicators``."""
    indicators = list(indicators)
    series = arrange(bars, before=max(i.before for i in indicators), **layout)
    return series.trim(add_indicators(series.rows, series, indicators))


def add_indicators(df: DataFrame, series: Series, indicators: Iterable[Indicator]) -> DataFrame:
    """Add indicator outputs to rows that are already arranged."""
    indicators = list(indicators)
    present = df.columns
    for step in zip_longest(*(i.stages(series) for i in indicators), fillvalue={}):
        merged: Stage = {}
        for stage in step:
            merged.update(stage)
        if merged:
            df = df.withColumns(merged)
    outputs = dict.fromkeys(name for i in indicators for name in i.outputs)
    return df.select(*present, *outputs)
