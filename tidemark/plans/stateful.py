"""Indicators with a state of their own, on series of any length.

Some indicators walk along a series and remember something that no window frame holds. If a run of rows
can be summed up in a few numbers, and the summaries of neighbouring runs merged into one, the walk need
not start at the series' beginning: every segment is summed up on its own, the summaries, one short row
each, are merged along the series, and each segment is walked again with what came before it.

    widest = Stateful(
        needs=("high", "low"), outputs={"Widest": "double"}, state={"widest": "double"},
        summarise=lambda rows: {"widest": float(np.nanmax(rows["high"] - rows["low"]))},
        merge=lambda left, right: {"widest": max(left["widest"], right["widest"])},
        apply=lambda rows, before: {"Widest": np.maximum.accumulate(
            np.fmax(rows["high"] - rows["low"], before["widest"] if before else -np.inf))})
    bars_with_widest = widest(bars)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from tidemark.plans.series import SEGMENT_ROWS, Series, arrange
from tidemark.plans.staging import stored

# The columns an indicator needs, in the series' order; a missing number is NaN.
Arrays = dict[str, np.ndarray]
# What a run of rows comes to, by the names of ``Stateful.state``.
State = dict[str, float | int | bool | str | None]


@dataclass(frozen=True)
class Stateful:
    """``outputs`` and ``state`` give the types of the new columns and of a summary, by name.

    ``summarise`` sums up a run of rows, ``merge`` two neighbouring runs, the earlier one first, and
    ``apply`` gives the outputs of a run, knowing the summary of all rows before it (None if there are
    none). ``merge`` must be associative; then results do not depend on where a series is cut. The
    functions travel to the executors, so what they import has to be there.
    """

    needs: tuple[str, ...]
    outputs: dict[str, str]
    state: dict[str, str]
    summarise: Callable[[Arrays], State]
    merge: Callable[[State, State], State]
    apply: Callable[[Arrays, State | None], Arrays]

    def __call__(self, df: DataFrame, keys: str | Sequence[str] = "company", order: str = "dt",
                 segment_rows: int = SEGMENT_ROWS) -> DataFrame:
        """``df`` with the outputs. (keys, order) must identify a row."""
        if clash := set(self.outputs) & set(df.columns):
            raise ValueError(f"already there: {sorted(clash)}")
        names = [keys] if isinstance(keys, str) else list(keys)
        series = arrange(df, names, order, segment_rows=segment_rows)
        schema = _with(series.rows.schema, self.outputs)
        if not series.cut:
            return series.rows.groupBy(*names).applyInArrow(lambda rows: self._walked(rows, order, None), schema)
        by = [*names, "_segment"]
        before = self._states_before(series, names, order)

        def walked(rows: pa.Table, states: pa.Table) -> pa.Table:
            known = states.to_pylist()[0]
            state = {name: known[f"_{name}"] for name in self.state} if known["_known"] else None
            return self._walked(rows, order, state)

        return series.trim(series.rows.groupBy(*by).cogroup(before.groupBy(*by)).applyInArrow(walked, schema))

    def _walked(self, rows: pa.Table, order: str, before: State | None) -> pa.Table:
        rows = rows.sort_by(order)
        for name, values in self.apply(self._arrays(rows), before).items():
            kind = _arrow(self.outputs[name])
            found = pa.array(values, from_pandas=True)
            rows = rows.append_column(name, found if found.type == kind else pc.cast(found, kind))
        return rows

    def _arrays(self, rows: pa.Table) -> Arrays:
        return {name: rows.column(name).to_numpy(zero_copy_only=False) for name in self.needs}

    def _states_before(self, series: Series, keys: list[str], order: str) -> DataFrame:
        """Per key and segment the summary of all segments in front of it."""
        by = [*keys, "_segment"]
        kinds = {f"_{name}": kind for name, kind in self.state.items()}
        narrow = series.rows.select(*dict.fromkeys([*by, order, *self.needs]))
        summed = _with(narrow.select(*by).schema, kinds)
        walked = _with(summed, {"_known": "boolean"})
        arrow = pa.schema([(name, _arrow(kind)) for name, kind in {**kinds, "_known": "boolean"}.items()])

        def summary(rows: pa.Table) -> pa.Table:
            state = self.summarise(self._arrays(rows.sort_by(order)))
            return _row(rows.select(by).slice(0, 1), [state], arrow)

        def scan(rows: pa.Table) -> pa.Table:
            rows, before, states = rows.sort_by("_segment"), None, []
            for row in rows.to_pylist():
                states.append(before)
                own = {name: row[f"_{name}"] for name in self.state}
                before = own if before is None else self.merge(before, own)
            return _row(rows.select(by), states, arrow, known=True)

        states = stored(narrow.groupBy(*by).applyInArrow(summary, summed), "states")
        return states.groupBy(*keys).applyInArrow(scan, walked)


def _row(keys: pa.Table, states: Sequence[State | None], schema: pa.Schema, known: bool = False) -> pa.Table:
    for field in schema:
        if field.name == "_known":
            if known:
                keys = keys.append_column(field, pa.array([state is not None for state in states], field.type))
        else:
            values = [None if state is None else state[field.name[1:]] for state in states]
            keys = keys.append_column(field, pa.array(values, field.type))
    return keys


def _with(schema: T.StructType, more: dict[str, str]) -> T.StructType:
    fields = [T.StructField(name, T._parse_datatype_string(kind)) for name, kind in more.items()]
    return T.StructType([*schema.fields, *fields])


# Types an output or a state may have.
_KINDS = {"double": pa.float64(), "float": pa.float32(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(),
          "boolean": pa.bool_(), "string": pa.string()}


def _arrow(kind: str) -> pa.DataType:
    if kind.lower() not in _KINDS:
        raise ValueError(f"{kind} is none of {sorted(_KINDS)}")
    return _KINDS[kind.lower()]
