"""Indicators that walk along a series with a state."""

from __future__ import annotations

import numpy as np

from tidemark.plans.stateful import Arrays, State, Stateful


def _peak(rows: Arrays) -> State:
    close, n = rows["close"], len(rows["close"])
    if np.isnan(close).all():
        return {"peak": None, "since": 0, "rows": n}
    peak = float(np.nanmax(close))
    return {"peak": peak, "since": n - 1 - int(np.flatnonzero(close == peak)[-1]), "rows": n}


def _later_peak(left: State, right: State) -> State:
    rows = left["rows"] + right["rows"]
    if left["peak"] is None or (right["peak"] is not None and right["peak"] >= left["peak"]):
        return {**right, "rows": rows}
    return {"peak": left["peak"], "since": left["since"] + right["rows"], "rows": rows}


def _below_peak(rows: Arrays, before: State | None) -> Arrays:
    close, place = rows["close"], np.arange(len(rows["close"]))
    known = before is not None and before["peak"] is not None
    start = before["peak"] if known else -np.inf
    peak = np.fmax(np.fmax.accumulate(close), start)
    # Places count from the row after the last peak in front of this run.
    last = np.maximum.accumulate(np.where(close == peak, place, -1 - before["since"] if known else -1))
    reached = np.isfinite(peak)
    return {"Drawdown": np.where(reached, close / np.where(reached, peak, 1.0) - 1, np.nan),
            "Rows_Since_Peak": [int(n) if ok else None for n, ok in zip(place - last, reached)]}


# How far the close lies below the highest close so far, and the rows since then; a missing close has no drawdown.
drawdown = Stateful(
    needs=("close",), outputs={"Drawdown": "double", "Rows_Since_Peak": "long"},
    state={"peak": "double", "since": "long", "rows": "long"}, summarise=_peak, merge=_later_peak, apply=_below_peak)


def _rises(close: np.ndarray, before: float | None) -> np.ndarray:
    prior = np.concatenate([[np.nan if before is None else before], close[:-1]])
    return close > prior


def _run(rows: Arrays) -> State:
    close = rows["close"]
    falls = np.flatnonzero(~_rises(close, None)[1:])
    streak = len(close) - 2 - int(falls[-1]) if len(falls) else len(close) - 1
    return {"first": float(close[0]), "last": float(close[-1]), "streak": streak, "whole": not len(falls)}


def _joined_run(left: State, right: State) -> State:
    rise = right["first"] > left["last"]
    streak = right["streak"] + (left["streak"] + 1 if right["whole"] and rise else 0)
    return {"first": left["first"], "last": right["last"], "streak": streak, "whole": left["whole"] and rise and right["whole"]}


def _streaks(rows: Arrays, before: State | None) -> Arrays:
    rises = _rises(rows["close"], before and before["last"])
    place = np.arange(len(rises))
    start = before["streak"] if before else 0
    last = np.maximum.accumulate(np.where(rises, -1 - start, place))
    return {"Rising_Rows": (place - last).astype(np.int64)}


# Rows in a row whose close is above the one before; a missing close ends a run.
rising_rows = Stateful(
    needs=("close",), outputs={"Rising_Rows": "long"},
    state={"first": "double", "last": "double", "streak": "long", "whole": "boolean"},
    summarise=_run, merge=_joined_run, apply=_streaks)
