import datetime as dt

import numpy as np
import pandas as pd
import pytest
from panel import assert_same, make_panel, to_spark

from tidemark.operators.walks import drawdown, rising_rows
from tidemark.plans.series import arrange
from tidemark.plans.stateful import Stateful


@pytest.fixture(scope="module")
def panel():
    return make_panel({"LONG": 900, "MID": 200, "ONE": 1})


def expected(panel):
    frames = []
    for _, rows in panel.groupby("company"):
        rows = rows.sort_values("dt").reset_index(drop=True)
        peak = rows.close.cummax()
        at_peak = pd.Series(np.where(rows.close == peak, rows.index, np.nan)).ffill()
        rising, n = [], 0
        for rise in rows.close > rows.close.shift(1):
            n = n + 1 if rise else 0
            rising.append(n)
        frames.append(rows[["company", "dt"]].assign(Drawdown=rows.close / peak - 1, Rows_Since_Peak=rows.index - at_peak, Rising_Rows=rising))
    return pd.concat(frames)


@pytest.mark.parametrize("segment_rows", [20, 100, 20_000])
def test_cut_equals_uncut(spark, panel, segment_rows):
    bars = to_spark(spark, panel)
    got = rising_rows(drawdown(bars, segment_rows=segment_rows), segment_rows=segment_rows)
    assert got.columns == [*bars.columns, "Drawdown", "Rows_Since_Peak", "Rising_Rows"]
    assert_same(got.toPandas(), expected(panel), ["Drawdown", "Rows_Since_Peak", "Rising_Rows"], 1e-12)


def test_rises_and_falls_over_borders(spark):
    # One long rise, one long fall: every segment hands on a run that fills it.
    close = [float(i) for i in range(100)] + [float(100 - i) for i in range(100)] + [1000.0 + i for i in range(60)]
    rows = [("A", dt.date(2024, 1, 1) + dt.timedelta(days=i), c) for i, c in enumerate(close)]
    table = spark.createDataFrame(rows, "company string, dt date, close double")
    got = rising_rows(drawdown(table, segment_rows=33), segment_rows=33).orderBy("dt").toPandas()
    assert arrange(table, segment_rows=33).cut
    assert got.Rising_Rows.tolist() == [*range(100), 100, *[0] * 99, *range(1, 61)]
    assert got.Rows_Since_Peak.tolist() == [*[0] * 101, *range(1, 100), *[0] * 60]


def test_missing_values_and_keys(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    rows = [("A", d, None if i < 50 or i % 9 == 0 else float(i % 40)) for i, d in enumerate(days)] + [(None, days[0], 3.0), (None, days[1], 2.0)]
    table = spark.createDataFrame(rows, "company string, dt date, close double")
    whole = drawdown(table).orderBy("company", "dt").toPandas()
    cut = drawdown(table, segment_rows=33).orderBy("company", "dt").toPandas()
    pd.testing.assert_frame_equal(whole, cut)
    assert cut.Drawdown.isna().sum() == sum(r[2] is None for r in rows) and cut.Rows_Since_Peak.isna().sum() == 50
    assert drawdown(table.where("false")).collect() == []
    with pytest.raises(ValueError, match="already there"):
        drawdown(table.selectExpr("*", "1.0 AS Drawdown"))


def test_an_indicator_of_ones_own(spark, panel):
    widest = Stateful(
        needs=("high", "low"), outputs={"Widest": "double"}, state={"widest": "double"},
        summarise=lambda rows: {"widest": float((rows["high"] - rows["low"]).max())},
        merge=lambda left, right: {"widest": max(left["widest"], right["widest"])},
        apply=lambda rows, before: {"Widest": np.maximum.accumulate(np.fmax(rows["high"] - rows["low"], before["widest"] if before else -np.inf))})
    got = widest(to_spark(spark, panel), segment_rows=90).toPandas()
    frames = [rows.sort_values("dt").assign(Widest=lambda r: (r.high - r.low).cummax()) for _, rows in panel.groupby("company")]
    assert_same(got, pd.concat(frames), ["Widest"], 1e-12)
