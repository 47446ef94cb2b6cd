import datetime as dt

import numpy as np
import pandas as pd
import pytest
from panel import assert_same, make_panel, to_spark

from tidemark.operators import technical
from tidemark.plans import scan
from tidemark.plans.series import arrange


@pytest.fixture(scope="module")
def panel():
    return make_panel({"LONG": 1500, "MID": 230, "SHORT": 44, "ONE": 1})


def expected(panel, **ewm):
    frames = []
    for _, rows in panel.groupby("company"):
        rows = rows.sort_values("dt")
        frames.append(rows[["company", "dt"]].assign(mean=rows.close.ewm(adjust=False, **ewm).mean()))
    return pd.concat(frames)


@pytest.mark.parametrize("span", [2, 12, 300, 10_000])
@pytest.mark.parametrize("segment_rows", [40, 333, 20_000])
def test_any_span_equals_the_plain_recursion(spark, panel, span, segment_rows):
    bars = to_spark(spark, panel)
    got = scan.recursive_mean(bars, "close", "mean", span=span, segment_rows=segment_rows)
    assert got.columns == [*bars.columns, "mean"]
    assert_same(got.toPandas(), expected(panel, span=span), ["mean"], 1e-9)


def test_very_long_spans_need_no_history(spark):
    rows = spark.range(60_000).selectExpr("'T' AS company", "timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, id) AS dt", "100 + sin(id / 700) * 9 + id % 13 AS close")
    got = scan.recursive_mean(rows, "close", "mean", span=10_000).orderBy("dt").select("close", "mean").toPandas()
    np.testing.assert_allclose(got["mean"], got.close.ewm(span=10_000, adjust=False).mean(), rtol=1e-9)
    assert arrange(rows).cut


def test_missing_values(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(200)]
    close = [None if i < 70 or 90 <= i < 130 or i % 11 == 0 else float(i) for i in range(200)]
    rows = [("A", d, c) for d, c in zip(days, close)] + [("B", d, None) for d in days[:50]] + [(None, days[0], 2.0), (None, days[1], 4.0)]
    table = spark.createDataFrame(rows, "company string, dt date, close double")
    plain = pd.Series(close, dtype=float).ewm(alpha=0.3, adjust=False, ignore_na=True).mean()
    for segment_rows in (40, 1000):
        got = scan.recursive_mean(table, "close", "mean", alpha=0.3, segment_rows=segment_rows).toPandas()
        one = got[got.company == "A"].sort_values("dt")["mean"]
        np.testing.assert_allclose(one, plain, rtol=1e-12)
        assert got[got.company == "B"]["mean"].isna().all()
        np.testing.assert_allclose(sorted(got[got.company.isna()]["mean"]), [2.0, 2.6], rtol=1e-12)
    assert scan.recursive_mean(table.where("false"), "close", "mean", span=5).collect() == []


def test_maps_are_combined_by_doubling(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"k": np.repeat(["a", "b"], [37, 4]), "at": [*range(37), *range(4)], "factor": rng.random(41), "offset": rng.normal(size=41)})
    got = scan.scanned(spark.createDataFrame(frame), ["k"], "at").toPandas().sort_values(["k", "at"]).reset_index(drop=True)
    for k, rows in frame.groupby("k"):
        factor, offset = 1.0, 0.0
        for i, row in rows.iterrows():
            factor, offset = row.factor * factor, row.factor * offset + row.offset
            assert abs(got.factor[i] - factor) < 1e-12 and abs(got.offset[i] - offset) < 1e-12


def test_what_has_no_meaning(spark, panel):
    bars = to_spark(spark, panel)
    for wrong in ({}, {"span": 3, "alpha": 0.5}, {"alpha": 1.0}, {"alpha": 0.0}, {"span": 1}):
        with pytest.raises(ValueError):
            scan.recursive_mean(bars, "close", "mean", **wrong)


def test_long_macd_equals_pandas(spark, panel):
    got = technical.long_macd(to_spark(spark, panel), 120, 260, 90, segment_rows=333).toPandas()
    frames = []
    for _, rows in panel.groupby("company"):
        rows = rows.sort_values("dt")
        macd = rows.close.ewm(span=120, adjust=False).mean() - rows.close.ewm(span=260, adjust=False).mean()
        signal = macd.ewm(span=90, adjust=False).mean()
        frames.append(rows[["company", "dt"]].assign(MACD=macd, MACD_Signal=signal, MACD_Hist=macd - signal))
    assert_same(got, pd.concat(frames), ["MACD", "MACD_Signal", "MACD_Hist"], 1e-8)
