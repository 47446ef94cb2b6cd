import re

import numpy as np
import pandas as pd
import pytest
from panel import assert_same, expected_panel, make_panel, to_spark
from pyspark.sql import Window, functions as F

from tidemark.functions.series import earlier_blocks, over_blocks, rolling, rolling_blocks
from tidemark.operators.display import CHART, chart_series, macd_display, rsi_wilder
from tidemark.operators.indicator import apply_indicators
from tidemark.operators.technical import TECHNICAL
from tidemark.plans.features import all_features, feature_table
from tidemark.plans.series import arrange

SIZES = {"LONG": 1500, "MID": 230, "SIXTY": 60, "SHORT": 44, "ONE": 1}
CHECKED = [c for c in expected_panel(make_panel({"X": 5})).columns if c not in ("company", "dt")]


@pytest.fixture(scope="module")
def panel():
    return make_panel(SIZES)


@pytest.fixture(scope="module")
def bars(spark, panel):
    return to_spark(spark, panel).cache()


def test_all_technical_features_match_pandas(bars, panel):
    actual = apply_indicators(bars, TECHNICAL).toPandas()
    assert_same(actual, expected_panel(panel), CHECKED)


@pytest.mark.parametrize("segment_rows", [720, 1000])
def test_cut_series_give_the_same_features(bars, panel, segment_rows):
    assert arrange(bars, before=686, segment_rows=segment_rows).cut
    actual = apply_indicators(bars, TECHNICAL, segment_rows=segment_rows).toPandas()
    assert_same(actual, expected_panel(panel), CHECKED)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_series_may_be_ordered_by_a_time(bars, kind):
    timed = bars.withColumn("dt", (F.col("dt").cast(kind) + F.expr("INTERVAL '13:45' HOUR TO MINUTE")))
    columns = ["company", "dt", "MA_50", "RSI"]
    chosen = [i for i in TECHNICAL if {"MA_50", "RSI"} & set(i.outputs)]
    whole = apply_indicators(timed, chosen).select(columns)
    cut = apply_indicators(timed, chosen, segment_rows=100).select(columns)
    assert arrange(timed, before=49, segment_rows=100).cut
    assert_same(cut.toPandas(), whole.toPandas(), ["MA_50", "RSI"], 1e-12)


def test_rows_of_a_cut_series_are_bounded(bars):
    series = arrange(bars, before=60, after=5, segment_rows=200)
    largest = series.rows.groupBy("company", "_segment").count().agg(F.max("count")).first()[0]
    # A segment, the slice that crosses its end, and whole slices of neighbours.
    assert largest <= 200 + 3 * 32 + 60 + 5
    assert series.trim(series.rows).count() == bars.count()
    assert series.trim(series.rows).columns == bars.columns


def test_positions_and_sizes_of_a_cut_series(bars, panel):
    series = arrange(bars, before=10, segment_rows=150)
    placed = series.trim(series.rows.withColumns({"p": series.position, "n": series.size})).toPandas()
    for name, rows in placed.sort_values("dt").groupby("company"):
        assert list(rows.p) == list(range(1, SIZES[name] + 1))
        assert set(rows.n) == {SIZES[name]}


def test_dense_slices_are_made_narrower(spark, bars):
    series = arrange(bars, before=10, segment_rows=60, slice_minutes=1440 * 1000)
    assert series.cut and series.trim(series.rows).count() == bars.count()
    ticks = spark.range(30_000).selectExpr(
        "'T' AS company", "timestamp_ntz'2024-03-01 09:00:00' + make_dt_interval(0, 0, 0, id / 1000) AS dt", "sin(id) AS close")
    cut = arrange(ticks, before=3)
    assert cut.cut
    mean = cut.trim(cut.rows.withColumn("m", F.avg("close").over(cut.w.rowsBetween(-3, 0))))
    plain = ticks.withColumn("m", F.avg("close").over(Window.partitionBy("company").orderBy("dt").rowsBetween(-3, 0)))
    assert cut.rows.groupBy("_segment").count().agg(F.max("count")).first()[0] <= 2 * 20_000
    assert sorted(r.m for r in mean.collect()) == sorted(r.m for r in plain.collect())
    with pytest.raises(ValueError):
        arrange(bars, before=100, segment_rows=60)


def test_later_days_never_change_earlier_features(spark, panel):
    cut = panel.groupby("company").head(120)
    columns = [c for c in CHECKED if c != "Volume_Change"]
    full = apply_indicators(to_spark(spark, panel), TECHNICAL).toPandas()
    part = apply_indicators(to_spark(spark, cut), TECHNICAL).toPandas()
    kept = full.merge(cut[["company", "dt"]], on=["company", "dt"])
    assert_same(part, kept, columns, 1e-12)


def test_missing_values_break_only_their_windows(spark):
    panel = make_panel({"A": 80})
    panel.loc[30, "volume"] = np.nan
    actual = apply_indicators(to_spark(spark, panel), TECHNICAL).toPandas().sort_values("dt")
    missing = actual["Volume_MA10"].isna().to_numpy()
    assert missing[:9].all() and not missing[9:30].any()
    assert missing[30:40].all() and not missing[40:].any()


def test_change_from_zero(spark):
    panel = make_panel({"A": 60})
    changes = apply_indicators(to_spark(spark, panel), TECHNICAL).toPandas().sort_values("dt")["Volume_Change"]
    assert changes.iloc[20] == -1.0 and np.isnan(changes.iloc[21]) and np.isinf(changes.iloc[23])


def test_feature_table_keeps_complete_rows_under_final_names(bars):
    table = feature_table(bars, None)
    assert len(table.columns) == 60
    counts = {r["Company"]: r["count"] for r in table.groupBy("Company").count().collect()}
    # 49 warm-up rows, and 0/0 volume changes on the three flat days (the first is from non-zero).
    assert counts == {"LONG": 1500 - 49, "MID": 230 - 49, "SIXTY": 11}
    assert {"Company", "Date", "Close", "Sentiment", "Sentiment_Weighted_MA"} <= set(table.columns)


def test_columns_that_are_absent_leave_their_features_out(bars):
    names = all_features(bars.drop("volume", "high"), None).columns
    assert "MA_10" in names and "Sentiment_MA7" in names
    assert not {"Volume_MA10", "ATR_14", "Stoch_K", "Candle_Body", "Sent_x_Return1"} & set(names)


def test_sentiment_features_match_pandas(spark, panel):
    rng = np.random.default_rng(5)
    some = panel.sample(frac=0.4, random_state=1)[["company", "dt"]].assign(sentiment=rng.normal(0, 1, len(panel.sample(frac=0.4, random_state=1))))
    daily = to_spark(spark, some.rename(columns={"company": "ticker", "dt": "date"}),
                     "ticker STRING, date DATE, sentiment DOUBLE")
    actual = all_features(to_spark(spark, panel), daily, segment_rows=800).toPandas()
    joined = panel.merge(some, on=["company", "dt"], how="left").fillna({"sentiment": 0.0})

    def one(rows):
        rows = rows.sort_values("dt").reset_index(drop=True)
        s, out = rows.sentiment, rows[["company", "dt"]].copy()
        for n in (1, 2, 3):
            out[f"Sentiment_Lag{n}"] = s.shift(n)
        out["Sentiment_MA3"], out["Sentiment_MA7"] = s.rolling(3).mean(), s.rolling(7).mean()
        out["Sentiment_Std5"], out["Sentiment_Cum5"] = s.rolling(5).std(), s.rolling(5).sum()
        out["Sentiment_Change"], out["Sentiment_Accel"] = s.diff(), s.diff().diff()
        out["Sent_x_Return1"] = s * (rows.close / rows.close.shift(1) - 1)
        out["Sent_x_Momentum"] = s * rows.close.diff(5)
        out["Sentiment_Weighted"] = s * np.log1p(rows.volume)
        out["Sentiment_Weighted_MA"] = out.Sentiment_Weighted.rolling(3).mean()
        out["Sentiment_Pos"], out["Sentiment_Neg"] = (s > 0).astype(int), (s < 0).astype(int)
        return out

    expected = pd.concat([one(rows) for _, rows in joined.groupby("company")])
    assert_same(actual, expected, [c for c in expected.columns if c not in ("company", "dt")])


def wilder_and_macd(close):
    delta = close.diff()
    up = delta.where(delta > 0, 0.0).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    down = (-delta.where(delta < 0, 0.0)).ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    rsi = pd.Series(np.where(down == 0, 100, 100 - 100 / (1 + up / down)), index=close.index)
    macd = (close.ewm(span=12, min_periods=12, adjust=False).mean()
            - close.ewm(span=26, min_periods=26, adjust=False).mean())
    return rsi, macd, macd.ewm(span=9, min_periods=9, adjust=False).mean()


@pytest.mark.parametrize("segment_rows", [20_000, 800])
def test_display_indicators_match_pandas(bars, panel, segment_rows):
    actual = apply_indicators(bars, [rsi_wilder, macd_display], segment_rows=segment_rows).toPandas()
    frames = []
    for _, rows in panel.groupby("company"):
        rows = rows.sort_values("dt")
        rsi, macd, signal = wilder_and_macd(rows.close)
        frames.append(rows[["company", "dt"]].assign(RSI=rsi, MACD=macd, MACD_Signal=signal))
    assert_same(actual, pd.concat(frames), ["RSI", "MACD", "MACD_Signal"])


def test_chart_hides_lines_of_short_companies(spark):
    panel = make_panel({"A": 19, "B": 22, "C": 60})
    chart = chart_series(to_spark(spark, panel)).toPandas()
    shown = chart.groupby("company")[["SMA_20", "RSI", "MACD"]].count()
    assert shown.loc["A"].tolist() == [0, 0, 0]
    assert shown.loc["B"].tolist() == [3, 9, 0]
    assert shown.loc["C"].tolist() == [41, 47, 35]
    assert max(i.before for i in CHART) >= 529


def test_one_shuffle_and_one_sort_for_all_features(bars):
    plan = apply_indicators(bars, TECHNICAL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_no_frame_goes_through_many_rows_for_each_row(spark, bars):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        for df in (feature_table(bars, None), apply_indicators(bars, CHART)):
            plan = df._jdf.queryExecution().optimizedPlan().toString()
            frames = [int(n) for n in re.findall(r"RowFrame, -(\d+), currentrow", plan)]
            assert frames and max(frames) < 7
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.mark.parametrize("agg", [F.sum, F.avg, F.min, F.max, F.stddev_samp])
def test_windows_of_blocks_equal_plain_ones(spark, agg):
    rng = np.random.default_rng(11)
    # Large values with a small spread, equal values, a missing one and one far off.
    values = [*(1e7 + rng.random(60)), *[1e7 + 0.1] * 30, *rng.normal(0, 1, 60)]
    values[100], values[125] = None, 1e9
    rows = [("A", i, v if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows + [("B", i, float(i)) for i in range(19)], "k STRING, i INT, x DOUBLE")
    w = Window.partitionBy("k").orderBy("i")
    blocks = df.withColumns(rolling_blocks(agg, "x", F.col("x"), 5, w)).withColumns(earlier_blocks(agg, "x", 20, 5, w))
    got = blocks.withColumns({"plain": rolling(agg, F.col("x"), 20, w), "blocks": over_blocks(agg, "x", 20, 5)}).toPandas()
    assert (got.plain.isna() == got.blocks.isna()).all() and got.plain.notna().sum() == 150 - 19 - 20
    np.testing.assert_allclose(got.blocks, got.plain, rtol=1e-7, atol=1e-7)
    if agg is F.stddev_samp:
        assert (got.blocks[(got.k == "A") & got.i.between(79, 89)] == 0).all()
    with pytest.raises(ValueError):
        earlier_blocks(agg, "x", 12, 5, w)
