import datetime as dt

import numpy as np
import pandas as pd
import pytest
from panel import make_panel, to_spark
from pyspark.sql import functions as F

from tidemark.operators import labels, metrics, models, scaling, splits, technical, windows


@pytest.fixture(scope="module")
def panel():
    return make_panel({"A": 300, "B": 90, "C": 12})


@pytest.fixture(scope="module")
def bars(spark, panel):
    return to_spark(spark, panel).cache()


def by_company(panel):
    return [(name, rows.sort_values("dt").reset_index(drop=True)) for name, rows in panel.groupby("company")]


def test_label_is_the_one_day_return_five_rows_ahead(bars, panel):
    returns = technical.returns_and_momentum(bars).select("company", "dt", "Return_1")
    for layout in ({}, {"segment_rows": 90}):
        got = labels.direction_label(returns, **layout).toPandas().sort_values(["company", "dt"])
        for name, rows in by_company(panel):
            expected = (rows.close / rows.close.shift(1) - 1).shift(-5).dropna().to_numpy()
            actual = got[got.company == name]
            np.testing.assert_allclose(actual.Future_Return, expected, atol=1e-12)
            assert list(actual.Target) == list((expected > 0).astype(int))


def test_return_targets_drop_both_ends(bars):
    counts = {r["company"]: r["count"] for r in labels.return_targets(bars).groupBy("company").count().collect()}
    assert counts == {"A": 300 - 6, "B": 90 - 6, "C": 12 - 6}


def test_log_return_features(bars, panel):
    got = labels.log_return_features(bars, segment_rows=100).toPandas().sort_values(["company", "dt"])
    for name, rows in by_company(panel):
        rows["log_return"] = np.log(rows.close / rows.close.shift(1))
        rows["Volatility_5"] = rows.log_return.rolling(5).std()
        rows["Momentum_3"] = rows.close / rows.close.shift(3) - 1
        rows["Volume_Change"] = rows.volume / rows.volume.shift(1) - 1
        rows["Direction"] = (rows.log_return.shift(-1) > 0).astype(int)
        expected = rows.replace([np.inf, -np.inf], np.nan).dropna()
        actual = got[got.company == name]
        assert list(actual.dt) == list(expected.dt)
        for column in ("log_return", "Volatility_5", "Momentum_3", "Volume_Change", "Direction"):
            np.testing.assert_allclose(actual[column], expected[column], atol=1e-12)
    without = labels.log_return_features(bars.drop("volume"))
    assert {r[0] for r in without.select("Volume_Change").distinct().collect()} == {0.0}


@pytest.mark.parametrize("layout", [{}, {"segment_rows": 100}])
def test_sequences_hold_the_rows_before(bars, panel, layout):
    got = labels.sequences(bars, ["close", "volume"], "high", 20, **layout).toPandas()
    assert len(got) == 280 + 70
    for name, rows in by_company(panel):
        values = rows[["close", "volume"]].to_numpy()
        actual = got[got.company == name].sort_values("dt").reset_index(drop=True)
        for i, row in actual.iterrows():
            np.testing.assert_array_equal(np.array([list(s) for s in row.sequence]), values[i:i + 20])
            assert row.target == rows.high[i + 20] and row["dt"] == rows["dt"][i + 20]


@pytest.mark.parametrize("layout", [{}, {"segment_rows": 64}])
def test_positional_split(bars, layout):
    split = splits.by_position(bars, **layout).toPandas()
    for name, n in (("A", 300), ("B", 90), ("C", 12)):
        rows = split[split.company == name].sort_values("dt")
        train = int(n * 0.8)
        assert list(rows.is_train) == [True] * train + [False] * (n - train)
        fitted = int(np.floor(train * (1 - 0.1)))
        assert list(rows.is_validation) == [False] * fitted + [True] * (train - fitted) + [False] * (n - train)


def test_seen_rows_are_those_of_training_sequences(bars):
    seen = splits.seen_by_sequences(bars, 20).where("is_seen").groupBy("company").count()
    assert {r["company"]: r["count"] for r in seen.collect()} == {
        "A": int(280 * 0.8) + 19, "B": int(70 * 0.8) + 19, "C": 12}


def test_date_quantile_interpolates(bars, panel):
    limit = pd.to_datetime(panel.dt).quantile(0.8)
    train = splits.by_date_quantile(bars).where("is_train").count()
    assert train == (pd.to_datetime(panel.dt) <= limit).sum()


def test_min_max_fits_on_training_rows_and_inverts(bars):
    split = splits.by_position(bars).withColumn("flat", F.lit(3.0)).withColumn("y", F.col("close"))
    for by in (["company"], []):
        scaled = scaling.min_max(split, ["y", "flat"], F.col("is_train"), by, keep_bounds=True)
        rows = scaled.withColumn("back", scaling.undo_min_max(F.col("y"), "y")).toPandas()
        np.testing.assert_allclose(rows.back, rows.close, atol=1e-9)
        assert set(rows.flat) == {0.0}
        for _, group in (rows.groupby("company") if by else [("", rows)]):
            train = group[group.is_train]
            assert train.y.min() == 0.0 and abs(train.y.max() - 1.0) < 1e-12


def test_standard_uses_population_deviation(bars, panel):
    scaled = scaling.standard(bars.withColumn("flat", F.lit(2.0)), ["volume", "flat"], F.col("company") == "A")
    rows = scaled.toPandas().sort_values(["company", "dt"])
    fit = panel[panel.company == "A"].volume
    expected = (panel.sort_values(["company", "dt"]).volume - fit.mean()) / fit.std(ddof=0)
    np.testing.assert_allclose(rows.volume, expected, atol=1e-9)
    assert set(rows.flat) == {0.0}


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 9])
def test_auc_is_exact_with_and_without_ties(spark, digits):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"g": rng.choice(["a", "b"], 9000, p=[0.9, 0.1]), "label": rng.integers(0, 2, 9000)})
    # Crowded scores: most lie within a tiny part of the range.
    frame["prob"] = np.round(0.5 + rng.normal(0, 0.001, 9000) * rng.integers(1, 100, 9000), digits)
    df = spark.createDataFrame(frame).cache()
    got = {r.g: r.roc_auc for r in metrics.roc_auc(df, ["g"]).collect()}
    for g, rows in frame.groupby("g"):
        assert abs(got[g] - brute_auc(rows.label.to_numpy(), rows.prob.to_numpy())) < 1e-12
    whole = metrics.roc_auc(df).first().roc_auc
    assert abs(whole - brute_auc(frame.label.to_numpy(), frame.prob.to_numpy())) < 1e-12


def test_undefined_measures(spark):
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.4)], "label INT, prob DOUBLE")
    row = metrics.classification_metrics(one_class).first()
    assert (row.accuracy, row.f1, row.mcc, row.roc_auc) == (0.0, 0.0, 0.0, None)
    errors = metrics.regression_metrics(spark.createDataFrame(
        [(0.0, 0.0), (0.0, 1.0), (2.0, 1.0), (-1.0, -3.0)], "y_true DOUBLE, y_pred DOUBLE")).first()
    assert (errors.directional_accuracy, errors.mae) == (75.0, 1.0)
    assert abs(errors.rmse - np.sqrt(6 / 4)) < 1e-12 and abs(errors.mape - (50 + 200) / 2) < 1e-9


def test_feature_importance_ranks_the_informative_feature(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 500)
    frame = pd.DataFrame({"Target": y, "good": y + rng.normal(0, 0.5, 500), "noise": rng.normal(0, 1, 500),
                          "flat": 1.0, "weak": 0.3 * y + rng.normal(0, 1, 500)})
    rows = {r.feature: r for r in metrics.feature_importance(
        spark.createDataFrame(frame), ["good", "noise", "flat", "weak"], top=2).collect()}
    groups = [frame.good[y == k] for k in (0, 1)]
    grand = frame.good.mean()
    between = sum(len(g) * (g.mean() - grand) ** 2 for g in groups)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 498
    assert abs(rows["good"].score - between / within) < 1e-6
    assert rows["flat"].score is None
    assert [n for n, r in rows.items() if r.selected and n == "good"] and sum(r.selected for r in rows.values()) == 2


def training_rows(spark, sizes):
    rng = np.random.default_rng(11)
    frames = []
    for name, n in sizes.items():
        x = rng.normal(0, 1, (n, 2))
        y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(0, 0.7, n) > 0).astype(int)
        days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)]
        frames.append(pd.DataFrame({"company": name, "dt": days, "u": x[:, 0], "v": x[:, 1], "Target": y}))
    frames.append(pd.DataFrame({"company": "ONE CLASS", "dt": days[:10], "u": 1.0, "v": 0.0, "Target": 1}))
    df = spark.createDataFrame(pd.concat(frames), "company STRING, dt DATE, u DOUBLE, v DOUBLE, Target INT")
    return splits.by_position(df).cache()


def test_weights_are_optimal_for_short_and_long_companies(spark):
    split = training_rows(spark, {"A": 4000, "B": 80}).withColumnRenamed("Target", "label").where("is_train")
    rows = split.toPandas()
    weights = {r.company: np.array(r.weights) for r in models.logistic_weights(split, ["u", "v"]).collect()}
    assert set(weights) == {"A", "B"}
    for name, w in weights.items():
        one = rows[rows.company == name]
        x, y = one[["u", "v"]].to_numpy(), one.label.to_numpy()
        p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
        gradient = np.append(x.T @ (p - y) + w[:-1], (p - y).sum())
        assert np.abs(gradient).max() < 1e-7
    # A company's weights do not depend on the others, nor on how its rows are dealt.
    alone = models.logistic_weights(split.where("company = 'B'").repartition(7), ["u", "v"]).first()
    np.testing.assert_allclose(alone.weights, weights["B"], atol=1e-9)
    with pytest.raises(RuntimeError, match="no convergence"):
        models.logistic_weights(split, ["u", "v"], steps=1)


def test_scores_of_companies(spark):
    split = training_rows(spark, {"A": 400, "B": 80})
    scored = models.logistic_per_company(split, ["u", "v"]).toPandas()
    assert len(scored) == 80 + 16 + 2
    assert set(scored[scored.company == "ONE CLASS"].prob) == {1.0}
    table = metrics.probability_experiment_table(
        spark.createDataFrame(scored.assign(model="Logistic"))).toPandas()
    assert table.columns.tolist() == ["Company", "Model", "DA (%)", "MAE", "RMSE"]
    assert table.set_index("Company")["DA (%)"]["A"] > 70


def test_sequence_models_and_saved_model(spark, bars, tmp_path):
    targets = labels.return_targets(bars)
    built = labels.sequences(targets, ["Return", "close"], lookback=10)
    predicted = models.sequence_regressor(splits.by_position(built), max_iter=3)
    sizes = {"A": 300 - 16, "B": 90 - 16}
    assert predicted.count() == sum(n - int(n * 0.8) for n in sizes.values())
    assert predicted.where("y_pred IS NULL OR isnan(y_pred)").count() == 0

    table = technical.moving_averages(technical.returns_and_momentum(bars)).dropna()
    labelled = labels.direction_label(table, horizon=1).withColumnRenamed("Target", "label")
    path = str(tmp_path / "model")
    models.train_next_day_model(labelled, path)
    latest = models.score_latest(table, path).collect()
    assert {r.company for r in latest} == {"A", "B"} and {r.trend for r in latest} <= {"UP", "DOWN"}
    assert {r.dt for r in latest} == {r.dt for r in windows.newest_row(table).collect()}
    short = table.withColumn("MA_20", F.when(F.col("company") == "A", F.col("MA_20")))
    assert {r.company: r.trend is None for r in models.score_latest(short, path).collect()} == {"A": False, "B": True}


def test_date_quantile_of_times(spark):
    times = [dt.datetime(2024, 1, 1, hour) for hour in range(10)] + [dt.datetime(2024, 1, 2, hour) for hour in range(3)]
    rows = spark.createDataFrame([(t,) for t in times], "dt timestamp_ntz")
    numbers = np.array([t.timestamp() for t in times])
    for share in (0.0, 0.3, 0.76, 0.8, 1.0):
        kept = {r.dt for r in splits.by_date_quantile(rows, share).where("is_train").collect()}
        assert kept == {t for t, n in zip(times, numbers) if n <= np.quantile(numbers, share)}


def test_rows_without_a_key_are_scaled_too(spark):
    rows = spark.createDataFrame([("A", dt.date(2024, 1, 1), 1.0), (None, dt.date(2024, 1, 1), 2.0), (None, None, 4.0), ("A", None, 3.0)],
                                 "company string, dt date, y double")
    scaled = scaling.min_max(rows, ["y"], F.lit(True), ["company"]).collect()
    assert sorted(r.y for r in scaled) == [0.0, 0.0, 1.0, 1.0]
