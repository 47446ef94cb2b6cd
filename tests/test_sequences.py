import numpy as np
import pyarrow as pa
import pytest
from panel import make_panel, to_spark
from pyspark.sql import functions as F

from tidemark.operators import labels, lagged, scaling, splits
from tidemark.plans import sequences

LOOKBACK = 12


@pytest.fixture(scope="module")
def panel():
    return make_panel({"A": 700, "B": 90, "C": 12, "D": 13})


@pytest.fixture(scope="module")
def bars(spark, panel):
    return to_spark(spark, panel).cache()


def by_company(panel):
    return [(name, rows.sort_values("dt").reset_index(drop=True)) for name, rows in panel.groupby("company")]


@pytest.mark.parametrize("chunk_rows", [20_000, 100, 40])
def test_expanded_sequences_hold_the_rows_before(bars, panel, chunk_rows):
    store = sequences.sequence_store(bars, ["close", "volume"], "high", LOOKBACK, chunk_rows=chunk_rows)
    got = sequences.expanded(store, ["close", "volume"], "high", LOOKBACK).toPandas()
    assert len(got) == sum(len(rows) - LOOKBACK for _, rows in by_company(panel))
    for name, rows in by_company(panel):
        values = rows[["close", "volume"]].to_numpy()
        actual = got[got.company == name].sort_values("dt").reset_index(drop=True)
        for i, row in actual.iterrows():
            np.testing.assert_array_equal(np.array([list(s) for s in row.sequence]), values[i:i + LOOKBACK])
            assert (row.target, row["dt"], row.position, row["size"]) == (rows.high[i + LOOKBACK], rows["dt"][i + LOOKBACK], i + 1, len(rows) - LOOKBACK)


@pytest.mark.parametrize("chunk_rows", [20_000, 100])
def test_readers_get_views(bars, panel, chunk_rows):
    store = sequences.sequence_store(bars, ["close", "volume"], "high", LOOKBACK, chunk_rows=chunk_rows)
    seen = {}
    for row in store.collect():
        rows = {name: row[name] for name in ("company", *sequences.LAYOUT, "close", "volume", "high")}
        chunk = sequences.chunk_of(rows, ["close", "volume"], "high", LOOKBACK, pa.array(row["dt"]))
        assert not len(chunk.y) or np.shares_memory(chunk.x, chunk.matrix)
        assert len(chunk.x) == len(chunk.y) == len(chunk.times) == len(chunk.places)
        for place, x, y in zip(chunk.places, chunk.x, chunk.y):
            assert (row["company"], place) not in seen
            seen[row["company"], place] = (x.copy(), y)
    for name, rows in by_company(panel):
        values = rows[["close", "volume"]].to_numpy()
        for place in range(LOOKBACK, len(rows)):
            x, y = seen[name, place]
            np.testing.assert_array_equal(x, values[place - LOOKBACK:place])
            assert y == rows.high[place]


def test_the_store_is_little_more_than_the_rows(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("concat('C', id % 2) AS company", "timestamp_ntz'2024-03-01' + make_dt_interval(0, 0, id) AS dt",
                                          "rand(1) AS a", "rand(2) AS b", "rand(3) AS y").coalesce(1)
    rows.write.parquet(str(tmp_path / "rows"))
    store = sequences.sequence_store(spark.read.parquet(str(tmp_path / "rows")), ["a", "b"], "y", 60, chunk_rows=5_000).coalesce(1)
    store.write.parquet(str(tmp_path / "store"))
    size = {name: sum(p.stat().st_size for p in (tmp_path / name).rglob("*.parquet")) for name in ("rows", "store")}
    assert size["store"] <= 1.2 * size["rows"]
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.selectExpr("sum(size(a) - halo)").first()[0] == 60_000 and stored.count() > 10
    assert sequences.expanded(stored, ["a", "b"], "y", 60).count() == 60_000 - 120


def plain_ridge(x, y, lookback, share, penalty):
    n = len(x) - lookback
    design = np.array([x[i:i + lookback][::-1].ravel() for i in range(n)])
    goal, train = y[lookback:], int(n * share)
    mean, level = design[:train].mean(axis=0), goal[:train].mean()
    centred = design[:train] - mean
    weights = np.linalg.solve(centred.T @ centred + penalty * np.eye(design.shape[1]), centred.T @ (goal[:train] - level))
    intercept = level - mean @ weights
    return intercept, weights, goal[train:], design[train:] @ weights + intercept


@pytest.mark.parametrize("chunk_rows", [20_000, 100, 40])
def test_lagged_moments_give_the_plain_regression(bars, panel, chunk_rows):
    sets = {"one": ["close"], "three": ["volume", "close", "open"]}
    rows = bars.withColumns({c: F.col(c) / 100 for c in ("close", "volume", "open")})
    store = sequences.sequence_store(rows, ["close", "volume", "open"], "high", LOOKBACK, chunk_rows=chunk_rows).cache()
    models = lagged.lagged_ridge(store, sets, "high", LOOKBACK, 0.8, 0.5).cache()
    found = {(r.company, r.model): r for r in models.collect()}
    guessed = lagged.predicted(store, models, sets, "high", LOOKBACK).toPandas()
    assert {name for name, _ in found} == {"A", "B"}
    for name, rows in by_company(panel):
        if len(rows) <= LOOKBACK + 1:
            assert not len(guessed[guessed.company == name])
            continue
        for model, features in sets.items():
            x = rows[features].to_numpy() / 100
            intercept, weights, truth, guess = plain_ridge(x, rows.high.to_numpy(), LOOKBACK, 0.8, 0.5)
            np.testing.assert_allclose(found[name, model].weights, weights, atol=1e-7)
            assert abs(found[name, model].intercept - intercept) < 1e-6
            mine = guessed[(guessed.company == name) & (guessed.model == model)].sort_values("dt")
            np.testing.assert_array_equal(mine.y_true, truth)
            np.testing.assert_allclose(mine.y_pred, guess, atol=1e-6)
            assert list(mine["dt"]) == list(rows["dt"][-len(truth):])
    trained = lagged.predicted(store, models, sets, "high", LOOKBACK, train=True)
    assert trained.count() == 2 * (int(688 * 0.8) + int(78 * 0.8))


def test_empty_tables_and_names_of_the_store(bars):
    empty = sequences.sequence_store(bars.where("false"), ["close"], "high", LOOKBACK)
    assert empty.collect() == [] and sequences.expanded(empty, ["close"], "high", LOOKBACK).collect() == []
    assert lagged.lagged_ridge(empty, {"m": ["close"]}, "high", LOOKBACK).collect() == []
    with pytest.raises(ValueError, match="store's own"):
        sequences.sequence_store(bars.withColumnRenamed("close", "first"), ["first"], "high")


def test_scaled_on_what_training_sequences_cover(bars, panel):
    rows = labels.return_targets(bars)
    scaled = scaling.min_max(splits.seen_by_sequences(rows, LOOKBACK), ["close"], F.col("is_seen"), ["company"]).toPandas()
    for name, one in scaled.groupby("company"):
        seen = one[one.is_seen]
        if len(one) > LOOKBACK + 2:
            assert len(seen) == int((len(one) - LOOKBACK) * 0.8) + LOOKBACK - 1
            assert seen.close.min() == 0.0 and abs(seen.close.max() - 1) < 1e-12
