"""The three experiments: from a table of features to rows of results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import labels, lagged, metrics, models, scaling, splits, windows
from tidemark.plans import sequences
from tidemark.plans.features import TABLE_NAMES
from tidemark.plans.staging import stored

# Fixed values of the experiments.
YEARS = 7
AVERAGES = ("MA_10", "MA_20")
POOLED_FEATURES = ("close", "sentiment", "Volatility_5", "Momentum_3", "Volume_Change")


def canonical_names(table: DataFrame) -> DataFrame:
    """A finished feature table under the names the operators use."""
    back = {final: name for name, final in TABLE_NAMES.items() if final in table.columns}
    return table.withColumnsRenamed(back)


def _chosen(table: DataFrame, companies: Sequence[str] | None, years: int) -> DataFrame:
    if companies is not None:
        table = table.where(F.col("company").isin(list(companies)))
    return windows.recent_years(table, years)


def _feature_sets(table: DataFrame, base: Sequence[str], name: str) -> dict[str, list[str]]:
    """The features without sentiment and, where there is any, with it."""
    sets = {f"{name} (No Sentiment)": list(base)}
    if "sentiment" in table.columns:
        sets[f"{name} + Sentiment"] = [*base, "sentiment"]
    return sets


def _appended(tables: list[DataFrame]) -> DataFrame:
    united = tables[0]
    for table in tables[1:]:
        united = united.unionByName(table)
    return united


def logistic_experiment(table: DataFrame, companies: Sequence[str] | None = None,
                        years: int = YEARS) -> DataFrame:
    """Per company and feature set: a logistic regression on the first 80 % of its rows, judged on
    the rest (Company, Model, DA (%), MAE, RMSE).

    ``table`` has company, dt, Return_1, MA_10, MA_20 and perhaps sentiment.
    """
    base = ("Return_1", *AVERAGES)
    sets = _feature_sets(table, base, "Logistic")
    columns = dict.fromkeys(name for features in sets.values() for name in features)
    labelled = labels.direction_label(_chosen(table.select("company", "dt", *columns), companies, years))
    split = stored(splits.by_position(labelled.dropna()), "logistic_rows")
    return metrics.probability_experiment_table(models.logistic_scores(split, sets))


def sequence_inputs(table: DataFrame, companies: Sequence[str] | None = None, years: int = YEARS,
                    lookback: int = labels.LOOKBACK) -> tuple[DataFrame, dict[str, list[str]]]:
    """The stored sequences that the regressions learn from, and their feature sets.

    ``table`` has company, dt, close, MA_10, MA_20 and perhaps sentiment. Features are scaled to 0-1 on the
    rows that each company's training sequences cover, so nothing of the later rows is known.
    """
    sets = _feature_sets(table, ("Return", *AVERAGES), "Return Sequence")
    features = list(dict.fromkeys(name for chosen in sets.values() for name in chosen))
    optional = ["sentiment"] if "sentiment" in table.columns else []
    narrow = table.select("company", "dt", "close", *AVERAGES, *optional)
    rows = stored(labels.return_targets(_chosen(narrow, companies, years)), "sequence_rows")
    seen = splits.seen_by_sequences(rows, lookback)
    scaled = scaling.min_max(seen, features, F.col("is_seen"), by=["company"])
    return stored(sequences.sequence_store(scaled, features, lookback=lookback), "sequence_store"), sets


def sequence_experiment(table: DataFrame, companies: Sequence[str] | None = None, years: int = YEARS,
                        lookback: int = labels.LOOKBACK, learner: str = "ridge", max_iter: int = 20) -> DataFrame:
    """Per company and feature set: the return five rows ahead, predicted from the ``lookback`` rows before
    (Company, Model, DA (%), MAE, RMSE). See ``sequence_inputs`` for the table.

    ``learner`` is "ridge", a linear model per company on all steps, or "trees", boosted trees over all
    companies together.
    """
    store, sets = sequence_inputs(table, companies, years, lookback)
    if learner == "ridge":
        fitted = stored(lagged.lagged_ridge(store, sets, lookback=lookback), "sequence_models")
        return metrics.experiment_table(lagged.predicted(store, fitted, sets, lookback=lookback))
    if learner != "trees":
        raise ValueError(f"no such learner: {learner}")
    scored = []
    for name, features in sets.items():
        built = splits.flagged(sequences.expanded(store, features, lookback=lookback))
        scored.append(models.sequence_regressor(built, max_iter=max_iter).withColumn("model", F.lit(name)))
    return metrics.experiment_table(_appended(scored))


def pooled_scores(bars: DataFrame, years: int = YEARS, lookback: int = labels.POOLED_LOOKBACK) -> DataFrame:
    """company, dt, label and prob of the held-out sequences of all companies; see ``pooled_experiment``."""
    recent = windows.recent_days_overall(
        bars.select("company", "dt", "close", "volume", "sentiment"), 365 * years)
    rows = stored(labels.log_return_features(recent), "pooled_rows")
    scaled = scaling.standard(splits.by_date_quantile(rows), POOLED_FEATURES, F.col("is_train"))
    tagged = scaled.withColumn("part", F.when(F.col("is_train"), "train").otherwise("test"))
    by = ["part", "company"]
    store = stored(sequences.sequence_store(tagged, POOLED_FEATURES, "Direction", lookback, by), "pooled_store")
    built = sequences.expanded(store, POOLED_FEATURES, "Direction", lookback, by)
    return stored(models.sequence_classifier(built.withColumn("is_train", F.col("part") == "train")), "pooled_scores")


def pooled_experiment(bars: DataFrame, years: int = YEARS,
                      lookback: int = labels.POOLED_LOOKBACK) -> DataFrame:
    """Next-day direction of all companies together from ``lookback`` standardised rows, trained on
    the days up to the 80 % quantile (Model, Accuracy_%, ROC_AUC, F1_Score, MCC).

    ``bars`` has company, dt, close, volume and sentiment.
    """
    scored = pooled_scores(bars, years, lookback)
    return metrics.classification_metrics(scored).select(
        F.lit("Pooled Sequence Classifier").alias("Model"),
        F.round("accuracy", 2).alias("Accuracy_%"), F.round("roc_auc", 4).alias("ROC_AUC"),
        F.round("f1", 4).alias("F1_Score"), F.round("mcc", 4).alias("MCC"))
