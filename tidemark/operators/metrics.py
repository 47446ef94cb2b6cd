"""Quality measures of predictions, computed per group as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

# Ranges of scores, 2 to this power, used to spread a ranking over tasks.
RANGE_BITS = 12


def _share(condition: Column) -> Column:
    return F.avg(condition.cast("double")) * 100


def regression_metrics(df: DataFrame, by: Sequence[str] = (), actual: str = "y_true",
                       predicted: str = "y_pred") -> DataFrame:
    """Directional accuracy (signs agree, in percent), MAE, RMSE and MAPE (rows with actual 0 are
    left out of MAPE)."""
    y, p = F.col(actual), F.col(predicted)
    return df.groupBy(*by).agg(
        _share(F.signum(y) == F.signum(p)).alias("directional_accuracy"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        (F.avg(F.abs(F.try_divide(y - p, y))) * 100).alias("mape"),
    )


def classification_metrics(df: DataFrame, by: Sequence[str] = (), label: str = "label",
                           probability: str = "prob", threshold: float = 0.5) -> DataFrame:
    """Accuracy in percent, exact ROC AUC with ties, F1 and MCC (both 0 where undefined).

    AUC is NULL when only one class occurs.
    """
    y, called = F.col(label) == 1, F.col(probability) > threshold

    def count(condition: Column) -> Column:
        return F.count_if(condition).cast("double")

    tp, fp, fn, tn = (F.col(name) for name in ("_tp", "_fp", "_fn", "_tn"))
    counts = df.groupBy(*by).agg(
        count(y & called).alias("_tp"), count(~y & called).alias("_fp"),
        count(y & ~called).alias("_fn"), count(~y & ~called).alias("_tn"))
    spread = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    scores = counts.select(
        *by,
        ((tp + tn) / (tp + fp + fn + tn) * 100).alias("accuracy"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0)).alias("f1"),
        F.coalesce(F.try_divide(tp * tn - fp * fn, spread), F.lit(0.0)).alias("mcc"),
    )
    ranked = roc_auc(df, by, label, probability)
    if by:
        return scores.join(ranked, list(by))
    return scores.withColumn("roc_auc", ranked.select("roc_auc").scalar())


def roc_auc(df: DataFrame, by: Sequence[str] = (), label: str = "label",
            probability: str = "prob") -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs ranked rightly,
    ties counting half.

    No group is sorted in one task. Equal scores are merged first; the distinct scores are cut
    into ranges at their approximate quantiles, so no range of any group holds more than about
    1/4096 of them however they are distributed; a running count inside each range and one over
    the range totals of a group then give exact ranks. Where the cuts lie has no effect on the
    result.
    """
    by = list(by)
    y, score = F.col(label) == 1, F.col(probability)
    distinct = df.where(score.isNotNull()).groupBy(*by, score.alias("_score")).agg(
        F.count_if(y).alias("_pos"), F.count_if(~y).alias("_neg"))
    parts = 2 ** RANGE_BITS
    marks = ", ".join(f"{i / parts}D" for i in range(1, parts))
    cuts = distinct.agg(F.expr(f"percentile_approx(_score, array({marks}), {4 * parts})")).scalar()
    ranges = (
        distinct.withColumn("_cuts", cuts)
        .withColumn("_range", _cuts_below(F.col("_score"), F.col("_cuts"))).drop("_cuts")
    )

    before = Window.unboundedPreceding, -1
    inside = Window.partitionBy(*by, "_range").orderBy("_score").rowsBetween(*before)
    lower_inside = F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    totals = (
        ranges.withColumn("_right", F.col("_pos") * (lower_inside + F.col("_neg") / 2.0))
        .groupBy(*by, "_range")
        .agg(F.sum("_right").alias("_right"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    )
    # At most 4096 rows per group from here on.
    across = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_range").rowsBetween(*before)
    lower_ranges = F.coalesce(F.sum("_neg").over(across), F.lit(0))
    return (
        totals.withColumn("_right", F.col("_right") + F.col("_pos") * lower_ranges)
        .groupBy(*by)
        .agg(F.try_divide(F.sum("_right"), (F.sum("_pos") * F.sum("_neg")).cast("double")).alias("roc_auc"))
    )


def _cuts_below(score: Column, cuts: Column) -> Column:
    """How many of the sorted cuts are below the score, by halving."""
    steps = F.array(*(F.lit(2 ** bit) for bit in reversed(range(RANGE_BITS))))
    return F.aggregate(steps, F.lit(0), lambda found, step: F.when(
        F.get(cuts, found + step - 1) < score, found + step).otherwise(found))


def experiment_table(predictions: DataFrame, company: str = "company", model: str = "model") -> DataFrame:
    """One rounded result row per company and model, as in the published result tables."""
    measured = regression_metrics(predictions, [company, model])
    return _result_rows(measured, company, model, F.col("directional_accuracy"))


def probability_experiment_table(predictions: DataFrame, company: str = "company",
                                 model: str = "model") -> DataFrame:
    """The same table for a classifier: accuracy of the class, errors of the probability."""
    y, p = F.col("label").cast("double"), F.col("prob")
    measured = predictions.groupBy(company, model).agg(
        _share(F.col("label") == F.col("prediction")).alias("accuracy"),
        F.avg(F.abs(y - p)).alias("mae"), F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"))
    return _result_rows(measured, company, model, F.col("accuracy"))


def _result_rows(measured: DataFrame, company: str, model: str, accuracy: Column) -> DataFrame:
    return measured.select(
        F.col(company).alias("Company"), F.col(model).alias("Model"),
        F.round(accuracy, 2).alias("DA (%)"), F.round("mae", 6).alias("MAE"),
        F.round("rmse", 6).alias("RMSE"))


def feature_importance(df: DataFrame, features: Sequence[str], label: str = "Target",
                       top: int = 3) -> DataFrame:
    """ANOVA F score of each feature against the class, with the ``top`` best selected.

    One aggregation per class (combined before its shuffle) gives counts, means and variances;
    the rest works on one row per class and feature.
    """
    stats = F.array(*(
        F.struct(F.lit(name).alias("feature"), F.count(name).alias("n"), F.avg(name).alias("mean"),
                 F.var_pop(name).alias("variance"))
        for name in features))
    per_class = df.groupBy(label).agg(stats.alias("stats")).select(F.inline("stats"))
    overall = Window.partitionBy("feature")
    n, mean = F.col("n"), F.col("mean")
    grand = F.sum(n * mean).over(overall) / F.sum(n).over(overall)
    scored = (
        per_class.where(n > 0).withColumn("_grand", grand).groupBy("feature").agg(
            F.sum(n * (mean - F.col("_grand")) * (mean - F.col("_grand"))).alias("_between"),
            F.sum(n * F.col("variance")).alias("_within"),
            F.sum(n).alias("_rows"), F.count(F.lit(1)).alias("_classes"))
        .select("feature", F.try_divide(
            F.col("_between") / (F.col("_classes") - 1),
            F.col("_within") / (F.col("_rows") - F.col("_classes"))).alias("score"))
    )
    # One row per feature.
    best_first = Window.partitionBy(F.lit(0)).orderBy(F.col("score").desc_nulls_last(), "feature")
    return scored.withColumn("selected", F.row_number().over(best_first) <= top)
