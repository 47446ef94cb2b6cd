"""Baseline models: logistic regressions of all companies and feature sets at once, and Spark ML models on sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.scaling import min_max, undo_min_max
from tidemark.operators.windows import newest_row
from tidemark.plans.staging import broadcast_if_small, stored

# The columns the next-day model looks at.
LATEST_FEATURES = ("open", "high", "low", "close", "volume", "MA_10", "MA_20")

# Newton steps before a fit counts as failed, and the largest slope of the objective where it has converged.
LOGISTIC_STEPS, LOGISTIC_SLOPE = 50, 1e-8

# Bytes of fits that may be sent to every task.
LIGHT = 64_000_000


def logistic_grid(train: DataFrame, sets: Mapping[str, Sequence[str]], label: str = "label", penalty: float = 1.0,
                  steps: int = LOGISTIC_STEPS, slope: float = LOGISTIC_SLOPE) -> DataFrame:
    """company, weights ARRAY<ARRAY<DOUBLE>> and slopes: for every company and every set of features, in the order of
    ``sets``, the minimum of log loss + penalty * |w|^2 / 2, by Newton's method.

    Weights stand in the order of all features, the intercept last and not penalised; a feature outside
    the set has none. A step is one aggregation over the rows for all companies and sets: slope,
    curvature and loss, combined before the shuffle, however long a company is. A small equation per
    company and set follows, solved in place; a step that makes the loss larger is taken back by half. A
    company whose rows are all of one class has no minimum and is left out. A company that does not
    converge within ``steps`` fails the job.
    """
    features = list(dict.fromkeys(name for chosen in sets.values() for name in chosen))
    size = len(features) + 1
    inputs = [[*(features.index(name) for name in dict.fromkeys(chosen)), size - 1] for chosen in sets.values()]
    both = train.groupBy("company").agg(F.min(label).alias("low"), F.max(label).alias("high")).where("low < high")
    zeros = F.array(*[F.lit(0.0)] * size)
    start = F.struct(zeros.alias("base"), zeros.alias("move"), F.lit(float("inf")).alias("loss"), F.lit(float("inf")).alias("slope"))
    state = stored(both.select("company", F.array(*[start] * len(sets)).alias("fits")), "fits")
    # The companies stay the same from step to step, and so does the size of their fits.
    light = state.count() * (8 * len(sets) * (2 * size + 2) + 64) <= LIGHT
    x = [*(F.col(name).cast("double") for name in features), F.lit(1.0)]
    goal = F.col(label).cast("double")
    for _ in range(steps):
        rows = train.join(F.broadcast(state) if light else state, "company").select(
            "company", "fits", goal.alias("_goal"), *(value.alias(f"_x{i}") for i, value in enumerate(x)),
            *(_dot_of(F.get("fits", F.lit(s)), x, at).alias(f"_z{s}") for s, at in enumerate(inputs)))
        sums = rows.groupBy("company").agg(F.any_value("fits").alias("fits"), *(
            _sums_of(s, at).alias(f"_sums{s}") for s, at in enumerate(inputs)))
        moved = F.array(*(_moved(F.get("fits", F.lit(s)), F.col(f"_sums{s}"), at, size, penalty) for s, at in enumerate(inputs)))
        state = stored(sums.select("company", moved.alias("fits")), "fits")
        worst = state.agg(F.max(F.array_max(F.transform("fits", lambda fit: fit["slope"])))).first()[0] or 0.0
        if worst < slope:
            # The slope is the one before the last step, so these weights are a step better than it says.
            return state.select("company", F.transform("fits", _trial).alias("weights"), F.col("fits.slope").alias("slopes"))
    steep = F.exists("fits", lambda fit: fit["slope"] >= slope)
    failed = [row["company"] for row in state.where(steep).select("company").limit(5).collect()]
    raise RuntimeError(f"no convergence within {steps} steps, for example: {failed}")


def logistic_weights(train: DataFrame, features: Sequence[str], label: str = "label", penalty: float = 1.0,
                     steps: int = LOGISTIC_STEPS, slope: float = LOGISTIC_SLOPE) -> DataFrame:
    """company, weights (intercept last) and slope: ``logistic_grid`` for one set of features."""
    found = logistic_grid(train, {"all": features}, label, penalty, steps, slope)
    return found.select("company", F.get("weights", F.lit(0)).alias("weights"), F.get("slopes", F.lit(0)).alias("slope"))


def _trial(fit: Column) -> Column:
    return F.zip_with(fit["base"], fit["move"], lambda a, b: a + b)


def _dot_of(fit: Column, x: Sequence[Column], at: Sequence[int]) -> Column:
    """Product of the row's inputs and the weights under trial."""
    weight = lambda i: F.get(fit["base"], F.lit(i)) + F.get(fit["move"], F.lit(i))
    return sum((weight(i) * x[i] for i in at[1:]), weight(at[0]) * x[at[0]])


def _sums_of(s: int, at: Sequence[int]) -> Column:
    """Loss, slope and the upper triangle of the curvature over a company's rows, for one set."""
    z, goal = F.col(f"_z{s}"), F.col("_goal")
    p = 1 / (1 + F.exp(-z))
    loss = F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - goal * z
    x = [F.col(f"_x{i}") for i in at]
    pairs = [(i, j) for i in range(len(at)) for j in range(i, len(at))]
    return F.array(F.sum(loss), *(F.sum((p - goal) * c) for c in x), *(F.sum(p * (1 - p) * x[i] * x[j]) for i, j in pairs))


def _moved(fit: Column, sums: Column, at: Sequence[int], size: int, penalty: float) -> Column:
    """The fit after one step of Newton's method, or with half the last move if that did not help."""
    m, trial = len(at), _trial(fit)
    place = {(at[i], at[j]): 1 + m + k for k, (i, j) in enumerate((i, j) for i in range(m) for j in range(i, m))}
    held = {i: penalty if i < size - 1 else 0.0 for i in range(size)}
    loss = F.get(sums, F.lit(0)) + sum((F.get(trial, F.lit(i)) ** 2 * (held[i] / 2) for i in at[:-1]), F.lit(0.0))
    slopes = [F.get(sums, F.lit(1 + at.index(i))) + held[i] * F.get(trial, F.lit(i)) if i in at else F.lit(0.0) for i in range(size)]

    def entry(i: int, j: int) -> Column:
        if i not in at or j not in at:
            return F.lit(float(i == j))
        found = F.get(sums, F.lit(place.get((i, j), place.get((j, i)))))
        return found + held[i] if i == j else found

    matrix = F.array(*(F.array(*(entry(i, j) for j in range(size)), -slopes[i]) for i in range(size)))
    better = loss <= fit["loss"] * (1 + 1e-12) + 1e-12
    return F.when(better, F.struct(
        trial.alias("base"), solved(matrix, size).alias("move"), loss.alias("loss"), F.greatest(*map(F.abs, slopes), F.lit(0.0)).alias("slope"),
    )).otherwise(F.struct(fit["base"].alias("base"), F.transform(fit["move"], lambda v: v / 2).alias("move"),
                          fit["loss"].alias("loss"), fit["slope"].alias("slope")))


def solved(matrix: Column, size: int) -> Column:
    """The solution of a small symmetric positive system, given as ``size`` rows that end in the right-hand side."""
    def eliminated(rows: Column, k: Column) -> Column:
        lead = F.transform(F.get(rows, k), lambda v: v / F.get(F.get(rows, k), k))
        return F.transform(rows, lambda row, i: F.when(i == k, lead).otherwise(
            F.zip_with(row, lead, lambda a, b: a - F.get(row, k) * b)))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), matrix, eliminated)
    return F.transform(done, lambda row: F.get(row, F.lit(size)))


def logistic_scores(split: DataFrame, sets: Mapping[str, Sequence[str]], label: str = "Target") -> DataFrame:
    """company, dt, model, label, prob and prediction of the test rows, for every set of features.

    ``split`` has ``is_train``. Features are scaled to 0-1 on each company's training rows, and all models
    are fitted together. A company whose training rows are all of one class is given that class; one
    without training rows gets NaN.
    """
    features = list(dict.fromkeys(name for chosen in sets.values() for name in chosen))
    scaled = min_max(split, features, F.col("is_train"), by=["company"])
    rows = stored(scaled.select("company", "dt", "is_train", F.col(label).cast("int").alias("label"), *features), "scaled")
    train = rows.where("is_train")
    fits = logistic_grid(train, sets)
    share = train.groupBy("company").agg(F.avg("label").alias("share"))
    known = stored(share.join(fits, "company", "left"), "fits")
    scored = rows.where("NOT is_train").join(
        broadcast_if_small(known, LIGHT // (8 * len(sets) * (len(features) + 2) + 64)), "company", "left")
    each = F.array(*(F.struct(F.lit(name).alias("model"), F.get("weights", F.lit(s)).alias("w")) for s, name in enumerate(sets)))
    scored = scored.select("company", "dt", "label", "share", *features, F.inline(each))
    x = [*(F.col(name).cast("double") for name in features), F.lit(1.0)]
    z = sum((F.get("w", F.lit(i)) * value for i, value in enumerate(x)), F.lit(0.0))
    probability = F.when(F.col("w").isNotNull(), 1 / (1 + F.exp(-z))).otherwise(F.coalesce("share", F.lit(float("nan"))))
    scored = scored.select("company", "dt", "model", "label", probability.alias("prob"))
    return scored.withColumn("prediction", ((F.col("prob") > 0.5) & ~F.isnan("prob")).cast("int"))


def logistic_per_company(split: DataFrame, features: Sequence[str], label: str = "Target") -> DataFrame:
    """``logistic_scores`` for one set of features, without its name."""
    return logistic_scores(split, {"all": features}, label).drop("model")


def flat_vectors(sequences: DataFrame) -> DataFrame:
    """Adds the sequence as one vector ``features``."""
    return sequences.withColumn("features", array_to_vector(F.flatten("sequence")))


def sequence_regressor(sequences: DataFrame, max_iter: int = 20, max_depth: int = 3) -> DataFrame:
    """Predicted returns of the test sequences.

    ``sequences`` has ``is_train`` and ``is_validation``. The target is scaled to 0-1 on each
    company's training rows, boosted trees are fitted on all companies together, and stop early
    when the validation tail no longer improves.
    """
    scaled = min_max(
        flat_vectors(sequences).withColumn("y_true", F.col("target")), ["target"],
        F.col("is_train"), by=["company"], keep_bounds=True)
    model = GBTRegressor(
        featuresCol="features", labelCol="target", predictionCol="_scaled", maxIter=max_iter,
        maxDepth=max_depth, seed=42, validationIndicatorCol="is_validation",
    ).fit(scaled.where("is_train"))
    return model.transform(scaled.where("NOT is_train")).select(
        "company", "dt", "y_true", undo_min_max(F.col("_scaled"), "target").alias("y_pred"))


def sequence_classifier(sequences: DataFrame, max_iter: int = 20) -> DataFrame:
    """Probability of a rise for the test sequences of all companies, by one logistic regression."""
    vectors = flat_vectors(sequences).withColumn("label", F.col("target").cast("int"))
    model = LogisticRegression(labelCol="label", maxIter=max_iter, regParam=0.01).fit(
        vectors.where("is_train"))
    return model.transform(vectors.where("NOT is_train")).select(
        "company", "dt", "label", vector_to_array("probability")[1].alias("prob"))


def train_next_day_model(labelled: DataFrame, path: str, features: Sequence[str] = LATEST_FEATURES) -> PipelineModel:
    """Fit the next-day direction model on all companies, save it and return it."""
    rows = labelled.dropna(subset=[*features, "label"])
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        LogisticRegression(maxIter=100, regParam=0.001),
    ])
    fitted = pipeline.fit(rows)
    fitted.write().overwrite().save(path)
    return fitted


def score_latest(bars: DataFrame, path: str) -> DataFrame:
    """UP or DOWN for the newest row of each company, by a saved model; NULL where that row lacks an input."""
    model = PipelineModel.load(path)
    assembler = model.stages[0]
    assembler.setHandleInvalid("keep")
    complete = F.lit(True)
    for name in assembler.getInputCols():
        complete &= F.col(name).isNotNull() & ~F.isnan(name)
    scored = model.transform(newest_row(bars))
    trend = F.when(F.col("prediction") == 1, "UP").otherwise("DOWN")
    return scored.select("company", "dt", F.when(complete, trend).alias("trend"))
