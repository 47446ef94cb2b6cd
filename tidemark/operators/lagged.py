"""Linear regression on sequences of past rows, without building the sequences.

The inputs of a model on ``lookback`` rows of some features are lagged copies of a few columns. Their
normal equations need sums of products of any two lags, but the sum for lags (a + 1, b + 1) is that for
(a, b) with one product added and one taken away at the ends of the training range. So one sum per
difference of lags, and the rows at both ends, give all of them: numbers that add up over chunks of a
series, whose count does not grow with its length. Sets of features are parts of the same equations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.operators.splits import TRAIN_SHARE
from tidemark.plans.sequences import Chunk, map_sequences

PENALTY = 1.0


def _train_count(total: int, lookback: int, share: float) -> int:
    return max(0, int(np.floor((total - lookback) * share)))


def _slots(lookback: int, width: int) -> dict[str, tuple[int, ...]]:
    """The shapes of the numbers that a chunk contributes."""
    return {"pairs": (lookback, width, width), "goal": (lookback, width), "sums": (width,), "counts": (2,),
            "head": (lookback - 1, width), "tail": (lookback - 1, width)}


def _moments(chunk: Chunk, lookback: int, share: float) -> np.ndarray:
    """What one chunk adds to its series' numbers."""
    x, width = chunk.matrix, chunk.matrix.shape[1]
    count = _train_count(chunk.total, lookback, share)
    start = chunk.first - lookback
    found = {name: np.zeros(shape) for name, shape in _slots(lookback, width).items()}
    # Rows of the chunk that training sequences lead to.
    low, high = lookback, min(len(x), lookback + count - start)
    if high > low:
        newest, y = x[low - 1:high - 1], chunk.y[:high - low]
        for d in range(lookback):
            found["pairs"][d] = x[low - 1 - d:high - 1 - d].T @ newest
            found["goal"][d] = x[low - 1 - d:high - 1 - d].T @ y
        found["sums"], found["counts"] = newest.sum(axis=0), np.array([high - low, y.sum()])
    own = x[chunk.row["halo"]:]
    places = start + chunk.row["halo"] + np.arange(len(own))
    for name, edge in (("head", 0), ("tail", count)):
        inside = (places >= edge) & (places < edge + lookback - 1)
        found[name][places[inside] - edge] = own[inside]
    return np.concatenate([part.ravel() for part in found.values()])


def lag_moments(store: DataFrame, features: Sequence[str], target: str, lookback: int, share: float, keys: Sequence[str], order: str) -> DataFrame:
    """keys, moments ARRAY<DOUBLE>: per series the numbers that its normal equations need.

    A chunk gives one array, and arrays are summed by place, combined before the shuffle.
    """
    schema = T.StructType([*store.select(*keys).schema.fields, T.StructField("moments", T.ArrayType(T.DoubleType()))])

    def reader(chunk: Chunk):
        named = [pa.array([chunk.row[name]], chunk.kinds[name]) for name in keys]
        yield pa.RecordBatch.from_arrays([*named, pa.array([_moments(chunk, lookback, share)], pa.list_(pa.float64()))], schema.names)

    each = map_sequences(store, reader, schema, features, target, lookback, order, keys)
    each = each.select(*keys, F.posexplode("moments").alias("place", "value"))
    summed = each.groupBy(*keys, "place").agg(F.sum("value").alias("value"))
    ordered = F.sort_array(F.collect_list(F.struct("place", "value")))
    return summed.groupBy(*keys).agg(ordered.alias("found")).select(*keys, F.col("found.value").alias("moments"))


def _equations(moments: np.ndarray, lookback: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, int]:
    """Products of all inputs (lag by lag from the newest, feature by feature), products with the goal, sums, sum of the goal, count."""
    parts, at = {}, 0
    for name, shape in _slots(lookback, width).items():
        size = int(np.prod(shape))
        parts[name], at = moments[at:at + size].reshape(shape), at + size
    pairs, head, tail = parts["pairs"], parts["head"], parts["tail"]
    whole, sums = np.empty((lookback, width, lookback, width)), np.empty((lookback, width))
    for d in range(lookback):
        block = pairs[d].copy()
        for b in range(lookback - d):
            a = b + d
            whole[a, :, b, :], whole[b, :, a, :] = block, block.T
            if a < lookback - 1:
                # Both lags one further back: the training range moves by a row.
                older = lookback - 2
                block += np.outer(head[older - a], head[older - b]) - np.outer(tail[older - a], tail[older - b])
    sums[0] = parts["sums"]
    for a in range(lookback - 1):
        sums[a + 1] = sums[a] + head[lookback - 2 - a] - tail[lookback - 2 - a]
    size = lookback * width
    return whole.reshape(size, size), parts["goal"].reshape(size), sums.reshape(size), float(parts["counts"][1]), int(parts["counts"][0])


def lagged_ridge(store: DataFrame, sets: Mapping[str, Sequence[str]], target: str = "Future_Return", lookback: int = 60,
                 share: float = TRAIN_SHARE, penalty: float = PENALTY, keys: str | Sequence[str] = "company", order: str = "dt") -> DataFrame:
    """keys, model, intercept, weights: per series and feature set the minimum of squared error + penalty * |w|^2 over
    the first ``share`` of its sequences; the intercept is not penalised.

    ``weights`` go from the newest step to the oldest, feature by feature. All sets are fitted from one
    pass over the store. A series without a training sequence is left out.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    features = list(dict.fromkeys(f for chosen in sets.values() for f in chosen))
    moments = lag_moments(store, features, target, lookback, share, names, order)
    chosen = {name: [features.index(f) for f in fs] for name, fs in sets.items()}
    width = len(features)

    def solved(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                products, goal, sums, total, count = _equations(np.array(row["moments"]), lookback, width)
                if not count:
                    continue
                for model, at in chosen.items():
                    picked = (np.arange(lookback)[:, None] * width + np.array(at)[None, :]).ravel()
                    mean = sums[picked] / count
                    matrix = products[np.ix_(picked, picked)] - count * np.outer(mean, mean)
                    weights = np.linalg.solve(matrix + penalty * np.eye(len(picked)), goal[picked] - mean * total)
                    out.append({**{name: row[name] for name in names}, "model": model,
                                "intercept": float(total / count - mean @ weights), "weights": weights})
            if out:
                kinds = [*(batch.schema.field(name) for name in names), pa.field("model", pa.string()),
                         pa.field("intercept", pa.float64()), pa.field("weights", pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))

    schema = T.StructType([*store.select(*names).schema.fields, T.StructField("model", T.StringType()),
                           T.StructField("intercept", T.DoubleType()), T.StructField("weights", T.ArrayType(T.DoubleType()))])
    return moments.mapInArrow(solved, schema)


def predicted(store: DataFrame, models: DataFrame, sets: Mapping[str, Sequence[str]], target: str = "Future_Return", lookback: int = 60,
              share: float = TRAIN_SHARE, keys: str | Sequence[str] = "company", order: str = "dt", train: bool = False) -> DataFrame:
    """keys, order, model, y_true, y_pred of the sequences behind the first ``share``, or with ``train`` of those."""
    names = [keys] if isinstance(keys, str) else list(keys)
    features = list(dict.fromkeys(f for chosen in sets.values() for f in chosen))
    per_series = models.groupBy(*names).agg(F.collect_list(F.struct("model", "intercept", "weights")).alias("models"))
    schema = T.StructType([*store.select(*names, F.get(order, F.lit(0)).alias(order)).schema.fields, T.StructField("model", T.StringType()),
                           T.StructField("y_true", T.DoubleType()), T.StructField("y_pred", T.DoubleType())])

    def reader(chunk: Chunk):
        border = lookback + _train_count(chunk.total, lookback, share)
        chosen = (chunk.places < border) == train
        if not chosen.any():
            return
        n, times = int(chosen.sum()), chunk.times.filter(pa.array(chosen))
        for model in sorted(chunk.row["models"], key=lambda m: m["model"]):
            at = [features.index(f) for f in sets[model["model"]]]
            weights = np.array(model["weights"]).reshape(lookback, len(at))[::-1]
            guess = np.full(n, model["intercept"])
            for step in range(lookback):
                guess += chunk.x[chosen, step][:, at] @ weights[step]
            columns = [pa.array([chunk.row[name]] * n, chunk.kinds[name]) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, times, pa.array([model["model"]] * n), pa.array(chunk.y[chosen]), pa.array(guess)], schema.names)

    return map_sequences(store.join(per_series, names), reader, schema, features, target, lookback, order, [*names, "models"])
