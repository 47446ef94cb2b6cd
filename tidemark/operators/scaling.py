"""Scalers fitted on training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.series import with_key_facts


def _or_one(width: Column) -> Column:
    """A constant column has no width; it is shifted but not stretched."""
    return F.when(width == 0, 1.0).otherwise(width)


def min_max(df: DataFrame, columns: Sequence[str], fit_on: Column, by: Sequence[str] = (),
            order: str = "dt", keep_bounds: bool = False) -> DataFrame:
    """Scale ``columns`` so that the fitting rows span 0 to 1; a constant column becomes 0.

    Bounds are taken per ``by`` or over all rows. ``keep_bounds`` leaves ``<name>_low`` and
    ``<name>_width`` for ``undo_min_max``.
    """
    fitted = {name: F.when(fit_on, F.col(name)) for name in columns}
    if by:
        per_slice = [agg(fitted[name]).alias(f"_{name}_{tag}") for name in columns
                     for agg, tag in ((F.min, "low"), (F.max, "high"))]
        per_key = {f"_{name}_low": lambda w, n=name: F.min(f"_{n}_low").over(w) for name in columns}
        per_key |= {f"_{name}_high": lambda w, n=name: F.max(f"_{n}_high").over(w) for name in columns}
        fit = with_key_facts(df, by, order, per_slice, per_key)
    else:
        bounds = F.struct(*(agg(fitted[name]).alias(f"_{name}_{tag}") for name in columns
                            for agg, tag in ((F.min, "low"), (F.max, "high"))))
        fit = df.withColumn("_fit", df.agg(bounds).scalar()).select("*", "_fit.*").drop("_fit")
    low = {name: F.col(f"_{name}_low") for name in columns}
    width = {name: _or_one(F.col(f"_{name}_high") - low[name]) for name in columns}
    scaled = {name: (F.col(name) - low[name]) / width[name] for name in columns}
    if keep_bounds:
        scaled |= {f"{name}_low": low[name] for name in columns}
        scaled |= {f"{name}_width": width[name] for name in columns}
    helpers = [f"_{name}_{tag}" for name in columns for tag in ("low", "high")]
    return fit.withColumns(scaled).drop(*helpers)


def undo_min_max(scaled: Column, name: str) -> Column:
    """The original value, from the bounds kept by ``min_max``."""
    return scaled * F.col(f"{name}_width") + F.col(f"{name}_low")


def standard(df: DataFrame, columns: Sequence[str], fit_on: Column) -> DataFrame:
    """Subtract the mean and divide by the population standard deviation of all fitting rows."""
    stats = F.struct(*(agg(name).alias(f"{name}_{tag}") for name in columns
                       for agg, tag in ((F.avg, "mean"), (F.stddev_pop, "spread"))))
    fit = df.withColumn("_fit", df.where(fit_on).agg(stats).scalar())
    return fit.withColumns({
        name: (F.col(name) - F.col(f"_fit.{name}_mean")) / _or_one(F.col(f"_fit.{name}_spread"))
        for name in columns
    }).drop("_fit")
