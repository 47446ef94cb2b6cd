"""What is in a table: rows, columns, missing values, distinct keys."""

from __future__ import annotations

from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F


def profile_table(df: DataFrame, name: str, key: str | None = None, approximate: bool = False) -> DataFrame:
    """One row per column: table, rows, columns, missing values and, for ``key``, its distinct count.

    Everything comes from one aggregation. ``approximate`` avoids the extra shuffle of an exact
    distinct count.
    """
    distinct = F.lit(None).cast("long")
    if key is not None:
        distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    columns = F.array(*(
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(f"`{c}`").isNull()).alias("missing"))
        for c in df.columns))
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), distinct.alias("distinct_keys"),
                     columns.alias("columns"))
    return counted.select(
        F.lit(name).alias("table_name"), "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"), "distinct_keys",
        F.inline("columns"))


def profile_paths(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``profile_table`` of the Parquet tables at ``paths`` (by name), with a column ``error``.

    A table that cannot be opened gives one row with the reason instead of failing the others.
    """
    rows = None
    for name, path in paths.items():
        reason = None
        try:
            found = profile_table(spark.read.parquet(path), name).withColumn("error", F.lit(None).cast("string"))
        except PySparkException as error:
            reason = error.getCondition() or type(error).__name__
        except Py4JJavaError as error:
            reason = error.java_exception.getClass().getSimpleName()
        if reason:
            found = spark.range(1).select(
                F.lit(name).alias("table_name"), *(F.lit(None).cast("long").alias(c) for c in ("row_count", "column_count", "distinct_keys")),
                F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("long").alias("missing"), F.lit(reason).alias("error"))
        rows = found if rows is None else rows.unionByName(found)
    if rows is None:
        raise ValueError("no tables named")
    return rows


def distinct_keys(df: DataFrame, key: str = "company") -> DataFrame:
    """The distinct keys in order."""
    return df.select(key).distinct().orderBy(key)


def first_rows(df: DataFrame, n: int = 5, order: tuple[str, ...] = ("company", "dt")) -> DataFrame:
    """The first ``n`` rows; each task keeps only ``n`` rows for it."""
    return df.orderBy(*order).limit(n)
