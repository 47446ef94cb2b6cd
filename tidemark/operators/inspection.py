"""What is in a large table, kept per file beside it, so that only new files are read.

Each file's rows, missing values, bounds and distinct values are summed up once. The distinct values are a
HyperLogLog sketch, and sketches of files merge into that of the table, so a table that has grown by a
file costs reading that file, and files that have gone drop out of the sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Registers of a sketch, as a power of two, and the standard error of the distinct count that follows.
SKETCH_BITS = 12
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

_FILE = ("file", "length", "modified")


def table_files(spark: SparkSession, path: str) -> DataFrame:
    """file, length, modified of every Parquet file of a table; their content is not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return listed.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))


def _kept(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.parquet(store)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def profile_files(spark: SparkSession, path: str, store: str, columns: Sequence[str] | None = None) -> DataFrame:
    """column_name, row_count, missing, low, high (as text), distinct_estimate and file_count of the table at ``path``.

    What is known of each file is kept in the table at ``store`` and used as long as the file's length and
    time of change are the same. The distinct count has a standard error of ``STANDARD_ERROR``, whatever
    the number of files. Columns of nested types have no bounds and no distinct count.
    """
    files, kept = table_files(spark, path), _kept(spark, store)
    fresh = files if kept is None else files.join(kept.select(*_FILE).distinct(), list(_FILE), "left_anti")
    new = [row["file"] for row in fresh.collect()]
    if new:
        _summary(spark, path, new, columns).join(files, "file").write.mode("append").parquet(store)
    kept = _kept(spark, store)
    if kept is None:
        raise ValueError(f"no Parquet files at {path}")
    # A file's summary may be there twice if two profiles ran at once.
    now = kept.join(files, list(_FILE), "left_semi").dropDuplicates(["file", "column_name"])
    distinct = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return now.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("missing").alias("missing"),
        F.min_by("low", "low_key").alias("low"), F.max_by("high", "high_key").alias("high"),
        distinct.alias("distinct_estimate"), F.count(F.lit(1)).alias("file_count"))


def files_to_read(spark: SparkSession, path: str, store: str) -> int:
    """How many of a table's files the next profile has to read."""
    files, kept = table_files(spark, path), _kept(spark, store)
    return files.count() if kept is None else files.join(kept.select(*_FILE).distinct(), list(_FILE), "left_anti").count()


def _summary(spark: SparkSession, path: str, files: list[str], columns: Sequence[str] | None) -> DataFrame:
    """One row per file and column."""
    rows = spark.read.option("basePath", path).parquet(*files) if not path.endswith(".parquet") else spark.read.parquet(*files)
    plain = {f.name: f.dataType.typeName() for f in rows.schema.fields if columns is None or f.name in columns}
    cells = []
    for name, kind in plain.items():
        column, nested = F.col(f"`{name}`"), kind in ("array", "map", "struct", "variant", "binary")
        text = F.lit(None).cast("string") if nested else column.cast("string")
        # Bounds of files are compared as numbers where they are numbers or times, else as text.
        key = _sort_key(column, kind)
        cells.append(F.struct(
            F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("row_count"),
            F.count_if(column.isNull()).alias("missing"), F.min(key).alias("low_key"), F.max(key).alias("high_key"),
            F.min_by(text, key).alias("low"), F.max_by(text, key).alias("high"),
            F.hll_sketch_agg(text, SKETCH_BITS).alias("sketch")))
    each = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.array(*cells).alias("cells"))
    return each.select("file", F.inline("cells"))


def _sort_key(column: Column, kind: str) -> Column:
    """struct(number, text): the order of a column's values, the same type for all columns."""
    if kind in ("array", "map", "struct", "variant", "binary"):
        number, text = F.lit(None), F.lit(None)
    elif kind in ("date", "timestamp", "timestamp_ntz"):
        number, text = F.date_format(column.cast("timestamp"), "yyyyMMddHHmmss.SSSSSS"), F.lit(None)
        number = number.cast("double")
    elif kind in ("string", "boolean"):
        number, text = F.lit(None), column.cast("string")
    else:
        number, text = column.cast("double"), F.lit(None)
    value = F.struct(number.cast("double").alias("number"), text.cast("string").alias("text"))
    return F.when(column.isNotNull(), value)
