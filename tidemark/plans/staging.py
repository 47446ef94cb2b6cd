"""Results kept between the steps of a longer job."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.session import scratch_folder


_written: dict[str, list[str]] = {}


def stored(df: DataFrame, label: str = "stage") -> DataFrame:
    """The same rows, written once to the shared scratch folder and read from there.

    For a result that several later passes need (row counts, fitted statistics, training
    iterations): they then start from a table, and a lost executor costs no recomputation of
    the steps before it.
    """
    path = scratch_folder(df.sparkSession, label)
    _written.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def clear_stored(spark: SparkSession) -> int:
    """Delete everything this application has ``stored``, and say how many tables that were.

    For the end of a job: DataFrames that read these tables can't be used any more.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        # The label's folder lies in one of its own.
        folder = jvm.org.apache.hadoop.fs.Path(path).getParent()
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is ``stored`` inside the block is deleted at its end, however it ends."""
    name = spark.sparkContext.applicationId
    before = _written.pop(name, [])
    try:
        yield
    finally:
        clear_stored(spark)
        if before:
            _written[name] = before


def fingerprint(df: DataFrame) -> str:
    """A digest of how ``df`` is computed and of the files it is computed from, with their lengths and times of change.

    Equal digests mean the same plan over the same, unchanged files. Of Python functions inside the plan
    only the name is seen, and rows that were made by the driver count as part of the plan.
    """
    spark, files = df.sparkSession, sorted(df.inputFiles())
    plan = df._jdf.queryExecution().analyzed().canonicalized().toString()
    versions = []
    if files:
        listed = spark.read.format("binaryFile").load(files).select("path", "length", F.unix_micros("modificationTime").alias("modified"))
        versions = sorted(tuple(row) for row in listed.collect())
    return hashlib.sha256(repr((plan, df.schema.json(), versions)).encode()).hexdigest()


class StageCache:
    """Results kept under one folder, found again by what they are computed from, for a time.

    A second call with an unchanged plan over unchanged files reads what the first one wrote. ``clear``
    empties the folder; entries older than ``seconds`` are made anew.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None, seconds: float = 3600.0):
        self.spark, self.seconds = spark, seconds
        self.folder = folder or scratch_folder(spark, "cache")
        self.written = 0

    def get(self, df: DataFrame, label: str = "stage") -> DataFrame:
        """The rows of ``df``, from the cache if they are there and young enough."""
        path = f"{self.folder.rstrip('/')}/{label}-{fingerprint(df)}"
        newest = max(self._entries(path), default=None, key=lambda entry: entry[0])
        if newest is None or time.time() - newest[0] > self.seconds:
            # A folder of its own for each writing; one that was not finished has no mark and is never read.
            aside = f"{path}/{uuid.uuid4().hex}"
            df.write.parquet(aside)
            self.written += 1
            newest = (time.time(), aside)
        return self.spark.read.schema(df.schema).parquet(newest[1])

    def _entries(self, path: str) -> list[tuple[float, str]]:
        """When each finished entry was written, and its folder."""
        jvm = self.spark.sparkContext._jvm
        marks = jvm.org.apache.hadoop.fs.Path(f"{path}/*/_SUCCESS")
        found = marks.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
        return [(s.getModificationTime() / 1000, s.getPath().getParent().toString()) for s in found or []]

    def clear(self) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, and unchanged otherwise.

    For short lookup tables joined to very long ones, where the plan's own size estimate would
    come too late: adaptive execution measures a side only after both have been shuffled. At
    most ``rows`` + 1 rows are counted.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked so that an equi-join shuffles both sides, unless the other one is marked for broadcast.

    For tables whose size the plan would take from files: that of packed columns is a fraction of
    what their rows take on the driver, and the estimate leaves out how many rows an explode makes of
    one, and how long lists and binaries are. A table estimated below the session's threshold is sent
    before adaptive execution has measured anything.
    """
    return df.hint("merge")
