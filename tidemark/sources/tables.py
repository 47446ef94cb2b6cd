"""Parquet, CSV and JSON tables: scans, optional inputs and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.cleaning import exchange_ticker
from tidemark.operators.windows import period_start

BAR_FIELDS = ("open", "high", "low", "close", "volume")

IMPORTANCE_SCHEMA = "feature STRING, score DOUBLE, selected BOOLEAN"
ARTICLES_SCHEMA = (
    "ticker STRING, articles ARRAY<STRUCT<title: STRING, publishedAt: STRING, language: STRING>>")


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table; only the named columns are read."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table, or None when there is nothing at ``path``. Other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """The feature-importance table (feature, score, selected)."""
    return spark.read.schema(IMPORTANCE_SCHEMA).option("header", True).csv(path)


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """The company table (Symbol, Security) with tickers spelled as in the price feed."""
    raw = spark.read.schema("Symbol STRING, Security STRING").option("header", True).csv(path)
    return raw.withColumn("Symbol", exchange_ticker(F.col("Symbol")))


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A landed lexicon (word, polarity); a word may be a phrase of several."""
    return spark.read.schema("word STRING, polarity DOUBLE").option("header", True).csv(path)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Landed news responses as one row per article (ticker, published_at, title, lang).

    A response without articles gives no row; a missing title or time stays NULL.
    """
    responses = spark.read.schema(ARTICLES_SCHEMA).json(path)
    return flatten_articles(responses)


def flatten_articles(responses: DataFrame) -> DataFrame:
    """One row per article; times are UTC whatever the session's time zone is."""
    article = responses.select("ticker", F.explode("articles").alias("article"))
    # Counted from the epoch: no local time, which some hours lack and others have twice, is gone through.
    seconds = F.unix_micros(F.col("article.publishedAt").try_cast("timestamp")).cast("decimal(20,0)") / 1_000_000
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return article.select(
        "ticker",
        utc.alias("published_at"),
        F.col("article.title").alias("title"),
        F.col("article.language").alias("lang"),
    )


def history(bars: DataFrame, period: str = "1y", as_of: Column | date | None = None,
            key: str = "company", order: str = "dt") -> DataFrame:
    """OHLCV of the last ``period``. The bound is a constant, so it reaches the Parquet scan."""
    start = period_start(period, as_of)
    narrow = bars.select(key, order, *BAR_FIELDS)
    return narrow if start is None else narrow.where(F.col(order) >= start)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                sort_by: Sequence[str] = ("company", "dt"), skip_empty: bool = False,
                by_range: bool = False) -> bool:
    """Overwrite a Parquet table from the executors; rows are sorted inside each file.

    ``by_range`` gives each file its own range of ``sort_by``, so that later filters on company
    and day skip whole files; it costs a shuffle, and splits a long company over several files.
    Returns False when ``skip_empty`` found nothing to write.
    """
    if skip_empty and df.isEmpty():
        return False
    present = [name for name in (*partition_by, *sort_by) if name in df.columns]
    if by_range:
        df = df.repartitionByRange(*dict.fromkeys(present))
    ordered = df.sortWithinPartitions(*dict.fromkeys(present)) if present else df
    ordered.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return True


def write_results(df: DataFrame, path: str) -> None:
    """A small result table (one row per experiment) as one CSV file with a header."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)
