"""The steps of the whole job, each from stored tables to a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.clean import clean_bars, require_unique
from tidemark.operators.news import daily_sentiment, default_lexicon, newest_articles, score_text
from tidemark.plans.features import feature_table
from tidemark.plans.staging import scratch, stored
from tidemark.sources.bars_csv import read_bars_csv
from tidemark.sources.published import publish_once
from tidemark.sources.tables import read_articles, read_optional, read_table, write_table


def ingest_bars(spark: SparkSession, csv_folder: str, prices_path: str) -> None:
    """CSV files of every layout to one Parquet table of bars; duplicate days fail.

    The parsed bars are stored once: the check and the sampling of ranges then read that table.
    """
    bars = stored(read_bars_csv(spark, csv_folder), "parsed_bars")
    write_table(require_unique(bars), prices_path, by_range=True)


def ingest_news(spark: SparkSession, json_path: str, sentiment_path: str,
                lexicon: DataFrame | None = None, max_articles: int | None = None) -> None:
    """Landed news responses to the mean headline sentiment per ticker and day.

    ``max_articles`` keeps the newest articles of each ticker only.
    """
    # Two equal articles count twice, so each row gets its own number; a task that is repeated
    # reads the same split and gives the same numbers.
    articles = read_articles(spark, json_path).withColumn("article_id", F.monotonically_increasing_id())
    if max_articles is not None:
        articles = newest_articles(articles, max_articles, company="ticker")
    scored = score_text(articles, lexicon or default_lexicon(spark),
                        keep=("article_id", "ticker", "published_at"))
    daily = daily_sentiment(scored, company="ticker").withColumnsRenamed({"company": "ticker", "dt": "date"})
    write_table(daily, sentiment_path, sort_by=("ticker", "date"), skip_empty=True)


def build_features(spark: SparkSession, prices_path: str, sentiment_path: str, output_path: str,
                   reuse: bool = False, **layout) -> None:
    """Stored bars and, where present, stored sentiment to the 60-column feature table.

    With ``reuse`` the output is a published table (see ``read_published``), and nothing is written if its
    newest version was made in the same way from the same files.
    """
    bars = clean_bars(read_table(spark, prices_path))
    table = feature_table(bars, read_optional(spark, sentiment_path), **layout)
    if reuse:
        publish_once(table, output_path, keys=("Company", "Date"))
    else:
        write_table(table, output_path, sort_by=("Company", "Date"))


def run(spark: SparkSession, csv_folder: str, json_path: str, folder: str, **layout) -> None:
    """The whole job: prices, sentiment and features under ``folder``; the scratch tables are deleted at its end."""
    with scratch(spark):
        ingest_bars(spark, csv_folder, f"{folder}/prices")
        ingest_news(spark, json_path, f"{folder}/sentiment")
        build_features(spark, f"{folder}/prices", f"{folder}/sentiment", f"{folder}/features", **layout)
