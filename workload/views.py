"""Price bars, news and predictions derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The five companies of the bars, and the first day of the news.
COMPANIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
NEWS_START = "1995-01-01"
NEWS_DAYS = 2400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(rows: DataFrame, company: str, dt: Column, price: str, tie: str) -> DataFrame:
    return rows.groupBy(F.col(company).alias("company"), dt.alias("dt")).agg(
        F.min_by(price, tie).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, tie).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of five companies from the orders."""
    day = F.col("o_orderdate").cast("date")
    return _bars(table(spark, sf_dir, "orders"), "o_orderpriority", day, "o_totalprice", "o_orderkey")


def bars_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of five event types."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return _bars(table(spark, sf_dir, "events"), "event_type", hour, "value", "event_id")


def bars_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of five event types at the events' own times."""
    return _bars(table(spark, sf_dir, "events"), "event_type", F.col("ts").cast("timestamp_ntz"), "value", "event_id")


def bars_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of every supplier from the line items."""
    price = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("company"),
        F.col("l_shipdate").cast("date").alias("dt"),
    ).agg(F.min(price).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
          F.avg(price).alias("close"), F.sum("l_quantity").alias("volume"))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One article per document, with its whole text as the headline."""
    names = F.array(*map(F.lit, COMPANIES))
    day = F.date_add(F.lit(NEWS_START).cast("date"), ((F.col("doc_id") * 7) % NEWS_DAYS).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"),
        F.get(names, (F.col("doc_id") % len(COMPANIES)).cast("int")).alias("company"),
        day.alias("published_at"), F.col("text").alias("title"), "lang")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models' predictions per bar by fixed arithmetic, with tied probabilities."""
    base = bars(spark, sf_dir).select(
        "company", "dt", ((F.col("close") - F.col("open")) / F.col("open")).alias("y_true"),
        ((F.col("high") - F.col("close")) / F.col("high")).alias("gap"), "volume")
    model = F.explode(F.array(
        F.struct(F.lit("No Sentiment").alias("model"), F.lit(0.5).alias("slope")),
        F.struct(F.lit("Sentiment").alias("model"), F.lit(0.8).alias("slope")))).alias("m")
    modelled = base.select("*", model)
    return modelled.select(
        "company", F.col("m.model").alias("model"), "dt", "y_true",
        (F.col("y_true") * F.col("m.slope") - F.col("gap") * 0.25).alias("y_pred"),
        (F.col("y_true") > 0).cast("int").alias("label"),
        (F.floor((1 - F.col("gap") * F.col("m.slope")) * 50) / 50.0).alias("prob"))
