"""One query per operator. Values are rounded so that two engines agree on them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import (
    clean, display, inspection, labels, lagged, metrics, models, news, profile, reshape, scaling, sentiment, splits,
    technical, walks, wide, windows,
)
from tidemark.operators.indicator import Indicator, apply_indicators
from tidemark.plans import experiments, sequences as sequence_plans
from tidemark.plans.features import feature_table, merge_prices_and_sentiment
from tidemark.plans.staging import StageCache, stored
from tidemark.session import scratch_folder
from tidemark.sources import bars_csv, published, tables
from workload import views

Query = Callable[[SparkSession, str], DataFrame]

# Digits that separate results from noise: averages of prices, other price-sized values, ratios.
MEANS, PRICES, RATIOS = 4, 2, 6

_registry: dict[str, Query] = {}


def query(build: Query) -> Query:
    _registry[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_registry)


def rounded(df: DataFrame, digits: dict[str, int], *plain: str) -> DataFrame:
    """The plain columns as they are and the others rounded."""
    return df.select(*plain, *(F.round(name, n).alias(name) for name, n in digits.items()))


def _series(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return rounded(df, digits, "company", "dt")


# Digits per indicator output.
DIGITS = {
    "MA_10": MEANS, "MA_20": MEANS, "MA_50": MEANS, "EMA_12": PRICES, "EMA_26": PRICES,
    "MACD": PRICES, "MACD_Signal": PRICES, "MACD_Hist": PRICES, "RSI": RATIOS,
    "BB_Mid": MEANS, "BB_Std": PRICES, "BB_Upper": PRICES, "BB_Lower": PRICES,
    "BB_Width": RATIOS, "BB_Pos": RATIOS,
    "Return_1": RATIOS, "Return_3": RATIOS, "Return_5": RATIOS, "Return_10": RATIOS,
    "Momentum_1": PRICES, "Momentum_3": PRICES, "Momentum_5": PRICES, "Momentum_10": PRICES,
    "Vol_10": RATIOS, "Vol_20": RATIOS, "ATR_14": MEANS,
    "Price_vs_MA20": RATIOS, "Price_vs_MA50": RATIOS, "MA_spread": RATIOS,
    "Volume_MA10": RATIOS, "Volume_Ratio": RATIOS, "Volume_Change": RATIOS,
    "Stoch_K": RATIOS, "Stoch_D": RATIOS,
    "Candle_Body": PRICES, "Candle_Range": PRICES, "Candle_Dir": 0,
    "Sentiment_Lag1": RATIOS, "Sentiment_Lag2": RATIOS, "Sentiment_Lag3": RATIOS,
    "Sentiment_MA3": RATIOS, "Sentiment_MA7": RATIOS, "Sentiment_Std5": RATIOS,
    "Sentiment_Change": RATIOS, "Sentiment_Accel": RATIOS, "Sentiment_Cum5": RATIOS,
    "Sent_x_Return1": RATIOS, "Sent_x_Momentum": RATIOS, "Sentiment_Weighted": RATIOS,
    "Sentiment_Weighted_MA": RATIOS,
}


def _indicator(indicator: Indicator) -> Query:
    digits = {name: DIGITS[name] for name in indicator.outputs}
    return lambda spark, sf_dir: _series(indicator(views.bars(spark, sf_dir)), digits)


# --- Technical indicators -----------------------------------------------------------------

_registry.update({
    "moving_averages": _indicator(technical.moving_averages),
    "ema": _indicator(technical.exponential_averages),
    "macd": _indicator(technical.macd),
    "rsi_simple": _indicator(technical.rsi),
    "bollinger": _indicator(technical.bollinger),
    "returns_momentum": _indicator(technical.returns_and_momentum),
    "volatility": _indicator(technical.volatility),
    "atr": _indicator(technical.average_true_range),
    "price_ratios": _indicator(technical.price_ratios),
    "volume_features": _indicator(technical.volume_features),
    "stochastic": _indicator(technical.stochastic),
    "candles": _indicator(technical.candles),
    "rsi_wilder": _indicator(display.rsi_wilder),
    "macd_display": _indicator(display.macd_display),
})


@query
def moving_averages_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving averages with every company cut into several segments."""
    df = technical.moving_averages(views.bars(spark, sf_dir), segment_rows=400)
    return _series(df, {name: DIGITS[name] for name in technical.moving_averages.outputs})


@query
def macd_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive averages across segment borders."""
    df = technical.macd(views.bars(spark, sf_dir), segment_rows=800)
    return _series(df, {name: DIGITS[name] for name in technical.macd.outputs})


@query
def ema_long_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive averages with spans far above a segment's rows."""
    df = technical.exponential_average(views.bars(spark, sf_dir), 10_000, segment_rows=250)
    return _series(technical.exponential_average(df, 500, segment_rows=250), {"EMA_10000": MEANS, "EMA_500": MEANS})


@query
def macd_long_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slow MACD whose states are handed on from segment to segment."""
    df = technical.long_macd(views.bars(spark, sf_dir), 120, 260, 90, segment_rows=300)
    return _series(df, {name: MEANS for name in ("MACD", "MACD_Signal", "MACD_Hist")})


@query
def drawdown_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicators with a state of their own, carried over segment borders."""
    df = walks.drawdown(views.bars(spark, sf_dir), segment_rows=300)
    df = walks.rising_rows(df, segment_rows=300)
    return rounded(df, {"Drawdown": RATIOS}, "company", "dt", "Rows_Since_Peak", "Rising_Rows")


@query
def ticks_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moving averages at the events' own times, with days too dense for a segment."""
    return _series(technical.moving_averages(views.bars_tick(spark, sf_dir), segment_rows=100), {n: DIGITS[n] for n in ("MA_10", "MA_20", "MA_50")})


@query
def hourly_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several indicators of hourly bars in one pass, cut into segments."""
    chosen = [technical.moving_averages, technical.rsi, technical.stochastic, technical.candles]
    df = apply_indicators(views.bars_hour(spark, sf_dir), chosen, segment_rows=150)
    digits = {name: DIGITS[name] for i in chosen for name in i.outputs}
    return _series(df, digits)


# --- News and sentiment -------------------------------------------------------------------

def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.score_text(views.news(spark, sf_dir), news.default_lexicon(spark))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news.daily_sentiment(_scored(spark, sf_dir))


def _bars_with_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.join_sentiment(views.bars(spark, sf_dir), _daily(spark, sf_dir))


@query
def lexicon_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scored(spark, sf_dir), {"sentiment": RATIOS}, "article_id", "company", "published_at")


@query
def daily_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(_daily(spark, sf_dir), {"sentiment": RATIOS})


# Phrases of the test documents' own words, some of them parts of others.
PHRASES = {
    "the": 0.1, "the and": -0.4, "the and attion to": 0.9, "of the": 0.5, "of the of": -0.6, "to the": 0.3, "is the": -0.2,
    "rest": 0.1, "heed": 0.2, "for the": 0.4, "a": -0.1, "in the a": -0.7,
}


@query
def phrase_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polarity by the longest phrases of a landed lexicon, negated within a clause.

    The documents know no negations, so two of their words are taken for one and for an intensifier.
    """
    path = scratch_folder(spark, "lexicon")
    rows = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{phrase}', {value}D)" for phrase, value in PHRASES.items()) + " AS l(word, polarity)")
    rows.write.option("header", True).csv(path)
    text = F.replace(F.replace("title", F.lit(" that "), F.lit(" not ")), F.lit(" with "), F.lit(" very "))
    scored = news.score_text(views.news(spark, sf_dir).withColumn("title", text), tables.read_lexicon(spark, path), clauses=True)
    return rounded(scored, {"sentiment": RATIOS}, "article_id", "company", "published_at")


@query
def news_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = views.news(spark, sf_dir).where(F.col("lang") == "en")
    return news.newest_articles(articles, 10).select(
        "company", "article_id", "published_at", F.length("title").cast("long").alias("title_length"))


@query
def news_phrase_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English articles that hold a passage of the benchmark, taken as a long company name."""
    names = views.table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("ITEM."), F.col("item_id")).alias("Symbol"), F.col("text").alias("Security"))
    return news.match_names(views.news(spark, sf_dir), names, text="title").select(
        F.col("Symbol").alias("ticker"), "article_id")


@query
def news_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses landed as JSON files, one per company, back to one row per article."""
    articles = views.news(spark, sf_dir)
    time = F.concat(F.col("published_at").cast("string"), F.lit("T09:30:00Z"))
    item = F.struct(F.col("title"), time.alias("publishedAt"), F.col("lang").alias("language"))
    # Article numbers are unique, so a response holds at most 50 articles.
    block = F.floor(F.col("article_id") / 50).alias("block")
    responses = articles.groupBy(F.col("company").alias("ticker"), block).agg(
        F.collect_list(item).alias("articles")).drop("block")
    path = scratch_folder(spark, "responses")
    responses.write.json(path)
    return tables.read_articles(spark, path).select(
        "ticker", F.date_format("published_at", "yyyy-MM-dd HH:mm").alias("published_at"), "lang",
        F.length("title").cast("long").alias("title_length"), F.md5("title").alias("title_md5"))


@query
def ticker_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company names with a dot in the symbol, written and read back as the company table."""
    raw = views.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S."), F.col("s_suppkey")).alias("Symbol"), F.col("s_name").alias("Security"))
    path = scratch_folder(spark, "companies")
    raw.write.option("header", True).csv(path)
    return tables.read_companies(spark, path)


@query
def sentiment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_prices_and_sentiment(views.bars(spark, sf_dir), _daily(spark, sf_dir))
    return rounded(merged, {"close": PRICES, "volume": 0, "daily_sentiment": RATIOS}, "ticker", "date")


@query
def optional_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = tables.read_optional(spark, f"{sf_dir}/news_sentiment.parquet")
    return _series(sentiment.join_sentiment(views.bars(spark, sf_dir), daily),
                   {"close": PRICES, "sentiment": RATIOS})


@query
def sentiment_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join with a sentiment table that is there: written, found and read under its stored names."""
    path = scratch_folder(spark, "news_sentiment")
    named = _daily(spark, sf_dir).withColumnsRenamed({"company": "ticker", "dt": "date"})
    tables.write_table(named, path, sort_by=("ticker", "date"))
    return _series(sentiment.join_sentiment(views.bars(spark, sf_dir), tables.read_optional(spark, path)),
                   {"close": PRICES, "sentiment": RATIOS})


@query
def sentiment_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sentiment.sentiment_windows(_bars_with_sentiment(spark, sf_dir))
    return _series(df, {name: DIGITS[name] for name in sentiment.sentiment_windows.outputs})


@query
def sentiment_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = sentiment.sentiment_interactions(_bars_with_sentiment(spark, sf_dir))
    numbers = {n: DIGITS[n] for n in sentiment.sentiment_interactions.outputs if n in DIGITS}
    return rounded(df, numbers, "company", "dt", "Sentiment_Pos", "Sentiment_Neg")


def _rounded_table(df: DataFrame) -> DataFrame:
    digits = {"Open": PRICES, "High": PRICES, "Low": PRICES, "Close": PRICES, "Volume": PRICES,
              "Sentiment": RATIOS, **DIGITS}
    return rounded(df, digits, "Company", "Date", "Sentiment_Pos", "Sentiment_Neg")


@query
def feature_table_60(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 60 columns."""
    return _rounded_table(feature_table(stored(views.bars(spark, sf_dir)), _daily(spark, sf_dir)))


@query
def feature_table_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 60 columns, every company cut into several segments."""
    return _rounded_table(feature_table(
        stored(views.bars(spark, sf_dir)), _daily(spark, sf_dir), segment_rows=800))


@query
def feature_table_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of every supplier's bars, without news."""
    table = feature_table(stored(views.bars_supplier(spark, sf_dir)), None)
    numbers = {n: DIGITS[n] for n in ("EMA_26", "RSI", "BB_Std", "Vol_20", "Price_vs_MA50", "Stoch_D")}
    return rounded(table, {"Close": MEANS, **numbers}, "Company", "Date")


# --- Sources, cleaning, reshaping ---------------------------------------------------------

@query
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns and a date range; both reach the scan."""
    orders = tables.read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderdate", "o_totalprice"])
    recent = orders.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    return recent.select(F.col("o_orderkey").alias("order_id"),
                         F.col("o_orderdate").cast("date").alias("dt"), F.col("o_totalprice").alias("price"))


@query
def scan_csv_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars written as CSV per ticker in two column orders, read back from one folder."""
    folder = scratch_folder(spark, "bars_csv")
    bars = views.bars(spark, sf_dir)
    other = F.col("company").isin("2-HIGH", "4-NOT SPECIFIED")
    bars_csv.write_bars_csv(bars.where(other), folder)
    bars_csv.write_bars_csv(bars.where(~other), folder, "Price", ("close", "high", "low", "open", "volume"), "append")
    return bars_csv.read_bars_csv(spark, folder)


@query
def clean_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as text with currency signs and separators, unreadable values and bad dates."""
    bars = views.bars(spark, sf_dir)
    text = F.format_number("close", 2)
    raw = bars.select(
        F.col("company").alias(" Company "),
        F.when(F.dayofmonth("dt") == 31, "31st").otherwise(F.col("dt").cast("string")).alias("Price"),
        F.when(F.col("open") > F.col("close"), "n/a").otherwise(
            F.concat(F.lit("$"), F.format_number("open", 2))).alias("Open"),
        F.concat(F.lit(" ₹"), text, F.lit(" ")).alias("Close "),
        F.col("volume").cast("string").alias("Volume"))
    return _series(clean.clean_bars(raw), {"open": PRICES, "close": PRICES, "volume": 0})


@query
def unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars that passed the uniqueness check."""
    checked = clean.require_unique(views.bars(spark, sf_dir))
    return checked.groupBy("company").agg(F.count(F.lit(1)).alias("days"))


@query
def pivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = reshape.to_wide(views.bars(spark, sf_dir), views.COMPANIES, ["close", "volume"])
    return wide.toDF(*(name.replace("|", "_").replace("-", "_").replace(" ", "_") for name in wide.columns))


@query
def wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide and back. One ticker without volume is skipped as incomplete."""
    wide = reshape.to_wide(views.bars(spark, sf_dir), views.COMPANIES)
    return reshape.to_long(wide.drop("5-LOW|Volume"))


@query
def wide_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's bars as a wide table in blocks of columns, and back."""
    bars = views.bars_supplier(spark, sf_dir)
    names = wide.dictionary(bars, block=16)
    table = stored(wide.to_blocks(bars, names))
    return rounded(wide.from_blocks(table, names), {"open": PRICES, "high": PRICES, "low": PRICES, "close": MEANS, "volume": PRICES}, "company", "dt")


@query
def wide_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tickers' columns out of the blocks, and on how many tickers' bars each day rests."""
    bars = views.bars_supplier(spark, sf_dir)
    names = wide.dictionary(bars, block=16)
    table = stored(wide.to_blocks(bars, names))
    few = wide.columns_of(table, names, ["1", "3", "7"], ["high"])
    present = table.groupBy("dt").agg(F.sum(F.aggregate("high", F.lit(0), lambda n, x: n + F.when(x.isNotNull(), 1).otherwise(0))).alias("tickers"))
    return few.join(present, "dt").select("dt", *(F.round(f"`{t}|High`", PRICES).alias(f"high_{t}") for t in ("1", "3", "7")), "tickers")


@query
def drop_empty_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listed ticker without any bar leaves no columns."""
    wide = reshape.to_wide(views.bars(spark, sf_dir), ["1-URGENT", "6-UNKNOWN"], ["close"])
    kept = clean.drop_empty_columns(wide)
    return kept.select("dt", *(F.col(f"`{c}`").alias("close_" + c[0]) for c in kept.columns if c != "dt"))


@query
def period_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year of OHLCV up to a given day."""
    return tables.history(views.bars(spark, sf_dir), "1y", date(2000, 6, 30))


@query
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars through the Parquet sink, their yearly summary through the CSV sink."""
    bars_path, result_path = scratch_folder(spark, "bars"), scratch_folder(spark, "summary")
    tables.write_table(views.bars(spark, sf_dir).withColumn("year", F.year("dt")), bars_path, ["year"])
    stored = tables.read_table(spark, bars_path)
    summary = stored.groupBy("company", "year").agg(
        F.count(F.lit(1)).alias("days"), F.max("high").alias("top"))
    tables.write_results(summary, result_path)
    return spark.read.schema("company STRING, year INT, days BIGINT, top DOUBLE") \
        .option("header", True).csv(result_path)


@query
def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that an empty result must not replace: the older rows, and whether anything was written."""
    path = scratch_folder(spark, "guarded")
    bars = views.bars(spark, sf_dir)
    first = tables.write_table(bars, path, skip_empty=True)
    second = tables.write_table(bars.where("volume < 0"), path, skip_empty=True)
    return tables.read_table(spark, path).groupBy("company").agg(F.count(F.lit(1)).alias("days")).withColumns(
        {"first": F.lit(int(first)), "second": F.lit(int(second))})


@query
def importance_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small table of feature scores through its CSV file."""
    path = scratch_folder(spark, "importance")
    scored = feature_importance(spark, sf_dir).withColumn("selected", F.col("selected") == 1)
    tables.write_results(scored, path)
    return tables.read_importance(spark, path).withColumn("selected", F.col("selected").cast("int"))


@query
def publish_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published table replaced by rows read from itself, then one company of it by others."""
    path = scratch_folder(spark, "published")
    published.publish(views.bars(spark, sf_dir), path, partition_by="company")
    kept = published.read_published(spark, path).where(F.col("dt") >= F.lit("1998-01-01").cast("date"))
    published.publish(kept, path, partition_by="company")
    doubled = published.read_published(spark, path).where(F.col("company") == "5-LOW").withColumn("volume", F.col("volume") * 2)
    published.publish(doubled, path, partition_by="company", replace=False)
    published.clear_old(spark, path)
    return published.read_published(spark, path)


@query
def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = profile.profile_table(views.bars(spark, sf_dir), "bars", "company")
    daily = profile.profile_table(_daily(spark, sf_dir), "daily_sentiment", "company")
    return bars.unionByName(daily)


@query
def profile_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a table that has grown by a file: how many files it read for that, exact counts and bounds, and
    whether the estimate of distinct values lies within three standard errors."""
    path, kept = scratch_folder(spark, "grown"), scratch_folder(spark, "profile")
    bars = views.bars(spark, sf_dir).select("company", "dt", F.col("volume").cast("long").alias("orders"),
                                            F.when(F.dayofmonth("dt") > 15, F.month("dt")).alias("late"))
    bars.where("dt < DATE'1997-01-01'").repartition(3).write.parquet(path)
    inspection.profile_files(spark, path, kept)
    bars.where("dt >= DATE'1997-01-01'").coalesce(1).write.mode("append").parquet(path)
    read = inspection.files_to_read(spark, path, kept)
    found = inspection.profile_files(spark, path, kept)
    exact = F.array(*(F.struct(F.lit(c).alias("column_name"), F.count_distinct(c).alias("exact")) for c in bars.columns))
    joined = found.join(spark.read.parquet(path).agg(exact.alias("e")).select(F.inline("e")), "column_name")
    close = F.abs(F.col("distinct_estimate") - F.col("exact")) <= 3 * inspection.STANDARD_ERROR * F.col("exact") + 0.5
    return joined.select("column_name", "row_count", "missing", "low", "high", close.cast("int").alias("distinct_close"),
                         "exact", F.lit(read).cast("long").alias("files_read"))


@query
def cached_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars from a cache: made once, found again, made anew when a file is added to what they come from."""
    cache, path = StageCache(spark), scratch_folder(spark, "source")
    views.table(spark, sf_dir, "orders").where("o_orderdate < TIMESTAMP'1997-01-01'").write.parquet(path)

    def days() -> DataFrame:
        found = spark.read.parquet(path).groupBy(F.col("o_orderpriority").alias("company")).agg(F.count(F.lit(1)).alias("orders"))
        return cache.get(found, "days")

    early, written = [days() for _ in range(2)][1], [cache.written]
    early = stored(early)
    views.table(spark, sf_dir, "orders").where("o_orderdate >= TIMESTAMP'1997-01-01'").write.mode("append").parquet(path)
    late = days()
    written.append(cache.written)
    return late.join(early.withColumnRenamed("orders", "early_orders"), "company").withColumns(
        {"written_first": F.lit(written[0]), "written": F.lit(written[1])})


@query
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.first_rows(views.bars(spark, sf_dir))


@query
def distinct_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_keys(views.bars_supplier(spark, sf_dir))


# --- Time filters, labels, splits, scalers ------------------------------------------------

@query
def trailing_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.recent_years(views.bars(spark, sf_dir), 3)


@query
def trailing_years_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.recent_days_overall(views.bars(spark, sf_dir), 365 * 3)


@query
def timeframe_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every preset frame of two companies, one below the other."""
    shown = display.time_frames(views.bars(spark, sf_dir), companies=["2-HIGH", "5-LOW"])
    return shown.select("frame", "company", "dt", "close")


@query
def timeframe_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One preset frame of all companies."""
    return display.time_frame(views.bars(spark, sf_dir), "3M").select("company", "dt", "close")


@query
def dashboard_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart lines of the last year, oldest first."""
    chart = display.chart_series(views.bars(spark, sf_dir), "1Y").orderBy("company", "dt")
    lines = {"SMA_20": MEANS, "RSI": RATIOS, "MACD": PRICES, "MACD_Signal": PRICES}
    return rounded(chart, lines, "company", "dt", "open", "high", "low", "close")


@query
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.newest_row(views.bars(spark, sf_dir))


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return technical.returns_and_momentum(views.bars(spark, sf_dir)).select(
        "company", "dt", "close", "Return_1")


def _label_columns(df: DataFrame) -> DataFrame:
    return rounded(df, {"Return_1": RATIOS, "Future_Return": RATIOS}, "company", "dt", "Target")


@query
def direction_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = windows.recent_years(_returns(spark, sf_dir), 7)
    return _label_columns(labels.direction_label(recent))


@query
def direction_label_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that look ahead across segment borders."""
    recent = windows.recent_years(_returns(spark, sf_dir), 7)
    return _label_columns(labels.direction_label(recent, segment_rows=300))


@query
def return_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns recomputed on the trailing window, so its first row has none."""
    recent = windows.recent_years(views.bars(spark, sf_dir), 3)
    return _series(labels.return_targets(recent), {"Return": RATIOS, "Future_Return": RATIOS})


@query
def dormant_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labels.log_return_features(views.bars(spark, sf_dir))
    numbers = {n: RATIOS for n in ("log_return", "Volatility_5", "Momentum_3", "Volume_Change")}
    return rounded(df, numbers, "company", "dt", "Direction")


@query
def chrono_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.by_position(views.bars(spark, sf_dir)).select(
        "company", "dt", "position", F.col("train_rows").cast("long").alias("train_rows"),
        F.col("is_train").cast("int").alias("is_train"),
        F.col("is_validation").cast("int").alias("is_validation"))


@query
def chrono_split_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions and sizes of whole series whose rows lie in several segments."""
    return splits.by_position(views.bars(spark, sf_dir), segment_rows=250).select(
        "company", "dt", "position", F.col("is_train").cast("int").alias("is_train"))


@query
def quantile_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = splits.by_date_quantile(views.bars(spark, sf_dir))
    return split.select("company", "dt", F.col("is_train").cast("int").alias("is_train"))


@query
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled to 0-1 on the rows that training sequences of 60 see."""
    seen = splits.seen_by_sequences(views.bars(spark, sf_dir), 60)
    scaled = scaling.min_max(seen, ["close", "volume"], F.col("is_seen"), ["company"])
    return _series(scaled, {"close": RATIOS, "volume": RATIOS})


@query
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All companies together, fitted on the earlier days."""
    split = splits.by_date_quantile(views.bars(spark, sf_dir))
    return _series(scaling.standard(split, ["close", "volume"], F.col("is_train")),
                   {"close": RATIOS, "volume": RATIOS})


def _flat_sequences(df: DataFrame, *keys: str) -> DataFrame:
    """Checkable numbers of each sequence: length, oldest and newest step, sum over all steps."""
    def total(i: int) -> Column:
        return F.aggregate("sequence", F.lit(0.0), lambda acc, step: acc + step[i])

    steps = F.size("sequence").cast("long").alias("steps")
    oldest, newest = F.element_at("sequence", 1), F.element_at("sequence", -1)
    return df.select(
        *keys, "dt", steps, F.round(oldest[0], PRICES).alias("oldest_close"),
        F.round(newest[0], PRICES).alias("newest_close"), F.round(total(0), PRICES).alias("sum_close"),
        F.round(total(1), PRICES).alias("sum_volume"), F.round(F.col("target").cast("double"), RATIOS).alias("target"))


def _sequence_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.return_targets(windows.recent_years(views.bars(spark, sf_dir), 3))


@query
def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = labels.sequences(_sequence_input(spark, sf_dir), ["close", "volume"])
    return _flat_sequences(built, "company")


@query
def sequences_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences that reach over segment borders."""
    built = labels.sequences(_sequence_input(spark, sf_dir), ["close", "volume"], segment_rows=200)
    return _flat_sequences(built, "company")


@query
def sequences_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten steps per company, separately in the earlier and the later days."""
    split = splits.by_date_quantile(labels.log_return_features(views.bars(spark, sf_dir)))
    tagged = split.withColumn("part", F.when(F.col("is_train"), "train").otherwise("test"))
    built = labels.sequences(tagged, ["close", "volume"], "Direction", labels.POOLED_LOOKBACK,
                             keys=["part", "company"])
    return _flat_sequences(built, "part", "company")


@query
def sequence_store_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences read as views of chunks with a halo; each step counts with its place, so their order shows."""
    store = stored(sequence_plans.sequence_store(_sequence_input(spark, sf_dir), ["close", "volume"], chunk_rows=200))
    return _digests(store, ["company"], "Future_Return", labels.LOOKBACK)


@query
def sequences_pooled_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the ten steps of the pooled classifier, separately in the earlier and the later days."""
    split = splits.by_date_quantile(labels.log_return_features(views.bars(spark, sf_dir)))
    tagged = split.withColumn("part", F.when(F.col("is_train"), "train").otherwise("test"))
    by = ["part", "company"]
    store = stored(sequence_plans.sequence_store(tagged, ["close", "volume"], "Direction", labels.POOLED_LOOKBACK, by, chunk_rows=150))
    return _digests(store, by, "Direction", labels.POOLED_LOOKBACK)


def _digests(store: DataFrame, keys: list[str], target: str, lookback: int) -> DataFrame:
    """Sums of a sequence's closes and volumes, each times its place from 1."""
    steps = np.arange(1.0, lookback + 1)
    names = [*keys, "dt", "close_digest", "volume_digest", "target"]

    def digest(chunk: sequence_plans.Chunk):
        numbers = np.einsum("nsf,s->nf", chunk.x, steps)
        named = [pa.array([chunk.row[key]] * len(chunk.y), pa.string()) for key in keys]
        yield pa.RecordBatch.from_arrays([*named, chunk.times, pa.array(numbers[:, 0]), pa.array(numbers[:, 1]), pa.array(chunk.y)], names)

    schema = ", ".join([*(f"{key} string" for key in keys), "dt date, close_digest double, volume_digest double, target double"])
    read = sequence_plans.map_sequences(store, digest, schema, ["close", "volume"], target, lookback, carried=keys)
    return rounded(read, {"close_digest": PRICES, "volume_digest": PRICES, "target": RATIOS}, *keys, "dt")


# --- Models and measures ------------------------------------------------------------------

@query
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = metrics.regression_metrics(views.predictions(spark, sf_dir), ["company", "model"])
    return rounded(measured, {"directional_accuracy": RATIOS, "mae": RATIOS, "rmse": RATIOS, "mape": 4},
                   "company", "model")


@query
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = metrics.classification_metrics(views.predictions(spark, sf_dir), ["company", "model"])
    return rounded(measured, {"accuracy": RATIOS, "roc_auc": RATIOS, "f1": RATIOS, "mcc": RATIOS},
                   "company", "model")


@query
def classification_metrics_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for all companies, as the pooled classifier is judged."""
    pooled = views.predictions(spark, sf_dir).where(F.col("model") == "Sentiment")
    return rounded(metrics.classification_metrics(pooled),
                   {"accuracy": RATIOS, "roc_auc": RATIOS, "f1": RATIOS, "mcc": RATIOS})


@query
def experiment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows of both models, appended one below the other."""
    predicted = views.predictions(spark, sf_dir)
    tables_per_model = [
        metrics.experiment_table(predicted.where(F.col("model") == name))
        for name in ("No Sentiment", "Sentiment")]
    return tables_per_model[0].unionByName(tables_per_model[1])


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = [technical.rsi, technical.returns_and_momentum, technical.bollinger,
              technical.moving_averages, technical.volume_features]
    table = apply_indicators(views.bars(spark, sf_dir), chosen).dropna()
    features = ["RSI", "Return_5", "BB_Pos", "BB_Width", "MA_20", "Volume_Ratio"]
    scored = metrics.feature_importance(labels.direction_label(table), features)
    return scored.select("feature", F.round("score", 4).alias("score"),
                         F.col("selected").cast("int").alias("selected"))


def _averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with sentiment, returns and moving averages, stored as the trainers expect them."""
    chosen = [technical.returns_and_momentum, technical.moving_averages]
    return stored(apply_indicators(_bars_with_sentiment(spark, sf_dir), chosen).dropna())


@query
def logistic_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per company: logistic regression without and with sentiment, judged on the later rows."""
    return experiments.logistic_experiment(_averages(spark, sf_dir))


@query
def sequence_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns predicted from the 60 rows before, without and with sentiment, judged per company."""
    return experiments.sequence_experiment(_averages(spark, sf_dir))


# A short sequence, whose regression SQL can solve as well.
SHORT_LOOKBACK = 5


@query
def sequence_ridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coefficients of every company's regression on sequences, without and with sentiment."""
    store, sets = experiments.sequence_inputs(_averages(spark, sf_dir), lookback=SHORT_LOOKBACK)
    fitted = lagged.lagged_ridge(store, sets, lookback=SHORT_LOOKBACK)
    rows = fitted.select("company", "model", F.posexplode(F.concat(F.array("intercept"), "weights")).alias("place", "weight"))
    return rounded(rows.withColumn("place", F.col("place").cast("long")), {"weight": RATIOS}, "company", "model", "place")


@query
def sequence_results_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results of the regressions on short sequences, judged per company."""
    return experiments.sequence_experiment(_averages(spark, sf_dir), lookback=SHORT_LOOKBACK)


@query
def sequence_ridge_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per company and model: sequences trained on and held out, and whether the fit on 60 steps is a minimum.

    The slopes are taken along the sequences themselves, not from the sums the fit was made of.
    """
    store, sets = experiments.sequence_inputs(_averages(spark, sf_dir))
    fitted = stored(lagged.lagged_ridge(store, sets))
    features = sets["Return Sequence + Sentiment"]
    errors = lagged.predicted(store, fitted, sets, train=True).select("company", "dt", "model", (F.col("y_pred") - F.col("y_true")).alias("error"))
    steps = sequence_plans.expanded(store, features).join(stored(errors), ["company", "dt"])
    slopes = steps.select("company", "model", "error", F.posexplode(F.flatten("sequence")).alias("at", "x")).groupBy("company", "model", "at").agg(
        F.sum(F.col("error") * F.col("x")).alias("slope"), F.sum("error").alias("level"), F.count(F.lit(1)).alias("n"))
    # Weights go from the newest step back, sequences from the oldest on; a set holds the first of the features.
    width = F.when(F.col("model") == "Return Sequence + Sentiment", len(features)).otherwise(len(features) - 1)
    feature, lag = F.col("at") % len(features), labels.LOOKBACK - 1 - F.floor(F.col("at") / len(features))
    weight = F.get("weights", (lag * width + feature).cast("int"))
    steep = slopes.join(fitted, ["company", "model"]).where(feature < width).groupBy("company", "model").agg(
        F.max("n").alias("train_sequences"), F.max(F.abs(F.col("slope") + weight)).alias("slope"), F.max(F.abs("level")).alias("level"))
    tested = lagged.predicted(store, fitted, sets).groupBy("company", "model").agg(F.count(F.lit(1)).alias("test_sequences"))
    return steep.join(tested, ["company", "model"]).select(
        "company", "model", "train_sequences", "test_sequences", (F.greatest("slope", "level") < 1e-6).cast("int").alias("optimal"))


@query
def sequence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next-day direction of all companies from ten standardised steps."""
    return experiments.pooled_experiment(_bars_with_sentiment(spark, sf_dir))


@query
def sequence_classifier_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pooled classifier is judged on: held-out sequences per company, rises among them, scores between 0 and 1."""
    scored = experiments.pooled_scores(_bars_with_sentiment(spark, sf_dir))
    return scored.groupBy("company").agg(
        F.count(F.lit(1)).alias("test_sequences"), F.sum("label").alias("rises"), F.max("dt").alias("newest"),
        F.count_if((F.col("prob") > 0) & (F.col("prob") < 1)).alias("scored"))


@query
def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per company: rows, rises, and rows whose probability is the same before a model is saved and after it is loaded."""
    chosen = [technical.moving_averages, technical.returns_and_momentum]
    table = apply_indicators(views.bars(spark, sf_dir), chosen).dropna()
    labelled = stored(labels.direction_label(table, horizon=1).withColumnRenamed("Target", "label"))
    path = scratch_folder(spark, "saved_model")
    before = models.train_next_day_model(labelled, path).transform(labelled)
    before = before.withColumn("before", models.vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
    both = models.PipelineModel.load(path).transform(before).withColumn("after", models.vector_to_array("probability")[1])
    return both.groupBy("company").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("rises"), F.count_if(F.col("before") == F.col("after")).alias("same"),
        F.count_if((F.col("after") > 0.5) == (F.col("prediction") == 1)).alias("told"))


@query
def score_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved model tells the next-day trend of each company's newest row."""
    chosen = [technical.moving_averages, technical.returns_and_momentum]
    table = stored(apply_indicators(views.bars(spark, sf_dir), chosen))
    labelled = labels.direction_label(table.dropna(), horizon=1).withColumnRenamed("Target", "label")
    path = scratch_folder(spark, "next_day_model")
    models.train_next_day_model(labelled, path)
    return models.score_latest(table, path)


@query
def score_latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of each company is scored, and that it got a trend."""
    return score_latest(spark, sf_dir).select("company", "dt", F.col("trend").isNotNull().cast("int").alias("scored"))


def _slopes(train: DataFrame, fits: DataFrame, features: list[str], sets: dict[str, list[str]]) -> DataFrame:
    """Per company and model: rows, rises, and whether the slope of the penalised loss is zero at the weights."""
    each = F.array(*(F.struct(F.lit(name).alias("model"), F.get("weights", F.lit(s)).alias("w"),
                              F.array(*(F.lit(float(f in chosen)) for f in features)).alias("used"))
                     for s, (name, chosen) in enumerate(sets.items())))
    rows = train.join(fits, "company").select("company", "label", *features, F.inline(each))
    w = [F.get("w", F.lit(i)) for i in range(len(features) + 1)]
    z = sum((w[i] * F.col(name) for i, name in enumerate(features)), w[-1])
    rows = rows.withColumn("error", 1 / (1 + F.exp(-z)) - F.col("label"))
    slopes = [F.sum(F.col("error") * F.col(name) * F.get("used", F.lit(i))) + F.any_value(w[i]) for i, name in enumerate(features)]
    return rows.groupBy("company", "model").agg(
        F.count(F.lit(1)).alias("train_rows"), F.sum("label").alias("rises"),
        (F.greatest(*map(F.abs, slopes), F.abs(F.sum("error"))) < 1e-6).cast("int").alias("optimal"))


@query
def logistic_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per company: training rows, rises among them, and whether the fit's slope is zero."""
    features = ["Return_1", "close"]
    rows = technical.returns_and_momentum(views.bars(spark, sf_dir)).select("company", "dt", *features)
    split = stored(splits.by_position(labels.direction_label(rows.dropna()).withColumnRenamed("Target", "label")))
    train = stored(scaling.min_max(split, features, F.col("is_train"), by=["company"]).where("is_train"))
    fits = models.logistic_weights(train, features).select("company", F.array("weights").alias("weights"))
    return _slopes(train, fits, features, {"all": features}).drop("model")


@query
def logistic_grid_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for four sets of features at once, each with zero weight for the features outside it."""
    features = ["Return_1", "close", "volume"]
    sets = {"one": ["close"], "two": ["volume", "Return_1"], "three": features, "none": []}
    rows = technical.returns_and_momentum(views.bars(spark, sf_dir)).select("company", "dt", *features)
    split = stored(splits.by_position(labels.direction_label(rows.dropna()).withColumnRenamed("Target", "label")))
    train = stored(scaling.min_max(split, features, F.col("is_train"), by=["company"]).where("is_train"))
    fits = stored(models.logistic_grid(train, sets))
    order = list(dict.fromkeys(f for chosen in sets.values() for f in chosen))
    outside = [F.when(F.get(F.get("weights", F.lit(s)), F.lit(i)) != 0, 1).otherwise(0)
               for s, chosen in enumerate(sets.values()) for i, f in enumerate(order) if f not in chosen]
    strays = fits.select("company", sum(outside[1:], outside[0]).cast("long").alias("stray_weights"))
    return _slopes(train, fits, order, sets).join(strays, "company")


@query
def logistic_results_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the experiment's rows stand on: held-out rows per company and model, rises among them, and scores between 0 and 1."""
    table = _averages(spark, sf_dir)
    labelled = labels.direction_label(windows.recent_years(table.select("company", "dt", "Return_1", "MA_10", "MA_20", "sentiment"), experiments.YEARS))
    split = stored(splits.by_position(labelled.dropna()))
    sets = {"Logistic (No Sentiment)": ["Return_1", "MA_10", "MA_20"], "Logistic + Sentiment": ["Return_1", "MA_10", "MA_20", "sentiment"]}
    scored = models.logistic_scores(split, sets)
    return scored.groupBy("company", "model").agg(
        F.count(F.lit(1)).alias("test_rows"), F.sum("label").alias("rises"), F.count_if((F.col("prob") > 0) & (F.col("prob") < 1)).alias("scored"),
        F.count_if(F.col("prediction") == (F.col("prob") > 0.5).cast("int")).alias("told"))
