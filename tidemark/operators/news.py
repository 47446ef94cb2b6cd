"""News articles: phrase matching, newest articles per company, headline polarity, daily mean."""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import runs_of_words, words
from tidemark.operators.polarity import polarity

# Names are looked up in pieces of at most this many words.
PIECE_WORDS = 3

# Names of so many characters together are sent to every task and looked for in the texts where they are read.
NAME_CHARACTERS = 1_000_000

# Name pieces up to this number are broadcast; more of them are joined by a shuffle.
BROADCAST_PIECES = 200_000

# A small default lexicon; real jobs pass their own table (word, polarity).
DEFAULT_POLARITY = {
    "best": 1.0, "excellent": 1.0, "great": 0.8, "good": 0.7, "strong": 0.4, "profit": 0.5,
    "gain": 0.5, "gains": 0.5, "growth": 0.4, "beat": 0.4, "record": 0.3, "rise": 0.3,
    "rises": 0.3, "up": 0.1, "rest": 0.1, "heed": 0.2, "weak": -0.4, "loss": -0.5,
    "losses": -0.5, "fall": -0.3, "falls": -0.3, "down": -0.1, "miss": -0.4, "shed": -0.2,
    "sting": -0.3, "stinging": -0.4, "lawsuit": -0.5, "fraud": -0.9, "bad": -0.7,
    "terrible": -1.0, "worst": -1.0, "worthless": -0.8, "stupid": -0.8, "trash": -0.6,
    "idiot": -0.8,
}


def default_lexicon(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{word}', {polarity}D)" for word, polarity in DEFAULT_POLARITY.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(word, polarity)")


def score_text(articles: DataFrame, lexicon: DataFrame, text: str = "title",
               keep: Sequence[str] = ("article_id", "company", "published_at"), clauses: bool = False) -> DataFrame:
    """The ``keep`` columns and ``sentiment``: the mean polarity of the lexicon's words and phrases in
    the whole text, 0.0 if it has none. See ``polarity`` for the lexicon and for negations.

    A text is scored where it is read, so nothing is shuffled.
    """
    return articles.select(*keep, polarity(F.col(text), lexicon, clauses).alias("sentiment"))


def newest_articles(articles: DataFrame, limit: int = 10, company: str = "company",
                    time: str = "published_at", tie: str = "article_id") -> DataFrame:
    """The newest ``limit`` articles of each company.

    Spark evaluates a row-number limit on each map task before the shuffle, so a company with
    very many articles sends at most ``limit`` rows per task.
    """
    newest_first = Window.partitionBy(company).orderBy(F.col(time).desc_nulls_last(), F.col(tie))
    return (
        articles.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= limit).drop("_rank")
    )


def match_names(articles: DataFrame, companies: DataFrame, text: str = "text", lang: str | None = "en",
                keep: Sequence[str] = ("article_id",), ticker: str = "Symbol",
                name: str = "Security") -> DataFrame:
    """(ticker, article) pairs whose text holds the company's name as an exact phrase.

    Upper and lower case and punctuation do not matter, words must match whole. Names that are short
    enough together are sent to every task as one automaton, which finds all of them in one walk over a
    text; only found pairs leave the task. Beyond that, names are cut into pieces of up to three words,
    each with its place in the name, and met with the article's runs of words by an equality join; a
    name occurs where all its pieces line up. Texts are shuffled in neither case, only matching runs are.
    """
    if lang is not None:
        articles = articles.where(F.col("lang") == lang)
    plain = companies.select(F.col(ticker).alias("_ticker"), F.array_join(words(F.col(name)), " ").alias("_name")).where("_name != ''")
    size = plain.agg(F.sum(F.char_length("_name") + 2)).first()[0] or 0
    if size <= NAME_CHARACTERS:
        return _found_names(articles, plain, text, keep, ticker, companies.schema[ticker].dataType.simpleString())
    return _joined_names(articles, companies, text, keep, ticker, name)


def _found_names(articles: DataFrame, names: DataFrame, text: str, keep: Sequence[str], ticker: str, kind: str) -> DataFrame:
    """The pairs, by one automaton over all names; ``names`` has _ticker and _name, words joined by blanks."""
    tickers: dict[str, set] = {}
    for row in names.collect():
        tickers.setdefault(row["_name"], set()).add(row["_ticker"])
    listed = list(tickers)
    automaton = ahocorasick.Automaton()
    for number, found in enumerate(listed):
        automaton.add_word(f" {found} ", number)
    if listed:
        automaton.make_automaton()
    shared = articles.sparkSession.sparkContext.broadcast((automaton, len(listed)))

    def numbers(texts: pd.Series) -> pd.Series:
        automaton, count = shared.value
        if not count:
            return pd.Series([[]] * len(texts))
        return pd.Series([sorted({number for _, number in automaton.iter(f" {one} ")}) for one in texts])

    # Signs and blanks become one blank, so a name stands between blanks wherever its words do.
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    found = articles.select(*keep, F.explode(F.pandas_udf(numbers, "array<int>")(plain)).alias("_number"))
    rows = [(number, one) for number, name in enumerate(listed) for one in tickers[name]]
    known = F.broadcast(articles.sparkSession.createDataFrame(rows, f"_number int, `{ticker}` {kind}"))
    return found.join(known, "_number").select(ticker, *keep).distinct()


def _joined_names(articles: DataFrame, companies: DataFrame, text: str, keep: Sequence[str], ticker: str, name: str) -> DataFrame:
    pieces = _name_pieces(companies, ticker, name)
    sizes = {row["_width"]: row["count"] for row in pieces.groupBy("_width").count().collect()}
    if sum(sizes.values()) <= BROADCAST_PIECES:
        pieces = F.broadcast(pieces)
    tokens = articles.select(*keep, words(F.col(text)).alias("_tokens"))
    runs = F.array(*(runs_of_words(F.col("_tokens"), n) for n in sorted(sizes) or [PIECE_WORDS]))
    found = (
        tokens.select(*keep, F.explode(runs).alias("_runs"))
        .select(*keep, F.posexplode("_runs").alias("_place", "piece"))
    )
    lined_up = (
        found.join(pieces, "piece")
        .groupBy(*keep, ticker, "_phrase", "_pieces", (F.col("_place") - F.col("_offset")).alias("_start"))
        .count().where(F.col("count") == F.col("_pieces"))
    )
    return lined_up.select(ticker, *keep).distinct()


def _name_pieces(companies: DataFrame, ticker: str, name: str) -> DataFrame:
    """Each name as pieces of ``PIECE_WORDS`` words that cover it; the last one may overlap.

    A piece carries a number for its name, not the name, so pieces grow with the names' length only.
    """
    named = companies.select(ticker, words(F.col(name)).alias("_name")).where(F.size("_name") > 0)
    width = F.least(F.size("_name"), F.lit(PIECE_WORDS))
    last = F.size("_name") - width
    offsets = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(PIECE_WORDS)), F.array(last)))
    return (
        named.select(ticker, "_name", F.xxhash64(ticker, "_name").alias("_phrase"),
                     F.size(offsets).alias("_pieces"), width.alias("_width"),
                     F.explode(offsets).alias("_offset"))
        .withColumn("piece", F.array_join(F.slice("_name", F.col("_offset") + 1, F.col("_width")), " "))
        .select(ticker, "_phrase", "_pieces", "_width", "_offset", "piece").distinct()
    )


def daily_sentiment(scored: DataFrame, company: str = "company", time: str = "published_at") -> DataFrame:
    """Mean sentiment per company and day; articles without a time are left out."""
    return (
        scored.where(F.col(time).isNotNull()).groupBy(F.col(company).alias("company"), F.to_date(time).alias("dt"))
        .agg(F.avg("sentiment").alias("sentiment"))
    )
