import datetime as dt
import re

import pytest

from tidemark.operators import news

ARTICLES = "article_id BIGINT, company STRING, published_at DATE, text STRING, lang STRING"


def articles(spark, rows):
    return spark.createDataFrame(
        [(i, c, dt.date(2024, 1, d), t, lang) for i, (c, d, t, lang) in enumerate(rows)], ARTICLES)


def test_scores(spark):
    df = articles(spark, [
        ("A", 1, "Good, GOOD and bad!", "en"), ("A", 1, None, "en"), ("A", 1, "", "en"),
        ("A", 2, "nothing known here", "en"), ("B", 1, "x " * 500 + "worst", "en")])
    scored = news.score_text(df, news.default_lexicon(spark), "text")
    values = {r.article_id: round(r.sentiment, 6) for r in scored.collect()}
    assert values == {0: round((0.7 + 0.7 - 0.7) / 3, 6), 1: 0.0, 2: 0.0, 3: 0.0, 4: -1.0}
    daily = {(r.company, r.dt.day): round(r.sentiment, 6) for r in news.daily_sentiment(scored).collect()}
    assert daily == {("A", 1): round(0.7 / 9, 6), ("A", 2): 0.0, ("B", 1): -1.0}


def test_the_text_is_not_shuffled(spark):
    df = articles(spark, [("A", 1, "good", "en")])
    plan = news.score_text(df, news.default_lexicon(spark), "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_newest_articles_break_ties_by_number(spark):
    df = articles(spark, [("A", d, "t", "en") for d in (1, 3, 3, 2, 5)] + [("B", 1, "t", "en")])
    top = news.newest_articles(df, 3)
    assert sorted((r.company, r.article_id) for r in top.collect()) == [("A", 1), ("A", 2), ("A", 4), ("B", 5)]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


NAMES = {"ONE": "Acme", "TWO": "Blue Sky", "LONG": "The First Bank of North and South", "REP": "go go go go",
         "NONE": "!!", "DOT": "B.B. King Co"}
TEXTS = [
    "ACME rises; acme-like", "acmes are not it", "a blue   sky, today", "bluesky", "blue. Sky",
    "THE first bank of north, and south!", "the first bank of north and the south",
    "the first bank of the first bank of north and south", "go go go", "go go go go go", "b b king co",
    "king co b b", "", None,
]


def test_names_match_whole_phrases(spark, monkeypatch):
    df = articles(spark, [("X", 1, text, "en") for text in TEXTS] + [("X", 1, "Acme", "fr")])
    companies = spark.createDataFrame(list(NAMES.items()), "Symbol STRING, Security STRING")

    def plain(text):
        return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "

    expected = sorted((symbol, i) for symbol, name in NAMES.items() for i, text in enumerate(TEXTS)
                      if plain(name).strip() and plain(name) in plain(text))
    assert len(expected) == 7
    assert sorted((r.Symbol, r.article_id) for r in news.match_names(df, companies).collect()) == expected
    assert news.match_names(df, companies.where("Symbol = 'NONE'")).collect() == []
    monkeypatch.setattr(news, "NAME_CHARACTERS", 0)
    for limit in (news.BROADCAST_PIECES, 0):
        monkeypatch.setattr(news, "BROADCAST_PIECES", limit)
        found = news.match_names(df, companies)
        assert sorted((r.Symbol, r.article_id) for r in found.collect()) == expected
    for size in (0, 1000):
        monkeypatch.setattr(news, "NAME_CHARACTERS", size)
        assert len(news.match_names(df, companies, lang=None).collect()) == len(expected) + 1


def test_very_long_names_are_cut_into_short_pieces(spark, monkeypatch):
    name = " ".join(f"w{i % 5000}" for i in range(20_000))
    companies = spark.createDataFrame([("L", name), ("S", "w3 w4")], "Symbol string, Security string")
    pieces = news._name_pieces(companies, "Symbol", "Security")
    assert max(len(r.piece) for r in pieces.collect()) < 30
    articles = spark.createDataFrame([(1, "x " + name + " y", "en"), (2, "w1 w2 w3, W4", "en"), (3, name[:-1], "en")],
                                     "article_id long, text string, lang string")
    for size in (news.NAME_CHARACTERS, 0):
        monkeypatch.setattr(news, "NAME_CHARACTERS", size)
        got = {(r.Symbol, r.article_id) for r in news.match_names(articles, companies).collect()}
        assert got == {("L", 1), ("S", 1), ("S", 2), ("S", 3)}


def test_negations_and_intensifiers(spark):
    df = articles(spark, [("A", 1, t, "en") for t in ("not good", "very bad", "not very good", "extremely terrible", "good not", "no, really great")])
    got = {r.article_id: round(r.sentiment, 6) for r in news.score_text(df, news.default_lexicon(spark), "text").collect()}
    assert got == {0: -0.35, 1: -0.91, 2: -0.455, 3: -1.0, 4: 0.7, 5: -0.48}


def test_the_longest_phrase_counts(spark):
    lexicon = spark.createDataFrame([("good", 0.7), ("good for nothing", -0.8), ("Far, from  good", -0.4), ("nothing", -0.1), ("no loss", 0.5),
                                     ("loss", -0.5), ("loss", -0.3), ("", 1.0), (None, 1.0), ("bad", None), ("!!", 0.9)], "word string, polarity double")
    texts = ["good for nothing", "good, for nothing", "good for all", "far from good for nothing", "a no loss deal", "a loss", "no; loss",
             "GOOD GOOD FOR NOTHING AT ALL", "bad !!", None, "for nothing good for"]
    df = articles(spark, [("A", 1, t, "en") for t in texts])
    got = {r.article_id: round(r.sentiment, 6) for r in news.score_text(df, lexicon, "text").collect()}
    assert got == {0: -0.8, 1: -0.8, 2: 0.7, 3: round((-0.4 - 0.1) / 2, 6), 4: 0.5, 5: -0.4, 6: 0.5, 7: round((0.7 - 0.8) / 2, 6), 8: 0.0, 9: 0.0,
                   10: round((-0.1 + 0.7) / 2, 6)}
    ended = {r.article_id: round(r.sentiment, 6) for r in news.score_text(df, lexicon, "text", clauses=True).collect()}
    # A sign inside a phrase ends it, and a negation as well.
    assert (ended[1], ended[6]) == (round((0.7 - 0.1) / 2, 6), -0.4)


def test_negations_reach_to_the_end_of_their_clause(spark):
    texts = ["never in my life good", "never in my life, good", "no, really great", "not good and not bad", "it was not, as some say, bad; good",
             "not a very good day. very good"]
    df = articles(spark, [("A", 1, t, "en") for t in texts])
    got = {r.article_id: round(r.sentiment, 6) for r in news.score_text(df, news.default_lexicon(spark), "text", clauses=True).collect()}
    assert got == {0: -0.35, 1: 0.7, 2: 0.96, 3: 0.0, 4: 0.0, 5: round((-0.455 + 0.91) / 2, 6)}


def test_lexicons_without_end_fail(spark, monkeypatch):
    from tidemark.operators import polarity
    monkeypatch.setattr(polarity, "LEXICON_ROWS", 10)
    with pytest.raises(ValueError, match="more than 10"):
        news.score_text(articles(spark, [("A", 1, "good", "en")]), news.default_lexicon(spark), "text")
