"""The same results in ANSI SQL, written independently of the Spark code.

Recursive means are written as explicit weighted sums over all earlier rows, and ranks as
global windows: slow at scale, but plain statements of what the result must be.
"""

from __future__ import annotations


_oracles: dict[str, str] = {}

# Fixed values, written out here so that a wrong one in the code under test shows.
TIME_FRAMES = {"1W": 7, "1M": 30, "3M": 90, "6M": 180, "1Y": 365, "ALL": None}
COMPANIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
NEWS_START, NEWS_DAYS = "1995-01-01", 2400
DEFAULT_POLARITY = {
    "best": 1.0, "excellent": 1.0, "great": 0.8, "good": 0.7, "strong": 0.4, "profit": 0.5,
    "gain": 0.5, "gains": 0.5, "growth": 0.4, "beat": 0.4, "record": 0.3, "rise": 0.3,
    "rises": 0.3, "up": 0.1, "rest": 0.1, "heed": 0.2, "weak": -0.4, "loss": -0.5,
    "losses": -0.5, "fall": -0.3, "falls": -0.3, "down": -0.1, "miss": -0.4, "shed": -0.2,
    "sting": -0.3, "stinging": -0.4, "lawsuit": -0.5, "fraud": -0.9, "bad": -0.7,
    "terrible": -1.0, "worst": -1.0, "worthless": -0.8, "stupid": -0.8, "trash": -0.6,
    "idiot": -0.8,
}

# --- Views ------------------------------------------------------------------------------------

BARS = """bars AS (
  SELECT o_orderpriority AS company, CAST(o_orderdate AS DATE) AS dt,
         MIN_BY(o_totalprice, o_orderkey) AS open, MAX(o_totalprice) AS high,
         MIN(o_totalprice) AS low, MAX_BY(o_totalprice, o_orderkey) AS close,
         CAST(COUNT(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""

BARS_HOUR = """bars AS (
  SELECT event_type AS company, DATE_TRUNC('hour', ts) AS dt,
         MIN_BY(value, event_id) AS open, MAX(value) AS high, MIN(value) AS low,
         MAX_BY(value, event_id) AS close, CAST(COUNT(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""

BARS_SUPPLIER = """bars AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS company, CAST(l_shipdate AS DATE) AS dt,
         MIN(l_extendedprice) AS open, MAX(l_extendedprice) AS high, MIN(l_extendedprice) AS low,
         AVG(l_extendedprice) AS close, SUM(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""

_names = ", ".join(f"'{name}'" for name in COMPANIES)
NEWS = f"""news AS (
  SELECT doc_id AS article_id,
         list_extract([{_names}], CAST(doc_id % {len(COMPANIES)} AS INTEGER) + 1) AS company,
         DATE '{NEWS_START}' + CAST((doc_id * 7) % {NEWS_DAYS} AS INTEGER) AS published_at,
         text AS title, lang
  FROM documents)"""

_words = ", ".join(f"('{word}', CAST({value} AS DOUBLE))" for word, value in DEFAULT_POLARITY.items())
SCORED = f"""{NEWS},
lexicon(word, polarity) AS (VALUES {_words}),
lists AS (SELECT article_id, regexp_split_to_array(LOWER(title), '[^\\p{{L}}\\p{{N}}]+') AS words FROM news),
placed AS (SELECT article_id, UNNEST(words) AS word, generate_subscripts(words, 1) AS place FROM lists),
tokens AS (
  SELECT article_id, word, LAG(word) OVER w AS before, LAG(word, 2) OVER w AS earlier
  FROM placed WINDOW w AS (PARTITION BY article_id ORDER BY place)),
strong(before, strength) AS (VALUES ('very', 1.3::DOUBLE), ('highly', 1.3), ('really', 1.2), ('extremely', 1.5), ('somewhat', 0.7), ('slightly', 0.5)),
turned AS (
  SELECT article_id, polarity * COALESCE(strength, 1) * CASE WHEN before IN ('not', 'no', 'never', 'without')
           OR (strength IS NOT NULL AND earlier IN ('not', 'no', 'never', 'without')) THEN CAST(-0.5 AS DOUBLE) ELSE 1 END AS polarity
  FROM tokens JOIN lexicon USING (word) LEFT JOIN strong USING (before)),
found AS (
  SELECT article_id, AVG(GREATEST(-1, LEAST(1, polarity))) AS polarity FROM turned GROUP BY 1),
scored AS (
  SELECT n.article_id, n.company, n.published_at, COALESCE(f.polarity, CAST(0 AS DOUBLE)) AS sentiment
  FROM news n LEFT JOIN found f USING (article_id))"""

DAILY = f"""{SCORED},
daily AS (SELECT company, published_at AS dt, AVG(sentiment) AS sentiment FROM scored GROUP BY 1, 2)"""

SENTIMENT_BARS = f"""{DAILY}, price_bars AS (SELECT * FROM ({{inner}})),
bars AS (
  SELECT p.*, COALESCE(d.sentiment, CAST(0 AS DOUBLE)) AS sentiment
  FROM price_bars p LEFT JOIN daily d USING (company, dt))""".replace(
    "{inner}", BARS.removeprefix("bars AS (").removesuffix(")"))

# --- Building blocks --------------------------------------------------------------------------

BY_COMPANY = "PARTITION BY company ORDER BY dt"


def rnd(expression: str, digits: int, name: str) -> str:
    """Rounded and without negative zero."""
    return f"ROUND({expression}, {digits}) + CAST(0 AS DOUBLE) AS \"{name}\""


def strict(agg: str, x: str, n: int) -> str:
    frame = f"OVER ({BY_COMPANY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN COUNT({x}) {frame} = {n} THEN {agg}({x}) {frame} END"


def lag(x: str, n: int = 1) -> str:
    return f"LAG({x}, {n}) OVER ({BY_COMPANY})" if n > 0 else f"LEAD({x}, {-n}) OVER ({BY_COMPANY})"


def change(x: str, n: int = 1) -> str:
    """Relative change; no price or volume here is zero."""
    return f"({x} / ({lag(x, n)}) - 1)"


def ema(source: str, x: str, alpha: str, out: str, name: str, keep: str = "") -> str:
    """CTE ``out``: the recursive mean of ``x`` as a weighted sum over all earlier rows."""
    return f"""{out}_rows AS (
  SELECT company, dt, {x} AS x, ROW_NUMBER() OVER ({BY_COMPANY}) AS i FROM {source} WHERE {x} IS NOT NULL),
{out} AS (
  SELECT t.company, t.dt,
         SUM(CASE WHEN s.i = 1 THEN 1 ELSE {alpha} END * POW(1 - {alpha}, t.i - s.i) * s.x) AS {name}
  FROM {out}_rows t JOIN {out}_rows s ON s.company = t.company AND s.i <= t.i GROUP BY 1, 2)"""


A12, A26, A9, A14 = ("(CAST(2 AS DOUBLE) / 13)", "(CAST(2 AS DOUBLE) / 27)", "(CAST(2 AS DOUBLE) / 10)",
                     "(CAST(1 AS DOUBLE) / 14)")
EPS = "CAST(1e-9 AS DOUBLE)"

MACD_PARTS = f"""{ema('bars', 'close', A12, 'e12', 'v')},
{ema('bars', 'close', A26, 'e26', 'v')},
macd AS (SELECT company, dt, e12.v AS ema_12, e26.v AS ema_26, e12.v - e26.v AS macd
         FROM e12 JOIN e26 USING (company, dt)),
{ema('macd', 'macd', A9, 'e9', 'v')},
macds AS (SELECT macd.*, e9.v AS signal, macd - e9.v AS hist FROM macd JOIN e9 USING (company, dt))"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def select(ctes: str, columns: list[str], source: str = "bars", keys: str = "company, dt") -> str:
    return with_(ctes, f"SELECT {keys}, {', '.join(columns)} FROM {source}")


# --- Technical indicators ---------------------------------------------------------------------

_MA = [rnd(strict("AVG", "close", n), 4, f"MA_{n}") for n in (10, 20, 50)]
_oracles["moving_averages"] = select(BARS, _MA)
_oracles["moving_averages_cut"] = _oracles["moving_averages"]

_oracles["ticks_cut"] = select(BARS_HOUR.replace("DATE_TRUNC('hour', ts)", "ts"), _MA)

_oracles["ema"] = with_(f"{BARS}, {MACD_PARTS}", f"""SELECT company, dt, {rnd('ema_12', 2, 'EMA_12')},
{rnd('ema_26', 2, 'EMA_26')} FROM macds""")
_MACD = [rnd("macd", 2, "MACD"), rnd("signal", 2, "MACD_Signal"), rnd("hist", 2, "MACD_Hist")]
_oracles["macd"] = select(f"{BARS}, {MACD_PARTS}", _MACD, "macds")
_oracles["macd_cut"] = _oracles["macd"]

_ALPHA = "(CAST(2 AS DOUBLE) / ({} + 1))"
_oracles["ema_long_cut"] = with_(
    f"""{BARS}, {ema('bars', 'close', _ALPHA.format(10000), 'long', 'v')}, {ema('bars', 'close', _ALPHA.format(500), 'short', 'v')}""",
    f"""SELECT company, dt, {rnd('long.v', 4, 'EMA_10000')}, {rnd('short.v', 4, 'EMA_500')}
FROM long JOIN short USING (company, dt)""")
_oracles["macd_long_cut"] = with_(f"""{BARS}, {ema('bars', 'close', _ALPHA.format(120), 'e120', 'v')},
{ema('bars', 'close', _ALPHA.format(260), 'e260', 'v')},
macd AS (SELECT company, dt, e120.v - e260.v AS macd FROM e120 JOIN e260 USING (company, dt)),
{ema('macd', 'macd', _ALPHA.format(90), 'e90', 'v')}""", f"""SELECT company, dt, {rnd('macd', 4, 'MACD')},
{rnd('e90.v', 4, 'MACD_Signal')}, {rnd('macd - e90.v', 4, 'MACD_Hist')} FROM macd JOIN e90 USING (company, dt)""")

_oracles["drawdown_cut"] = with_(f"""{BARS}, walked AS (SELECT company, dt, close, ROW_NUMBER() OVER ({BY_COMPANY}) AS i,
  MAX(close) OVER ({BY_COMPANY}) AS peak, COALESCE(close > {lag('close')}, FALSE) AS rise FROM bars)""",
    f"""SELECT company, dt, {rnd('close / peak - 1', 6, 'Drawdown')},
i - MAX(CASE WHEN close = peak THEN i END) OVER ({BY_COMPANY}) AS "Rows_Since_Peak",
i - MAX(CASE WHEN NOT rise THEN i END) OVER ({BY_COMPANY}) AS "Rising_Rows" FROM walked""")

_DELTA = f"delta AS (SELECT *, close - {lag('close')} AS d, {lag('close')} AS prior FROM bars)"
_MOVES = f"""{_DELTA}, moves AS (
  SELECT *, CASE WHEN d IS NOT NULL THEN GREATEST(d, 0) END AS gain,
         CASE WHEN d IS NOT NULL THEN GREATEST(-d, 0) END AS loss,
         close / prior - 1 AS ret,
         CASE WHEN prior IS NOT NULL THEN GREATEST(high - low, ABS(high - prior), ABS(low - prior)) END AS tr
  FROM delta)"""
_RSI = rnd(f"100 - 100 / (1 + ({strict('AVG', 'gain', 14)}) / (({strict('AVG', 'loss', 14)}) + {EPS}))", 6, "RSI")
_oracles["rsi_simple"] = select(f"{BARS}, {_MOVES}", [_RSI], "moves")

_BANDS = f"""bands AS (SELECT *, {strict('AVG', 'close', 20)} AS mid, {strict('STDDEV_SAMP', 'close', 20)} AS sd
  FROM {{source}})"""
_BB = [rnd("mid", 4, "BB_Mid"), rnd("sd", 2, "BB_Std"), rnd("mid + 2 * sd", 2, "BB_Upper"),
       rnd("mid - 2 * sd", 2, "BB_Lower"), rnd(f"4 * sd / (mid + {EPS})", 6, "BB_Width"),
       rnd(f"(close - (mid - 2 * sd)) / (4 * sd + {EPS})", 6, "BB_Pos")]
_oracles["bollinger"] = select(f"{BARS}, {_BANDS.format(source='bars')}", _BB, "bands")

_RETURNS = [rnd(change("close", n), 6, f"Return_{n}") for n in (1, 3, 5, 10)] + [
    rnd(f"close - {lag('close', n)}", 2, f"Momentum_{n}") for n in (1, 3, 5, 10)]
_oracles["returns_momentum"] = select(BARS, _RETURNS)

_VOL = [rnd(strict("STDDEV_SAMP", "ret", n), 6, f"Vol_{n}") for n in (10, 20)]
_oracles["volatility"] = select(f"{BARS}, {_MOVES}", _VOL, "moves")
_ATR = rnd(strict("AVG", "tr", 14), 4, "ATR_14")
_oracles["atr"] = select(f"{BARS}, {_MOVES}", [_ATR], "moves")

_MEANS = "means AS (SELECT *, " + ", ".join(
    f"{strict('AVG', 'close', n)} AS m{n}" for n in (10, 20, 50)) + " FROM {source})"
_RATIOS = [rnd(f"(close - m20) / (m20 + {EPS})", 6, "Price_vs_MA20"),
           rnd(f"(close - m50) / (m50 + {EPS})", 6, "Price_vs_MA50"),
           rnd(f"(m10 - m20) / (m20 + {EPS})", 6, "MA_spread")]
_oracles["price_ratios"] = select(f"{BARS}, {_MEANS.format(source='bars')}", _RATIOS, "means")

_VOLUME = [rnd(strict("AVG", "volume", 10), 6, "Volume_MA10"),
           rnd(f"volume / (({strict('AVG', 'volume', 10)}) + {EPS})", 6, "Volume_Ratio"),
           rnd(change("volume"), 6, "Volume_Change")]
_oracles["volume_features"] = select(BARS, _VOLUME)

_STOCH = f"""stoch AS (SELECT *,
  100 * (close - ({strict('MIN', 'low', 14)})) / (({strict('MAX', 'high', 14)}) - ({strict('MIN', 'low', 14)}) + {EPS}) AS k
  FROM {{source}})"""
_KD = [rnd("k", 6, "Stoch_K"), rnd(strict("AVG", "k", 3), 6, "Stoch_D")]
_oracles["stochastic"] = select(f"{BARS}, {_STOCH.format(source='bars')}", _KD, "stoch")

_CANDLES = [rnd("ABS(close - open)", 2, "Candle_Body"), rnd("high - low", 2, "Candle_Range"),
            rnd("CAST(SIGN(close - open) AS DOUBLE)", 0, "Candle_Dir")]
_oracles["candles"] = select(BARS, _CANDLES)

_oracles["hourly_cut"] = select(
    f"{BARS_HOUR}, {_MOVES}, {_STOCH.format(source='moves')}", [*_MA, _RSI, *_KD, *_CANDLES], "stoch")


# Wilder smoothing: the first move counts as 0 and the first 13 rows stay empty.
def wilder(source: str) -> str:
    return f"""ups AS (SELECT company, dt, ROW_NUMBER() OVER ({BY_COMPANY}) AS pos,
  COALESCE(GREATEST(close - {lag('close')}, 0), 0) AS x FROM {source}),
downs AS (SELECT company, dt, CASE WHEN {lag('close')} IS NULL THEN 0
  ELSE GREATEST({lag('close')} - close, 0) END AS x FROM {source}),
{ema('ups', 'x', A14, 'up', 'v')},
{ema('downs', 'x', A14, 'down', 'v')},
wilder AS (SELECT company, dt, CASE WHEN pos < 14 THEN NULL WHEN down.v = 0 THEN 100
  ELSE 100 - 100 / (1 + up.v / down.v) END AS rsi
  FROM ups JOIN up USING (company, dt) JOIN down USING (company, dt))"""


# The signal starts at the first visible MACD and is itself hidden for eight more rows.
def masked_macd(source: str) -> str:
    return f"""{ema(source, 'close', A12, 'e12', 'v')},
{ema(source, 'close', A26, 'e26', 'v')},
shown AS (SELECT company, dt, CASE WHEN ROW_NUMBER() OVER ({BY_COMPANY}) >= 26 THEN e12.v - e26.v END AS macd
  FROM e12 JOIN e26 USING (company, dt)),
{ema('shown', 'macd', A9, 'e9', 'v')},
display AS (SELECT company, dt, macd,
  CASE WHEN ROW_NUMBER() OVER ({BY_COMPANY}) >= 34 THEN e9.v END AS signal
  FROM shown LEFT JOIN e9 USING (company, dt))"""


_oracles["rsi_wilder"] = select(f"{BARS}, {wilder('bars')}", [rnd("rsi", 6, "RSI")], "wilder")
_oracles["macd_display"] = select(
    f"{BARS}, {masked_macd('bars')}", [rnd("macd", 2, "MACD"), rnd("signal", 2, "MACD_Signal")], "display")

# --- News and sentiment -----------------------------------------------------------------------

_oracles["lexicon_sentiment"] = select(
    SCORED, [rnd("sentiment", 6, "sentiment")], "scored", "article_id, company, published_at")
# The longest phrase at each place, then a walk from phrase to phrase that leaves out what overlaps.
PHRASES = {
    "the": 0.1, "the and": -0.4, "the and attion to": 0.9, "of the": 0.5, "of the of": -0.6, "to the": 0.3, "is the": -0.2,
    "rest": 0.1, "heed": 0.2, "for the": 0.4, "a": -0.1, "in the a": -0.7,
}
_phrases = ", ".join(f"('{phrase}', CAST({value} AS DOUBLE))" for phrase, value in PHRASES.items())
_oracles["phrase_sentiment"] = f"""WITH RECURSIVE {NEWS},
lexicon(phrase, polarity) AS (VALUES {_phrases}),
lists AS (SELECT article_id, regexp_extract_all(LOWER(REPLACE(REPLACE(title, ' that ', ' not '), ' with ', ' very ')),
  '[\\p{{L}}\\p{{N}}]+|[.,;:!?]+') AS words FROM news),
placed AS (SELECT article_id, UNNEST(words) AS word, generate_subscripts(words, 1) AS i FROM lists),
around AS (
  SELECT article_id, i, word, LAG(word) OVER w AS before, LEAD(word, 1) OVER w AS w2, LEAD(word, 2) OVER w AS w3, LEAD(word, 3) OVER w AS w4,
    MAX(CASE WHEN word IN ('not', 'no', 'never', 'without') THEN i END) OVER past AS turned,
    MAX(CASE WHEN regexp_matches(word, '^[.,;:!?]') THEN i END) OVER past AS ended
  FROM placed WINDOW w AS (PARTITION BY article_id ORDER BY i),
    past AS (PARTITION BY article_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tried AS (SELECT article_id, i, before, turned, ended, UNNEST([1, 2, 3, 4]) AS n,
  UNNEST([word, word || ' ' || w2, word || ' ' || w2 || ' ' || w3, word || ' ' || w2 || ' ' || w3 || ' ' || w4]) AS phrase FROM around),
longest AS MATERIALIZED (SELECT article_id, i, n, polarity * CASE before WHEN 'very' THEN CAST(1.3 AS DOUBLE) ELSE 1 END
    * CASE WHEN turned > COALESCE(ended, 0) THEN CAST(-0.5 AS DOUBLE) ELSE 1 END AS polarity
  FROM tried JOIN lexicon USING (phrase) QUALIFY ROW_NUMBER() OVER (PARTITION BY article_id, i ORDER BY n DESC) = 1),
linked AS MATERIALIZED (SELECT a.article_id, a.i, b.i AS next FROM longest a ASOF JOIN longest b
  ON a.article_id = b.article_id AND a.i + a.n <= b.i),
walk AS (
  SELECT article_id, MIN(i) AS i FROM longest GROUP BY 1
  UNION ALL SELECT w.article_id, l.next FROM walk w JOIN linked l ON l.article_id = w.article_id AND l.i = w.i),
found AS (SELECT article_id, AVG(GREATEST(-1, LEAST(1, polarity))) AS polarity FROM walk JOIN longest USING (article_id, i) GROUP BY 1)
SELECT n.article_id, n.company, n.published_at, {rnd('COALESCE(f.polarity, CAST(0 AS DOUBLE))', 6, 'sentiment')}
FROM news n LEFT JOIN found f USING (article_id)"""
_oracles["daily_sentiment"] = select(DAILY, [rnd("sentiment", 6, "sentiment")], "daily")
_oracles["news_top_n"] = with_(NEWS, """SELECT company, article_id, published_at, LENGTH(title) AS title_length
FROM news WHERE lang = 'en'
QUALIFY ROW_NUMBER() OVER (PARTITION BY company ORDER BY published_at DESC, article_id) <= 10""")
_oracles["news_extract"] = with_(NEWS, """SELECT company AS ticker,
  STRFTIME(published_at, '%Y-%m-%d') || ' 09:30' AS published_at, lang, LENGTH(title) AS title_length,
  MD5(title) AS title_md5 FROM news""")
_PLAIN = "' ' || TRIM(REGEXP_REPLACE(LOWER({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
_oracles["news_phrase_match"] = f"""SELECT 'ITEM.' || b.item_id AS ticker, d.doc_id AS article_id
FROM (SELECT doc_id, {_PLAIN.format(x='text')} AS plain FROM documents WHERE lang = 'en') d
JOIN (SELECT item_id, {_PLAIN.format(x='text')} AS phrase FROM benchmark) b
  ON CONTAINS(d.plain, b.phrase)"""
_oracles["ticker_normalize"] = \
    "SELECT REPLACE('S.' || s_suppkey, '.', '-') AS \"Symbol\", s_name AS \"Security\" FROM supplier"
_oracles["sentiment_join"] = with_(SENTIMENT_BARS, f"""SELECT company AS ticker, dt AS date,
{rnd('close', 2, 'close')}, {rnd('volume', 0, 'volume')}, {rnd('sentiment', 6, 'daily_sentiment')} FROM bars""")
_oracles["optional_sentiment"] = select(
    BARS, [rnd("close", 2, "close"), "CAST(0 AS DOUBLE) AS sentiment"])

_oracles["sentiment_present"] = select(SENTIMENT_BARS, [rnd("close", 2, "close"), rnd("sentiment", 6, "sentiment")])

_SENT = [*(rnd(lag("sentiment", n), 6, f"Sentiment_Lag{n}") for n in (1, 2, 3)),
         rnd(strict("AVG", "sentiment", 3), 6, "Sentiment_MA3"),
         rnd(strict("AVG", "sentiment", 7), 6, "Sentiment_MA7"),
         rnd(strict("STDDEV_SAMP", "sentiment", 5), 6, "Sentiment_Std5"),
         rnd(f"sentiment - {lag('sentiment')}", 6, "Sentiment_Change"),
         rnd(f"sentiment - 2 * {lag('sentiment')} + {lag('sentiment', 2)}", 6, "Sentiment_Accel"),
         rnd(strict("SUM", "sentiment", 5), 6, "Sentiment_Cum5")]
_oracles["sentiment_windows"] = select(SENTIMENT_BARS, _SENT)
_WEIGHT = "weighted AS (SELECT *, sentiment * LN(1 + volume) AS sw FROM {source})"
_INTER = [rnd(f"sentiment * {change('close')}", 6, "Sent_x_Return1"),
          rnd(f"sentiment * (close - {lag('close', 5)})", 6, "Sent_x_Momentum"),
          rnd("sw", 6, "Sentiment_Weighted"), rnd(strict("AVG", "sw", 3), 6, "Sentiment_Weighted_MA"),
          "CAST(sentiment > 0 AS INTEGER) AS \"Sentiment_Pos\"",
          "CAST(sentiment < 0 AS INTEGER) AS \"Sentiment_Neg\""]
_oracles["sentiment_interactions"] = select(
    f"{SENTIMENT_BARS}, {_WEIGHT.format(source='bars')}", _INTER, "weighted")

_CHAIN = f"""{_MOVES}, {_BANDS.format(source='moves')}, {_MEANS.format(source='bands')},
{_STOCH.format(source='means')}, {_WEIGHT.format(source='stoch')}, {MACD_PARTS},
joined AS (SELECT w.*, m.ema_12, m.ema_26, m.macd, m.signal, m.hist FROM weighted w JOIN macds m USING (company, dt))"""
_ALL = [rnd(name.lower(), 2, name) for name in ("Open", "High", "Low", "Close", "Volume")] + [
    *_MA, rnd("ema_12", 2, "EMA_12"), rnd("ema_26", 2, "EMA_26"), *_MACD, _RSI, *_BB, *_RETURNS, *_VOL, _ATR,
    *_RATIOS, *_VOLUME, *_KD, *_CANDLES, rnd("sentiment", 6, "Sentiment"), *_SENT, *_INTER]
_KEYS = "company AS \"Company\", dt AS \"Date\""
# MA_50 has the longest warm-up, so the complete rows are those where it exists.
_oracles["feature_table_60"] = with_(
    f"{SENTIMENT_BARS}, {_CHAIN}, every AS (SELECT {_KEYS}, {', '.join(_ALL)} FROM joined)",
    "SELECT * FROM every WHERE \"MA_50\" IS NOT NULL")
_oracles["feature_table_cut"] = _oracles["feature_table_60"]
_PART = [rnd("close", 4, "Close"), rnd("ema_26", 2, "EMA_26"), _RSI, _BB[1], _VOL[1], _RATIOS[1], _KD[1]]
_PLAIN_CHAIN = f"""{_MOVES}, {_BANDS.format(source='moves')}, {_MEANS.format(source='bands')}, {_STOCH.format(source='means')},
{ema('bars', 'close', A26, 'e26', 'v')},
joined AS (SELECT s.*, e26.v AS ema_26 FROM stoch s JOIN e26 USING (company, dt))"""
_oracles["feature_table_suppliers"] = with_(
    f"{BARS_SUPPLIER}, {_PLAIN_CHAIN}, every AS (SELECT {_KEYS}, {', '.join(_PART)} FROM joined)",
    "SELECT * FROM every WHERE \"Price_vs_MA50\" IS NOT NULL")

# --- Sources, cleaning, reshaping -------------------------------------------------------------

_oracles["scan_parquet"] = """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS dt,
o_totalprice AS price FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'"""
_oracles["scan_csv_dir"] = with_(BARS, "SELECT * FROM bars")
_oracles["clean_prices"] = with_(BARS, f"""SELECT company, dt,
{rnd('CASE WHEN open > close THEN NULL ELSE open END', 2, 'open')}, {rnd('close', 2, 'close')},
{rnd('volume', 0, 'volume')} FROM bars WHERE DAY(dt) <> 31""")
_oracles["unique_keys"] = with_(BARS, "SELECT company, COUNT(*) AS days FROM bars GROUP BY 1")
_oracles["pivot_wide"] = with_(BARS, "SELECT dt, " + ", ".join(
    f"MAX(CASE WHEN company = '{c}' THEN {f} END) AS \"{c.replace('-', '_').replace(' ', '_')}_{f.capitalize()}\""
    for c in COMPANIES for f in ("close", "volume")) + " FROM bars GROUP BY dt")
_oracles["wide_to_long"] = with_(BARS, """SELECT STRFTIME(dt, '%Y-%m-%d') AS date, company AS ticker,
open, high, low, close, volume FROM bars WHERE company <> '5-LOW'""")
_oracles["wide_blocks"] = with_(BARS_SUPPLIER, f"""SELECT company, dt, {rnd('open', 2, 'open')}, {rnd('high', 2, 'high')},
{rnd('low', 2, 'low')}, {rnd('close', 4, 'close')}, {rnd('volume', 2, 'volume')} FROM bars""")
_oracles["wide_columns"] = with_(BARS_SUPPLIER, "SELECT dt, " + ", ".join(
    rnd(f"MAX(CASE WHEN company = '{t}' THEN high END)", 2, f"high_{t}") for t in (1, 3, 7)) + """, COUNT(*) AS tickers
FROM bars GROUP BY dt HAVING COUNT(*) FILTER (company IN ('1', '3', '7')) > 0""")
_oracles["drop_empty_series"] = with_(BARS, """SELECT dt, MAX(CASE WHEN company = '1-URGENT' THEN close END)
AS close_1 FROM bars GROUP BY dt""")
_oracles["period_filter"] = with_(
    BARS, "SELECT * FROM bars WHERE dt >= DATE '2000-06-30' - 365")
_oracles["sink_roundtrip"] = with_(BARS, """SELECT company, CAST(YEAR(dt) AS INTEGER) AS year,
COUNT(*) AS days, MAX(high) AS top FROM bars GROUP BY 1, 2""")


_oracles["empty_guard"] = with_(
    BARS, "SELECT company, COUNT(*) AS days, 1 AS first, 0 AS second FROM bars GROUP BY 1")
_oracles["publish_replace"] = with_(BARS, """SELECT company, dt, open, high, low, close,
CASE WHEN company = '5-LOW' THEN 2 ELSE 1 END * volume AS volume FROM bars WHERE dt >= DATE '1998-01-01'""")


def _profile(source: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{source}' AS table_name, COUNT(*) AS row_count, CAST({len(columns)} AS BIGINT) AS column_count,
COUNT(DISTINCT company) AS distinct_keys, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing FROM {source_table}"""
        for source_table in (({"daily_sentiment": "daily"}).get(source, source),) for c in columns)


_oracles["profile_table"] = with_(f"{BARS}, {DAILY}", _profile(
    "bars", ["company", "dt", "open", "high", "low", "close", "volume"])
    + "\nUNION ALL\n" + _profile("daily_sentiment", ["company", "dt", "sentiment"]))
_oracles["profile_grown"] = with_(f"""{BARS}, rows AS (SELECT company, dt, CAST(volume AS BIGINT) AS orders,
  CASE WHEN DAY(dt) > 15 THEN MONTH(dt) END AS late FROM bars)""", "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS missing, CAST(MIN({c}) AS VARCHAR) AS low,
CAST(MAX({c}) AS VARCHAR) AS high, 1 AS distinct_close, COUNT(DISTINCT {c}) AS exact, CAST(1 AS BIGINT) AS files_read FROM rows"""
    for c in ("company", "dt", "orders", "late")))
_oracles["cached_stage"] = """SELECT o_orderpriority AS company, COUNT(*) AS orders,
COUNT(*) FILTER (o_orderdate < TIMESTAMP '1997-01-01') AS early_orders, 1 AS written_first, 2 AS written FROM orders GROUP BY 1"""
_oracles["head_rows"] = with_(BARS, "SELECT * FROM bars ORDER BY company, dt LIMIT 5")
_oracles["distinct_companies"] = "SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS company FROM lineitem"

# --- Time filters, labels, splits, scalers ----------------------------------------------------


def recent(days: int, source: str = "bars") -> str:
    return f"""recent AS (SELECT b.* FROM {source} b JOIN (SELECT company, MAX(dt) AS newest FROM {source} GROUP BY 1) n
  USING (company) WHERE b.dt >= n.newest - {days})"""


_oracles["trailing_years"] = with_(f"{BARS}, {recent(365 * 3)}", "SELECT * FROM recent")
_oracles["trailing_years_overall"] = with_(
    BARS, f"SELECT * FROM bars WHERE dt >= (SELECT MAX(dt) FROM bars) - {365 * 3}")
_oracles["timeframe_filter"] = with_(
    f"{BARS}, newest AS (SELECT company, MAX(dt) AS last FROM bars GROUP BY 1)", "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS frame, b.company, b.dt, b.close FROM bars b JOIN newest USING (company)
WHERE company IN ('2-HIGH', '5-LOW') AND b.dt >= newest.last - {100000 if days is None else days}"""
        for name, days in TIME_FRAMES.items()))
_oracles["timeframe_single"] = with_(f"{BARS}, {recent(90)}", "SELECT company, dt, close FROM recent")
_oracles["dashboard_series"] = with_(
    f"""{BARS}, {recent(365)}, {wilder('recent')}, {masked_macd('recent')},
lines AS (SELECT r.*, {strict('AVG', 'close', 20)} AS sma, COUNT(*) OVER (PARTITION BY company) AS n FROM recent r)""",
    f"""SELECT company, dt, open, high, low, close, {rnd('CASE WHEN n >= 20 THEN sma END', 4, 'SMA_20')},
{rnd('CASE WHEN n >= 20 THEN rsi END', 6, 'RSI')}, {rnd('CASE WHEN n >= 26 THEN macd END', 2, 'MACD')},
{rnd('CASE WHEN n >= 26 THEN signal END', 2, 'MACD_Signal')}
FROM lines JOIN wilder USING (company, dt) JOIN display USING (company, dt)""")
_oracles["latest_row"] = with_(
    BARS, "SELECT * FROM bars QUALIFY ROW_NUMBER() OVER (PARTITION BY company ORDER BY dt DESC) = 1")

_LABELS = f"""{BARS}, returns AS (SELECT company, dt, close, {change('close')} AS ret FROM bars),
{recent(365 * 7, 'returns')},
labelled AS (SELECT *, {lag('ret', -5)} AS future FROM recent)"""
_oracles["direction_label"] = with_(_LABELS, f"""SELECT company, dt, CAST(future > 0 AS INTEGER) AS "Target",
{rnd('ret', 6, 'Return_1')}, {rnd('future', 6, 'Future_Return')} FROM labelled WHERE future IS NOT NULL""")
_oracles["direction_label_cut"] = _oracles["direction_label"]

_TARGETS = f"""{BARS}, {recent(365 * 3)},
returned AS (SELECT *, {change('close')} AS ret FROM recent),
ahead AS (SELECT *, {lag('ret', -5)} AS future FROM returned),
targets AS (SELECT * FROM ahead WHERE ret IS NOT NULL AND future IS NOT NULL)"""
_oracles["return_targets"] = select(
    _TARGETS, [rnd("ret", 6, "Return"), rnd("future", 6, "Future_Return")], "targets")

_DORMANT = f"""logs AS (SELECT *, LN(close / {lag('close')}) AS lr, {change('close', 3)} AS m3,
  {change('volume')} AS vc FROM bars),
more AS (SELECT *, {strict('STDDEV_SAMP', 'lr', 5)} AS v5,
  CAST(COALESCE({lag('lr', -1)} > 0, FALSE) AS INTEGER) AS direction FROM logs),
dormant AS (SELECT * FROM more WHERE v5 IS NOT NULL)"""
_oracles["dormant_features"] = select(
    f"{BARS}, {_DORMANT}",
    [rnd("lr", 6, "log_return"), rnd("v5", 6, "Volatility_5"), rnd("m3", 6, "Momentum_3"),
     rnd("vc", 6, "Volume_Change"), "direction AS \"Direction\""], "dormant")

_PLACES = f"""places AS (SELECT *, ROW_NUMBER() OVER ({BY_COMPANY}) AS position,
  COUNT(*) OVER (PARTITION BY company) AS n FROM bars)"""
_oracles["chrono_split"] = with_(f"""{BARS}, {_PLACES},
cuts AS (SELECT *, CAST(FLOOR(n * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train_rows FROM places)""",
    """SELECT company, dt, position, train_rows, CAST(position <= train_rows AS INTEGER) AS is_train,
CAST(position <= train_rows AND position > FLOOR(train_rows * CAST(0.9 AS DOUBLE)) AS INTEGER) AS is_validation FROM cuts""")
_oracles["chrono_split_cut"] = with_(f"{BARS}, {_PLACES}", """SELECT company, dt, position,
CAST(position <= FLOOR(n * CAST(0.8 AS DOUBLE)) AS INTEGER) AS is_train FROM places""")
_DAY = "CAST(dt - DATE '1970-01-01' AS DOUBLE)"


def quantile(source: str) -> str:
    return f"""split AS (SELECT *, {_DAY} <= (SELECT QUANTILE_CONT({_DAY}, 0.8) FROM {source}) AS is_train FROM {source})"""


_oracles["quantile_split"] = with_(
    f"{BARS}, {quantile('bars')}", "SELECT company, dt, CAST(is_train AS INTEGER) AS is_train FROM split")


def _scaled(fit: str, low: str, width: str, by: str = "") -> list[str]:
    over = f"OVER ({by})"
    out = []
    for x in ("close", "volume"):
        seen = f"CASE WHEN {fit} THEN {x} END"
        size = width.format(x=seen, over=over)
        out.append(rnd(f"({x} - {low.format(x=seen, over=over)}) / CASE WHEN {size} = 0 THEN 1 ELSE {size} END", 6, x))
    return out


_oracles["minmax_scale"] = select(
    f"{BARS}, {_PLACES}", _scaled(
        "position <= FLOOR((n - 60) * CAST(0.8 AS DOUBLE)) + 59", "MIN({x}) {over}",
        "(MAX({x}) {over} - MIN({x}) {over})", "PARTITION BY company"), "places")
_oracles["standard_scale"] = select(
    f"{BARS}, {quantile('bars')}",
    _scaled("is_train", "AVG({x}) {over}", "(STDDEV_POP({x}) {over})"), "split")


def _sequence(n: int, partition: str, target: str) -> list[str]:
    frame = f"OVER (PARTITION BY {partition} ORDER BY dt ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return [f"COUNT(*) {frame} AS steps", f"FIRST_VALUE(close) {frame} AS oldest", f"LAST_VALUE(close) {frame} AS newest",
            f"SUM(close) {frame} AS sc", f"SUM(volume) {frame} AS sv", f"CAST({target} AS DOUBLE) AS goal"]


def _sequence_out(target_digits: int = 6) -> str:
    return ", ".join(["steps", rnd("oldest", 2, "oldest_close"), rnd("newest", 2, "newest_close"),
                      rnd("sc", 2, "sum_close"), rnd("sv", 2, "sum_volume"), rnd("goal", target_digits, "target")])


_oracles["sequences"] = with_(
    f"{_TARGETS}, seq AS (SELECT company, dt, {', '.join(_sequence(60, 'company', 'future'))} FROM targets)",
    f"SELECT company, dt, {_sequence_out()} FROM seq WHERE steps = 60")
_oracles["sequences_cut"] = _oracles["sequences"]
_oracles["sequences_pooled"] = with_(
    f"""{BARS}, {_DORMANT}, {quantile('dormant')},
parts AS (SELECT *, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM split),
seq AS (SELECT part, company, dt, {', '.join(_sequence(10, 'part, company', 'direction'))} FROM parts)""",
    f"SELECT part, company, dt, {_sequence_out()} FROM seq WHERE steps = 10")

_oracles["sequence_store_digest"] = with_(f"""{_TARGETS}, placed AS (SELECT *, ROW_NUMBER() OVER ({BY_COMPANY}) AS i FROM targets),
digests AS (SELECT t.company, t.dt, SUM((s.i - t.i + 61) * s.close) AS c, SUM((s.i - t.i + 61) * s.volume) AS v, ANY_VALUE(t.future) AS f
  FROM placed t JOIN placed s ON s.company = t.company AND s.i BETWEEN t.i - 60 AND t.i - 1 WHERE t.i > 60 GROUP BY 1, 2)""",
    f"SELECT company, dt, {rnd('c', 2, 'close_digest')}, {rnd('v', 2, 'volume_digest')}, {rnd('f', 6, 'target')} FROM digests")

_oracles["sequences_pooled_digest"] = with_(f"""{BARS}, {_DORMANT}, {quantile('dormant')},
parts AS (SELECT *, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM split),
placed AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY part, company ORDER BY dt) AS i FROM parts),
digests AS (SELECT t.part, t.company, t.dt, SUM((s.i - t.i + 11) * s.close) AS c, SUM((s.i - t.i + 11) * s.volume) AS v, ANY_VALUE(t.direction) AS f
  FROM placed t JOIN placed s ON s.part = t.part AND s.company = t.company AND s.i BETWEEN t.i - 10 AND t.i - 1 WHERE t.i > 10 GROUP BY 1, 2, 3)""",
    f"SELECT part, company, dt, {rnd('c', 2, 'close_digest')}, {rnd('v', 2, 'volume_digest')}, {rnd('CAST(f AS DOUBLE)', 6, 'target')} FROM digests")

# The bars with sentiment, returns and averages of the experiments, their first 49 rows left out.
_EXPERIMENT = f"""{SENTIMENT_BARS},
means AS (SELECT company, dt, close, sentiment, {strict('AVG', 'close', 10)} AS m10, {strict('AVG', 'close', 20)} AS m20,
  {change('close')} AS ret_1, ROW_NUMBER() OVER ({BY_COMPANY}) AS row FROM bars),
complete AS (SELECT * FROM means WHERE row >= 50), {recent(365 * 7, 'complete')}"""
_SETS = {"Return Sequence (No Sentiment)": 3, "Return Sequence + Sentiment": 4}


def _sequence_sql(lookback: int) -> str:
    """Sequences of scaled features as long rows: goal of row i, and input k (0 is the intercept) with its value."""
    values = ", ".join(f"({k}, {x})" for k, x in enumerate(("ret", "m10", "m20", "sentiment")))
    return f"""{_EXPERIMENT},
returned AS (SELECT company, dt, m10, m20, sentiment, {change('close')} AS ret FROM recent),
ahead AS (SELECT *, {lag('ret', -5)} AS future FROM returned),
targets AS (SELECT *, ROW_NUMBER() OVER ({BY_COMPANY}) AS i, COUNT(*) OVER (PARTITION BY company) AS n
  FROM ahead WHERE ret IS NOT NULL AND future IS NOT NULL),
cuts AS (SELECT *, CAST(FLOOR((n - {lookback}) * CAST(0.8 AS DOUBLE)) AS BIGINT) AS train FROM targets),
long AS (SELECT company, i, train, f, x FROM cuts, LATERAL (VALUES {values}) AS v(f, x)),
edges AS (SELECT company, f, MIN(x) AS low, MAX(x) - MIN(x) AS width FROM long WHERE i <= train + {lookback - 1} GROUP BY 1, 2),
scaled AS (SELECT company, i, f, (x - low) / CASE WHEN width = 0 THEN 1 ELSE width END AS x FROM long JOIN edges USING (company, f)),
goals AS (SELECT company, dt, i, future, i <= {lookback} + train AS is_train FROM cuts WHERE i > {lookback})"""


def _solved_sql(lookback: int) -> str:
    """Normal equations and their elimination, one table per input: weights(company, model, place, weight)."""
    parts = []
    for m, (model, width) in enumerate(_SETS.items()):
        size = lookback * width + 1
        parts.append(f"""inputs{m} AS MATERIALIZED (
  SELECT g.company, g.i, g.is_train, g.future, (g.i - s.i - 1) * {width} + s.f + 1 AS k, s.x
  FROM goals g JOIN scaled s ON s.company = g.company AND s.i BETWEEN g.i - {lookback} AND g.i - 1 AND s.f < {width}
  UNION ALL SELECT company, i, is_train, future, 0, 1 FROM goals),
g{m}_0 AS MATERIALIZED (
  SELECT a.company, a.k AS r, b.k AS c, SUM(a.x * b.x) + CASE WHEN a.k = b.k AND a.k > 0 THEN 1 ELSE 0 END AS v
  FROM inputs{m} a JOIN inputs{m} b ON a.company = b.company AND a.i = b.i WHERE a.is_train GROUP BY 1, 2, 3
  UNION ALL SELECT company, k, {size}, SUM(x * future) FROM inputs{m} WHERE is_train GROUP BY 1, 2)""")
        for k in range(size):
            parts.append(f"""g{m}_{k + 1} AS MATERIALIZED (
  SELECT m.company, m.r, m.c, CASE WHEN m.r = {k} THEN m.v / p.v ELSE m.v - f.v * l.v / p.v END AS v
  FROM g{m}_{k} m JOIN g{m}_{k} p ON p.company = m.company AND p.r = {k} AND p.c = {k}
  JOIN g{m}_{k} l ON l.company = m.company AND l.r = {k} AND l.c = m.c
  JOIN g{m}_{k} f ON f.company = m.company AND f.r = m.r AND f.c = {k})""")
        parts.append(f"w{m} AS (SELECT company, '{model}' AS model, r AS place, v AS weight FROM g{m}_{size} WHERE c = {size})")
    return ",\n".join(parts)


_SHORT = f"{_sequence_sql(5)},\n{_solved_sql(5)}"
_oracles["sequence_ridge"] = with_(_SHORT, f"""SELECT company, model, CAST(place AS BIGINT) AS place, {rnd('weight', 6, 'weight')}
FROM (SELECT * FROM w0 UNION ALL SELECT * FROM w1)""")
_oracles["sequence_results_short"] = with_(f"""{_SHORT}, guesses AS (""" + " UNION ALL ".join(
    f"""SELECT i.company, '{model}' AS model, i.i, ANY_VALUE(future) AS y_true, SUM(x * weight) AS y_pred
  FROM inputs{m} i JOIN w{m} ON w{m}.company = i.company AND place = k WHERE NOT is_train GROUP BY 1, 2, 3"""
    for m, model in enumerate(_SETS)) + ")", f"""SELECT company AS "Company", model AS "Model",
{rnd('AVG(CAST(SIGN(y_true) = SIGN(y_pred) AS DOUBLE)) * 100', 2, 'DA (%)')}, {rnd('AVG(ABS(y_true - y_pred))', 6, 'MAE')},
{rnd('SQRT(AVG((y_true - y_pred) * (y_true - y_pred)))', 6, 'RMSE')} FROM guesses GROUP BY 1, 2""")
_oracles["sequence_ridge_optimality"] = with_(_sequence_sql(60), """SELECT company, model, COUNT(*) FILTER (is_train) AS train_sequences,
COUNT(*) FILTER (NOT is_train) AS test_sequences, 1 AS optimal
FROM goals CROSS JOIN (VALUES ('Return Sequence (No Sentiment)'), ('Return Sequence + Sentiment')) AS m(model) GROUP BY 1, 2""")

# --- Measures ---------------------------------------------------------------------------------

PREDICTIONS = f"""{BARS},
base AS (SELECT company, dt, (close - open) / open AS y_true, (high - close) / high AS gap FROM bars),
kinds(model, slope) AS (VALUES ('No Sentiment', CAST(0.5 AS DOUBLE)), ('Sentiment', CAST(0.8 AS DOUBLE))),
predictions AS (
  SELECT company, model, dt, y_true, y_true * slope - gap * CAST(0.25 AS DOUBLE) AS y_pred,
         CAST(y_true > 0 AS INTEGER) AS label, FLOOR((1 - gap * slope) * 50) / CAST(50 AS DOUBLE) AS prob
  FROM base CROSS JOIN kinds)"""
_DA = "AVG(CAST(SIGN(y_true) = SIGN(y_pred) AS DOUBLE)) * 100"
_MAE, _RMSE = "AVG(ABS(y_true - y_pred))", "SQRT(AVG((y_true - y_pred) * (y_true - y_pred)))"
_oracles["regression_metrics"] = with_(PREDICTIONS, f"""SELECT company, model, {rnd(_DA, 6, 'directional_accuracy')},
{rnd(_MAE, 6, 'mae')}, {rnd(_RMSE, 6, 'rmse')},
{rnd('AVG(CASE WHEN y_true <> 0 THEN ABS((y_true - y_pred) / y_true) END) * 100', 4, 'mape')}
FROM predictions GROUP BY 1, 2""")
_oracles["experiment_table"] = with_(PREDICTIONS, f"""SELECT company AS "Company", model AS "Model",
{rnd(_DA, 2, 'DA (%)')}, {rnd(_MAE, 6, 'MAE')}, {rnd(_RMSE, 6, 'RMSE')} FROM predictions GROUP BY 1, 2""")


def _classes(source: str, by: str) -> str:
    """Measures from average ranks: the rank sum form of the area under the curve."""
    group, keys = (f"GROUP BY {by}", f"{by}, ") if by else ("", "")
    part = f"PARTITION BY {by} " if by else ""
    return with_(f"""{PREDICTIONS}, chosen AS (SELECT * FROM {source}),
ranked AS (SELECT *, RANK() OVER ({part}ORDER BY prob)
  + (COUNT(*) OVER (PARTITION BY {keys}prob) - 1) / CAST(2 AS DOUBLE) AS r FROM chosen),
counts AS (SELECT {keys}
  CAST(COUNT(*) FILTER (label = 1 AND prob > 0.5) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (label = 0 AND prob > 0.5) AS DOUBLE) AS fp,
  CAST(COUNT(*) FILTER (label = 1 AND prob <= 0.5) AS DOUBLE) AS fn, CAST(COUNT(*) FILTER (label = 0 AND prob <= 0.5) AS DOUBLE) AS tn,
  SUM(CASE WHEN label = 1 THEN r END) AS rs FROM ranked {group})""",
        f"""SELECT {keys}{rnd('(tp + tn) / (tp + fp + fn + tn) * 100', 6, 'accuracy')},
{rnd('(rs - (tp + fn) * (tp + fn + 1) / 2) / NULLIF((tp + fn) * (fp + tn), 0)', 6, 'roc_auc')},
{rnd('COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0)', 6, 'f1')},
{rnd('COALESCE((tp * tn - fp * fn) / NULLIF(SQRT((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)', 6, 'mcc')}
FROM counts""")


_oracles["classification_metrics"] = _classes("predictions", "company, model")
_oracles["classification_metrics_pooled"] = _classes("predictions WHERE model = 'Sentiment'", "")

_FEATURES = {"RSI": "rsi", "Return_5": "r5", "BB_Pos": "pos", "BB_Width": "width", "MA_20": "mid", "Volume_Ratio": "vr"}
_IMPORTANCE = f"""{BARS}, {_MOVES}, {_BANDS.format(source='moves')}, {_MEANS.format(source='bands')},
prepared AS (SELECT company, dt, ret, mid, m50,
  100 - 100 / (1 + ({strict('AVG', 'gain', 14)}) / (({strict('AVG', 'loss', 14)}) + {EPS})) AS rsi,
  {change('close', 5)} AS r5, (close - (mid - 2 * sd)) / (4 * sd + {EPS}) AS pos, 4 * sd / (mid + {EPS}) AS width,
  volume / (({strict('AVG', 'volume', 10)}) + {EPS}) AS vr FROM means),
usable AS (SELECT * FROM prepared WHERE m50 IS NOT NULL),
future AS (SELECT *, {lag('ret', -5)} AS f FROM usable),
labelled AS (SELECT *, CAST(f > 0 AS INTEGER) AS target FROM future WHERE f IS NOT NULL),
per_class AS ({' UNION ALL '.join(
    f"SELECT '{name}' AS feature, target, COUNT({x}) AS n, AVG({x}) AS mean, VAR_POP({x}) AS v FROM labelled GROUP BY target"
    for name, x in _FEATURES.items())}),
centred AS (SELECT *, SUM(n * mean) OVER (PARTITION BY feature) / SUM(n) OVER (PARTITION BY feature) AS grand FROM per_class),
scores AS (SELECT feature, (SUM(n * (mean - grand) * (mean - grand)) / (COUNT(*) - 1))
  / (SUM(n * v) / (SUM(n) - COUNT(*))) AS score FROM centred GROUP BY feature)"""
_oracles["feature_importance"] = with_(_IMPORTANCE, f"""SELECT feature, {rnd('score', 4, 'score')},
CAST(ROW_NUMBER() OVER (ORDER BY score DESC, feature) <= 3 AS INTEGER) AS selected FROM scores""")

_oracles["importance_file"] = _oracles["feature_importance"]

_oracles["score_latest_rows"] = with_(BARS, "SELECT company, MAX(dt) AS dt, 1 AS scored FROM bars GROUP BY company")

_oracles["saved_model_scores"] = with_(f"""{BARS},
returned AS (SELECT company, dt, {change('close')} AS ret, ROW_NUMBER() OVER ({BY_COMPANY}) AS i FROM bars),
ahead AS (SELECT company, i, LEAD(ret) OVER ({BY_COMPANY}) AS future FROM returned)""", """SELECT company, COUNT(*) AS rows,
COUNT(*) FILTER (future > 0) AS rises, COUNT(*) AS same, COUNT(*) AS told FROM ahead WHERE i >= 50 AND future IS NOT NULL GROUP BY 1""")
_oracles["sequence_classifier_rows"] = with_(
    f"""{BARS.replace('bars AS', 'every_bar AS', 1)},
bars AS (SELECT * FROM every_bar WHERE dt >= (SELECT MAX(dt) FROM every_bar) - {365 * 7}), {_DORMANT}, {quantile('dormant')},
held AS (SELECT *, ROW_NUMBER() OVER ({BY_COMPANY}) AS i FROM split WHERE NOT is_train)""", """SELECT company, COUNT(*) AS test_sequences,
SUM(direction)::BIGINT AS rises, MAX(dt) AS newest, COUNT(*) AS scored FROM held WHERE i > 10 GROUP BY 1""")

_oracles["logistic_optimality"] = with_(f"""{BARS},
returned AS (SELECT company, dt, close / {lag('close')} - 1 AS ret FROM bars),
kept AS (SELECT * FROM returned WHERE ret IS NOT NULL),
ahead AS (SELECT company, dt, LEAD(ret, 5) OVER (PARTITION BY company ORDER BY dt) AS future FROM kept),
placed AS (SELECT company, future, ROW_NUMBER() OVER (PARTITION BY company ORDER BY dt) AS position,
           COUNT(*) OVER (PARTITION BY company) AS n FROM ahead WHERE future IS NOT NULL)""",
    """SELECT company, COUNT(*) AS train_rows, SUM(CASE WHEN future > 0 THEN 1 ELSE 0 END)::BIGINT AS rises, 1 AS optimal
FROM placed WHERE position <= FLOOR(n * CAST(0.8 AS DOUBLE)) GROUP BY company""")


_oracles["logistic_grid_optimality"] = with_(
    "one AS (" + _oracles["logistic_optimality"] + ")",
    "SELECT one.*, model, CAST(0 AS BIGINT) AS stray_weights FROM one CROSS JOIN (VALUES ('one'), ('two'), ('three'), ('none')) AS m(model)")
_oracles["logistic_results_rows"] = with_(f"""{_EXPERIMENT},
labelled AS (SELECT company, dt, {lag('ret_1', -5)} AS future FROM recent),
spots AS (SELECT company, future, ROW_NUMBER() OVER ({BY_COMPANY}) AS i, COUNT(*) OVER (PARTITION BY company) AS n
  FROM labelled WHERE future IS NOT NULL)""", """SELECT company, model, COUNT(*) AS test_rows,
COUNT(*) FILTER (future > 0) AS rises, COUNT(*) AS scored, COUNT(*) AS told
FROM spots CROSS JOIN (VALUES ('Logistic (No Sentiment)'), ('Logistic + Sentiment')) AS m(model)
WHERE i > FLOOR(n * CAST(0.8 AS DOUBLE)) GROUP BY 1, 2""")


def all_oracles() -> dict[str, str]:
    return dict(_oracles)
