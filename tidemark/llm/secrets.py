"""Secrets in texts: fixed patterns, and tokens that a battery of tests finds random.

Everything is a Column expression over the text. A candidate token's encoding is inferred from its
characters; chi-squared uniformity over the alphabet and serial correlation say whether it could be
random, and a test on the runs of character classes says how far it is from written text. The last
is a p-value for each candidate, smaller the longer a token is; the false-discovery rate over all
candidates of the corpus is held by the step-up rule on counts of these p-values.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log, log10, pi, sqrt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.staging import stored

# The base patterns (kind, pattern, group whose length counts, least length). Runs of
# hexadecimal digits or behind AKIA are matched whole or not at all, so their least length can stand
# in the pattern; a short assignment uses up its text and can't.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
RANDOM = "random"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# Tokens of one class, but for a capital at the head, are words: no test tells them from text.
ONE_CLASS = r"^(?:[A-Za-z]?[a-z]+|[A-Z]+|[0-9]+|[+/_-]+)=*$"

# Alphabets in value order: characters, by encoding.
ALPHABETS = (
    ("decimal", "0123456789", r"^[0-9]+$"),
    ("hex", "0123456789abcdef", r"^(?:[0-9a-f]+|[0-9A-F]+)$"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", r"^[A-Z2-7]+=*$"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", r"^[A-Za-z0-9+/_=-]+$"),
)
# A random token fails one of the two uniformity tests with this probability.
ALPHA = 1e-4
# Share of neighbouring characters of unlike class (letters of either case, digits, signs) in written
# names. A capital before a small letter is no change: it is how a name's word begins.
TEXT_CHANGES = 0.15
FALSE_DISCOVERIES = 0.001
# The p-values are counted in steps of this many powers of ten, down to the last step.
STEP, LAST = 0.01, 400.0


def _with(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build`` of a value that is computed once, however often ``build`` names it."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def _spans(text: Column, pattern: str, group: int) -> Column:
    """ARRAY<STRUCT<start, stop, size, word>> of all matches: code points, and the group's length."""
    words = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = words if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<start:int,stop:int,size:int,word:string>>")

    def more(done: Column, row: Column) -> Column:
        start = done["at"] + F.char_length(row["gap"])
        stop = start + F.char_length(row["word"])
        span = F.struct(start.alias("start"), stop.alias("stop"), F.char_length(row["part"]).alias("size"),
                        row["word"].alias("word"))
        return F.struct(stop.alias("at"), F.concat(done["found"], F.array(span)).alias("found"))

    # What stands behind the last match has no word; it is cut off.
    rows = F.filter(F.arrays_zip(gaps.alias("gap"), words.alias("word"), parts.alias("part")), lambda r: r["word"].isNotNull())
    found = F.aggregate(rows, F.struct(F.lit(0).alias("at"), none.alias("found")), more, lambda done: done["found"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _bins(word: Column, alphabet: str, bins: int) -> Column:
    """The value of each character in its alphabet, cut to ``bins`` equal classes; signs of the URL form count as theirs."""
    plain = F.translate(F.rtrim(word, F.lit("=")), "-_", "+/")
    if alphabet == ALPHABETS[1][1]:
        plain = F.lower(plain)
    return F.transform(F.split(plain, ""), lambda c: F.floor(
        (F.instr(F.lit(alphabet), c) - 1) * bins / len(alphabet)).cast("int"))


def _could_be_random(values: Column, bins: int) -> Column:
    """Whether uniformity over the bins and independence of neighbours both stand."""
    n = F.size(values)
    counts = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)),
                         lambda b: F.size(F.filter(values, lambda v: v == b)))
    square = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c * c) * bins / n - n
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is nearly normal.
    free = bins - 1
    uniform = (F.pow(square / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / sqrt(2 / (9 * free))
    mean, spread = (bins - 1) / 2, (bins * bins - 1) / 12
    products = F.zip_with(F.slice(values, F.lit(1), n - 1), F.slice(values, F.lit(2), n - 1),
                          lambda a, b: (a - mean) * (b - mean))
    serial = F.abs(F.aggregate(products, F.lit(0.0), lambda s, x: s + x)) / (spread * F.sqrt(n - 1))
    limit = _quantile(ALPHA)
    return (uniform < limit) & (serial < limit)


def _quantile(p: float) -> float:
    """The normal deviate above which lies ``p``, by bisection of the tail bound below."""
    low, high = 1.0, 40.0
    for _ in range(60):
        z = (low + high) / 2
        low, high = (z, high) if exponent(z) < -log10(p) else (low, z)
    return low


def exponent(z: float) -> float:
    """-log10 of the normal tail above ``z`` > 1, by its upper bound exp(-z^2 / 2) / (z sqrt(2 pi))."""
    return (z * z / 2 + log(z * sqrt(2 * pi))) / log(10)


def weight(word: Column) -> Column:
    """-log10 of the probability that written text changes class as often; 0 if the token can't be random."""
    tests = None
    for _, alphabet, pattern in ALPHABETS:
        bins = 5 if len(alphabet) == 10 else 8
        test = _with(_bins(word, alphabet, bins), lambda values: _could_be_random(values, bins))  # noqa: B023
        tests = F.when(word.rlike(pattern), test) if tests is None else tests.when(word.rlike(pattern), test)
    classes = F.split(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        F.rtrim(word, F.lit("=")), "[A-Z]", "U"), "[a-z]", "l"), "[0-9]", "9"), "")

    def deviate(classes: Column) -> Column:
        n = F.size(classes) - 1
        changes = F.aggregate(F.zip_with(F.slice(classes, F.lit(1), n), F.slice(classes, F.lit(2), n),
                                         lambda a, b: (
            (a != b) & ~((a == "U") & (b == "l"))).cast("int")), F.lit(0), lambda s, x: s + x)
        return (changes - n * TEXT_CHANGES) / F.sqrt(n * (TEXT_CHANGES * (1 - TEXT_CHANGES)))

    def tail(z: Column) -> Column:
        found = (z * z / 2 + F.log(z * sqrt(2 * pi))) / log(10)
        return F.when(z <= 1, 0.0).when(F.coalesce(tests, F.lit(False)), F.least(found, F.lit(LAST))).otherwise(0.0)

    return _with(_with(classes, deviate), tail)


def _threshold(weights: DataFrame) -> float:
    """The least weight that holds the false-discovery rate over all candidates; none reaches infinity."""
    # At most LAST / STEP + 1 rows, whatever the corpus.
    counts = sorted(((r["step"], r["n"]) for r in weights.groupBy(
        F.floor(F.col("weight") / STEP).cast("int").alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    total, above, found = sum(n for _, n in counts), 0, float("inf")
    for step, n in counts:
        above += n
        if step > 0 and 10 ** (-step * STEP) <= FALSE_DISCOVERIES * above / total:
            found = step * STEP
    return found


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, base and spans, both ARRAY<STRUCT<start, rank, stop, kind>> by start: one row per row of ``docs``.

    ``base`` holds the matches of the fixed patterns; ``spans`` adds the random tokens that overlap
    none of them. Positions are code points, the end exclusive. A null or empty text has none.
    Repeated rows each give their own row, and count as often among the candidates. Other columns
    are not read.
    """
    read = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kinds = [kind for kind, *_ in BASE] + [RANDOM]

    def labelled(spans: Column, kind: str) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(kinds.index(kind)).alias("rank"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))

    def long_enough(pattern: str, group: int, least: int) -> Column:
        return F.filter(_spans(F.col("text"), pattern, group), lambda s: s["size"] >= least)

    found = read.select("id", *(long_enough(pattern, group, least).alias(kind) for kind, pattern, group, least in BASE),
                        F.filter(_spans(F.col("text"), CANDIDATE, 0), lambda s: ~s["word"].rlike(ONE_CLASS)).alias("candidates"))
    base = F.array_sort(F.concat(*(labelled(F.col(kind), kind) for kind, *_ in BASE)))
    found = found.select("id", base.alias("base"), "candidates")
    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    tested = F.transform(free, lambda c: F.struct(
        c["start"].alias("start"), c["stop"].alias("stop"), weight(c["word"]).alias("weight")))
    found = stored(found.select("id", "base", tested.alias("tested")), "spans")
    least = _threshold(found.select(F.explode("tested.weight").alias("weight")))
    random = labelled(F.filter("tested", lambda c: c["weight"] >= least), RANDOM)
    return found.select("id", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
