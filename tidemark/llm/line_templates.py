"""Lines that recur across documents, by a tree of templates of fixed depth.

A line's tokens that hold digits are variable fields. The tree branches by the number of tokens,
then by the leading tokens. In a leaf the commonest token of every further position makes up the
leaf's template: a line that agrees with it in at least half of them belongs to it, whatever its
other tokens are, and any other line is a template of its own. A template that enough documents
hold is dropped from them all. A document made up of such lines for the most part is a copy rather
than a page with boilerplate; it is left whole, for near-duplicate search to judge.

Only DataFrame operations are used, and every grouping is a count or a minimum that is combined
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.plans.staging import broadcast_if_small, shuffled, stored

# Leading tokens that the tree branches by, and documents that make a template recurring.
DEPTH, MIN_DOCS = 3, 5
FIELD = "<*>"
# What separates tokens, and a token with a digit in it.
BLANK = " \t\r\x0b\f"
BLANKS, UNEVEN = r"[ \t\r\x0b\f]+", r"[\t\r\x0b\f]|  "
VARIABLE = r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*"


def masked(line: Column) -> Column:
    """The line's tokens with one space between them, variable fields as ``<*>``; empty if blank."""
    plain = F.trim(F.when(line.rlike(UNEVEN), F.regexp_replace(line, BLANKS, " ")).otherwise(line))
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, VARIABLE, FIELD)).otherwise(plain)


def leaf(line: Column) -> Column:
    """The tree's leaf of a masked line: its number of tokens and its leading tokens."""
    return F.xxhash64(F.size(F.split(line, " ")), F.substring_index(line, " ", DEPTH))


def _lines(docs: DataFrame) -> DataFrame:
    """row, place, masked and leaf of every line that is not blank, from columns row and text."""
    lines = docs.select("row", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    shown = lines.select("row", "place", masked(F.col("line")).alias("masked")).where("masked != ''")
    return shown.withColumn("leaf", leaf(F.col("masked")))


def _belonging(varied: DataFrame) -> DataFrame:
    """line (hash), leaf for those distinct masked lines that belong to their leaf's template."""
    tokens = F.slice(F.split("masked", " "), DEPTH + 1, F.size(F.split("masked", " ")))
    rest = varied.select("leaf", "masked", tokens.alias("tokens")).where(F.size("tokens") > 1)
    each = rest.select("leaf", F.posexplode("tokens").alias("at", "token"))
    counts = each.groupBy("leaf", "at", "token").agg(F.count(F.lit(1)).alias("n"))
    # The commonest token of a position, of equal ones the first in order.
    common = counts.groupBy("leaf", "at").agg(F.min(F.struct(-F.col("n"), F.col("token").alias("token"))).alias("top"))
    shape = common.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("at", "top.token")))["token"].alias("shape"))
    agreed = F.aggregate(F.zip_with("tokens", "shape", lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)
    return shuffled(rest).join(shape, "leaf").where(2 * agreed >= F.size("tokens")).select(
        F.xxhash64("masked").alias("line"), F.lit(True).alias("belongs"))


def drop_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``, and n_lines, n_dropped, left_whole.

    Lines end at line feeds; blank ones are kept and never counted, and they are no part of n_lines.
    A document counts once for a template, repeated rows together count once. A null text stays
    null, an empty one empty. Where recurring lines hold more than half of the characters of
    all lines, the text stays as it is and left_whole is true. Columns of the three names are
    replaced; all others are carried along. Every row gives one row.
    """
    # A row is known by key and text, so that repeated rows share what is found for them.
    row = F.xxhash64(F.col(key), F.col(text)).alias("row")
    read = docs.where(F.col(text).isNotNull()).select(row, F.col(text).alias("text"))
    lines = stored(_lines(read).select("row", "place", "leaf", F.xxhash64("masked").alias("line")), "lines")
    # A template lies in one leaf, so only leaves of enough documents can hold a recurring one.
    full = stored(lines.select("leaf", "row").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("docs")).where(
        F.col("docs") >= min_docs).select("leaf"), "leaves")
    near = stored(shuffled(lines).join(broadcast_if_small(full), "leaf"), "near")
    several = near.groupBy("leaf").agg(F.min("line").alias("low"), F.max("line").alias("high")).where("low != high")
    several = stored(several.select("leaf"), "several")
    varied = shuffled(_lines(read)).join(broadcast_if_small(several), "leaf").select("leaf", "masked").distinct()
    belonging = stored(_belonging(stored(varied, "varied")), "belonging")
    template = F.when(F.col("belongs"), F.xxhash64(F.lit("leaf"), "leaf")).otherwise(F.xxhash64(F.lit("line"), "line"))
    placed = shuffled(near).join(broadcast_if_small(belonging), "line", "left").select("row", "place", template.alias("template"))
    recurring = placed.distinct().select("template", "row").distinct().groupBy("template").agg(
        F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs).select("template")
    drops = placed.join(recurring, "template").groupBy(F.col("row").alias("of")).agg(F.collect_set("place").alias("drops"))

    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "left_whole")]
    joined = docs.select(F.struct(*names).alias("kept"), row).join(drops, F.col("row") == F.col("of"), "left")
    whole = F.col("kept").getField(text)
    none = F.array().cast("array<int>")
    parts = joined.select("kept", F.split(whole, "\n").alias("cut"), F.coalesce("drops", none).alias("drops"))
    total = F.char_length(whole) - F.size("cut") + 1
    dropped = F.aggregate("drops", F.lit(0), lambda s, i: s + F.char_length(F.get("cut", i)))
    parts = parts.withColumn("left_whole", F.coalesce(2 * dropped > total, F.lit(False)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("cut") - 1), "drops")
    shorter = F.array_join(F.transform(stay, lambda i: F.get("cut", i)), "\n")
    result = F.when(F.col("left_whole") | (F.size("drops") == 0), whole).otherwise(shorter)
    shown = F.filter("cut", lambda line: F.trim(line, F.lit(BLANK)) != "")
    return parts.select(
        *((result if c == text else F.col("kept").getField(c)).alias(c) for c in names),
        F.when(whole.isNull(), 0).otherwise(F.size(shown)).alias("n_lines"),
        F.when(F.col("left_whole"), 0).otherwise(F.size("drops")).alias("n_dropped"), "left_whole")
