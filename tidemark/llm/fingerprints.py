"""Merkle trees of documents: sections of paragraphs of phrases, as Column expressions.

A paragraph's node is the digest of its text, a section's node the digest of its paragraphs' nodes,
and the root the digest of the sections' nodes: equal roots mean equal texts, and a branch that
differs shows where. Below the paragraphs lie phrases, cut at punctuation and after words with
common endings, so the cuts move with the text and an insertion changes the phrases around it only;
the likeness of two documents is the share of phrases they have in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SECTION, PARAGRAPH = "\n\n", "\n"
# A phrase ends behind punctuation, or behind a space after one of these letters.
PHRASE = r"(?s).*?(?:[\n.,;:!?|]|[aeionst] )|.+"


def tree(text: Column) -> Column:
    """ARRAY<ARRAY<STRING>>: the paragraph nodes of each section; a null text is an empty one."""
    sections = F.split(F.coalesce(text, F.lit("")), SECTION)
    return F.transform(sections, lambda s: F.transform(F.split(s, PARAGRAPH), F.md5))


def root(nodes: Column) -> Column:
    """The root of a tree, as hexadecimal digits."""
    return F.sha2(F.array_join(F.transform(nodes, lambda s: F.md5(F.array_join(s, ""))), ""), 256)


def first_difference(a: Column, b: Column) -> Column:
    """Number, from 0 over the whole document, of the first paragraph that differs; null between equal trees."""
    equal = F.zip_with(F.flatten(a), F.flatten(b), lambda x, y: F.coalesce(x == y, F.lit(False)))
    found = F.array_position(equal, F.lit(False))
    # Same paragraphs, cut into sections at other places: the first section's end that differs.
    sections = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(found > 0, found - 1).when(sections > 0, F.aggregate(
        F.slice(a, 1, sections.cast("int")), F.lit(0).cast("long"), lambda n, s: n + F.size(s)) - 1)


def phrases(text: Column) -> Column:
    """The distinct phrases of a text, as 64-bit hashes; a null or empty text has none."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PHRASE), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def likeness(a: Column, b: Column) -> Column:
    """Shared phrases over those of the document that has more; two without any are alike."""
    most = F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / most)


def with_next(docs: DataFrame, key: str, text: str, rows_per_range: int = 4096, most_ranges: int = 65_536) -> DataFrame:
    """id, text, next_text and the range they were dealt to: each row with the text of the row that follows.

    Rows are ordered by key (null first), then text, and the first follows the last. They are dealt
    into ranges of keys; the row that begins a range is also sent, as a guest, to the range before.
    """
    read = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    place = F.coalesce("id", F.lit(-(2**63)))
    rows = docs.select(F.col(key)).count()
    ranges = min(most_ranges, rows // rows_per_range + 1)
    shares = [i / ranges for i in range(1, ranges)]
    bounds = sorted(set(read.agg(F.percentile_approx(place, shares, 10 * ranges)).first()[0] or [])) if shares else []

    # Number of bounds at or below the key, by bisection.
    steps = [2**k for k in reversed(range(len(bounds).bit_length()))]
    at = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>")
    number = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda n, step: n + F.when(
        F.get(at, n + step - 1) <= place, step).otherwise(0)) if bounds else F.lit(0)
    dealt = read.withColumn("range", number)
    starts = {r["range"]: r["start"] for r in
              read.select(number.alias("range"), place.alias("place")).groupBy("range").agg(F.min("place").alias("start")).collect()}
    before = dict(zip(sorted(starts), [max(starts, default=0), *sorted(starts)]))
    # One entry for each range: where it begins, and the range before it.
    begins = F.array(*(F.lit(starts.get(i)).cast("long") for i in range(len(bounds) + 1)))
    back = F.array(*(F.lit(before.get(i)).cast("int") for i in range(len(bounds) + 1)))
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(back, F.col("range")).alias("range"), F.lit(True).alias("guest"))
    seats = F.when(F.get(begins, F.col("range")) == place, F.array(own, guest)).otherwise(F.array(own))
    seated = dealt.select("id", "text", F.explode(seats).alias("seat")).select("id", "text", "seat.range", "seat.guest")
    return seated.withColumn("next_text", F.lead("text").over(in_order()))


def in_order():
    return Window.partitionBy("range").orderBy("guest", F.asc_nulls_first("id"), "text")


def compared_with_edit(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's fingerprint beside those of its edited text and of the next document.

    Returns id, n_chars, edited (the text whose last quarter is replaced by the head of the next
    document), fingerprint, edited_fingerprint, near_edited, near_next and edited_paragraph (the
    first that differs, null if none). Null texts count as empty; an only document follows itself;
    repeated rows stand beside each other in the order. Other columns are not read.
    """
    rows = with_next(docs, key, text).withColumn("phrases", phrases(F.col("text")))
    rows = rows.withColumn("next_phrases", F.lead("phrases").over(in_order())).where("NOT guest")
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("id", "text", "phrases", "next_phrases", edited.alias("edited"))
    rows = rows.select("*", tree(F.col("text")).alias("tree"), tree(F.col("edited")).alias("edited_tree"),
                       phrases(F.col("edited")).alias("edited_phrases"))
    return rows.select(
        "id", F.char_length("text").cast("long").alias("n_chars"), "edited", root(F.col("tree")).alias("fingerprint"),
        root(F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("phrases"), F.col("edited_phrases")).alias("near_edited"),
        likeness(F.col("phrases"), F.col("next_phrases")).alias("near_next"),
        first_difference(F.col("tree"), F.col("edited_tree")).alias("edited_paragraph"))
