"""Documents to training tokens in five stages, each written and read again by the next.

A stage returns the columns it was given, whatever their names are. Repeated rows and rows without id are
documents like any other until near_dedup, which keeps one row of each id and text; ties go to the smaller
id, then to a hash of the row. An empty table passes through every stage. Texts are read whole, however
long they are. What each stage makes of null and empty texts stands in its docstring.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, langid, line_templates, minhash, mixing
from tidemark.plans.staging import broadcast_if_small, shuffled, stored


# What tells rows apart: the id and the text, as one number.
ROW = "xxhash64(doc_id, doc_id IS NULL, text, text IS NULL)"


# The columns that stages look at.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def names_apart(stage: Stage) -> Stage:
    """The stage with all other columns under names that nothing inside it uses; they come back under their own."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        plain = docs.toDF(*(name if name in COLUMNS else f"other column {at}" for at, name in enumerate(docs.columns)))
        return stage(spark, plain, sf_dir).toDF(*docs.columns)

    return run_stage


@names_apart
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is told with confidence and that are not for the most part new to the model.

    Null, empty and blank texts and others without letters go.
    """
    found = langid.predict(docs, langid.fit(docs))
    return found.where("NOT rejected").select(*docs.columns)


@names_apart
def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that recur across them; ``n_chars`` follows the text. Null texts stay null, empty ones empty."""
    found = line_templates.drop_recurring(docs)
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


@names_apart
def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, and one row of repeated ones.

    It is decided per distinct id and text: an id's other texts stay, and copies without id are copies
    too. The smallest id of a group stays; one without id only if none of the group has one.
    """
    rows = docs.withColumn("row", F.expr(ROW))
    found = minhash.near_duplicates(rows, key="row").select(F.col("id").alias("row"), F.col("component_id").alias("component")).distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row"))["row"].alias("row")
    kept = found.join(rows.select("row", "doc_id").distinct(), "row").groupBy("component").agg(first)
    left = shuffled(rows).join(broadcast_if_small(stored(kept.select("row"), "kept")), "row", "left_semi")
    several = left.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = broadcast_if_small(stored(several.select("row"), "several"))
    once = shuffled(left).join(several, "row", "left_anti").select(*docs.columns)
    return once.unionByName(shuffled(left).join(several, "row", "left_semi").dropDuplicates(["row"]).select(*docs.columns))


def _places(docs: DataFrame) -> DataFrame:
    """row, doc_id, mix_slot and mix_place of every row: one schedule, whichever stage asks for it."""
    return mixing.mix(docs.select(F.expr(ROW).alias("row"), "doc_id", "source"), key="row").select("row", "doc_id", "mix_slot", "mix_place")


@names_apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that follow the mix of their sources; a null source is a source of its own."""
    mixed = mixing.mix(docs.withColumn("row", F.expr(ROW)), key="row")
    return mixed.repartitionByRange("mix_slot", "mix_place").sortWithinPartitions("mix_slot", "mix_place").select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 (the digest of the text decoded from the ids again), mix_slot and mix_place.

    Encoding deals rows anew, so their places in the mix are found again from its schedule:
    the training order is that of (mix_slot, mix_place), whatever files the rows lie in. A null or empty
    text has no ids and decodes to the empty text.
    """
    places = stored(_places(docs), "places")
    rows = docs.withColumn("row", F.expr(ROW))
    if not places.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        # Repeated rows are encoded once and stand at each of their places.
        rows = stored(rows.dropDuplicates(["row"]), "rows")
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(rows, ranks, public_tokenizers.PATTERN, key="row"), ranks)
    encoded = decoded.select(F.col("id").alias("row"), F.size("ids").cast("long").alias("n_tokens"), "ids",
                             F.sha2("decoded", 256).alias("decoded_sha256"))
    return broadcast_if_small(places).join(shuffled(encoded), "row").select("doc_id", "n_tokens", "ids", "decoded_sha256", "mix_slot", "mix_place")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_recurring_lines),
    ("near_dedup", keep_one_of_near_duplicates),
    ("mix", mix_sources),
    ("encode", encode_tokens),
]

# Language identification trains a model and near-duplicate search is a fixed point: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
