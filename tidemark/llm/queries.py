"""The registered queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (bitplanes, bpe, chat, filter_audit, fingerprints, langid, line_templates, minhash, mixing, prefix_bpe, secrets,
                          token_counts, vectors)

_registry: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(build):
    _registry[build.__name__] = build
    return build


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_registry)


def all_oracles() -> dict[str, str]:
    """SQL for those queries that SQL can express."""
    return dict(_oracles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, as digests."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and unigram pieces of every document."""
    scores = token_counts.load_scores(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), scores).withColumnRenamed("id", "doc_id")


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate component."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op9_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    found = fingerprints.compared_with_edit(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next", "edited_paragraph")


_oracles["op9_merkle_fingerprints"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
      FROM d WINDOW w AS (ORDER BY doc_id NULLS FIRST, text)),
e AS (SELECT doc_id, text, next_text, substr(text, 1, (length(text) - length(text) // 4)::BIGINT)
             || substr(next_text, 1, (length(text) // 4)::BIGINT) AS edited FROM n),
t AS (SELECT *,
    [[md5(p) FOR p IN string_split(s, chr(10))] FOR s IN string_split(text, chr(10) || chr(10))] AS a,
    [[md5(p) FOR p IN string_split(s, chr(10))] FOR s IN string_split(edited, chr(10) || chr(10))] AS b,
    list_distinct(regexp_extract_all(text, '(?s).*?(?:[\n.,;:!?|]|[aeionst] )|.+')) AS f,
    list_distinct(regexp_extract_all(edited, '(?s).*?(?:[\n.,;:!?|]|[aeionst] )|.+')) AS g,
    list_distinct(regexp_extract_all(next_text, '(?s).*?(?:[\n.,;:!?|]|[aeionst] )|.+')) AS h FROM e),
z AS (SELECT *, list_position([coalesce(x[1] = x[2], false) FOR x IN list_zip(flatten(a), flatten(b))], false) AS para,
    list_position([coalesce(x[1] = x[2], false) FOR x IN list_zip(a, b)], false) AS sect FROM t)
SELECT doc_id, length(text) AS n_chars, sha256(edited) AS edited_sha256,
    sha256(array_to_string([md5(array_to_string(s, '')) FOR s IN a], '')) AS fingerprint,
    sha256(array_to_string([md5(array_to_string(s, '')) FOR s IN b], '')) AS edited_fingerprint,
    CASE WHEN greatest(len(f), len(g)) = 0 THEN 1.0::DOUBLE
         ELSE len(list_intersect(f, g))::DOUBLE / greatest(len(f), len(g)) END AS near_edited,
    CASE WHEN greatest(len(f), len(h)) = 0 THEN 1.0::DOUBLE
         ELSE len(list_intersect(f, h))::DOUBLE / greatest(len(f), len(h)) END AS near_next,
    CASE WHEN para > 0 THEN (para - 1)::BIGINT
         WHEN sect > 0 THEN (list_sum([len(s) FOR s IN a[1:sect]]) - 1)::BIGINT END AS edited_paragraph
FROM z
"""


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document, and counts of the fixed patterns."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = (F.size(F.array_remove(kinds, kind)) for kind, *_ in secrets.BASE)
    counts = ((F.size("base") - rest).cast("long").alias(f"n_{kind}") for (kind, *_), rest in zip(secrets.BASE, counts))
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"),
                        secrets.listed(F.col("spans")).alias("spans"))


@query
def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and component."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents").withColumn(
        "held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    model = langid.fit(docs.where("NOT held_out"))
    return langid.predict(docs, model, keep=["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring lines, as counts and a digest of the text that is left."""
    found = line_templates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_dropped").cast("long").alias("n_dropped"),
                        "left_whole", F.sha2("text", 256).alias("text_sha256"))


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a mix of the sources by the roots of their sizes."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


# What a turn that asks for an answer has to hold.
TURN = {"required": ["text", "turn"], "types": {"text": "string", "turn": "integer"}}


@query
def op7_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of a conversation that is not the assistant's as a call, linked with the assistant's turn behind it.

    The table holds no tool calls of its own; a turn needs the one two before it, if that is a call, so levels
    count the calls in a row before it.
    """
    turns = table(spark, sf_dir, "conversations")
    name = lambda back: F.concat_ws("-", "conv_id", F.col("turn") - back)
    assistant = F.coalesce(F.col("role") == "assistant", F.lit(False))
    calls = turns.where(~assistant & F.col("turn").isNotNull()).select(
        F.col("conv_id").alias("conv"), name(0).alias("call"), "turn", F.col("role").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"), F.array(name(2)).alias("needs"))
    results = turns.where(assistant & F.col("turn").isNotNull()).select(
        F.col("conv_id").alias("conv"), name(1).alias("call"), "turn", F.col("text").alias("content"))
    linked = chat.link_calls(calls, results, {"user": TURN, "system": TURN})
    return linked.select(F.col("conv").alias("conv_id"), F.col("call").alias("call_id"), "status", F.col("level").cast("long").alias("level"),
                         "turn", F.array_join("faults", ",").alias("faults"), "line")


_oracles["op7_tool_call_links"] = """
WITH t AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c AS (SELECT conv_id, turn, role, text FROM t WHERE role IS DISTINCT FROM 'assistant'
      QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role NULLS FIRST,
          CASE WHEN text IS NULL THEN '{"turn":' || turn || '}' ELSE to_json({turn: turn, text: text})::VARCHAR END) = 1),
r AS (SELECT conv_id, turn - 1 AS asked, turn, text FROM t WHERE role = 'assistant'
      QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY text NULLS FIRST) = 1),
j AS (SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.asked) AS asked, coalesce(c.turn, r.turn) AS turn,
             role, c.text AS text, c.turn IS NOT NULL AS is_call, r.turn IS NOT NULL AS is_answered, r.text AS answer
      FROM c FULL JOIN r ON c.conv_id = r.conv_id AND c.turn = r.asked),
f AS (SELECT *, CASE WHEN NOT is_call THEN 'orphan' WHEN is_answered THEN 'linked' ELSE 'unanswered' END AS status,
             CASE WHEN NOT is_call THEN [] WHEN role IS NULL OR role NOT IN ('user', 'system') THEN ['unknown tool']
                  WHEN text IS NULL THEN ['missing text'] ELSE [] END::VARCHAR[] AS faults,
             -- Calls two turns apart are in one run: their number along the run keeps pace with the turn.
             asked - 2 * row_number() OVER (PARTITION BY conv_id, is_call, asked % 2 ORDER BY asked) AS run FROM j)
SELECT conv_id, conv_id || '-' || asked AS call_id, status,
    CASE WHEN is_call THEN row_number() OVER (PARTITION BY conv_id, is_call, asked % 2, run ORDER BY asked) - 1 ELSE 0 END AS level, turn, array_to_string(faults, ',') AS faults,
    '{' || CASE WHEN is_call THEN '"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE '"text":' || to_json(text)::VARCHAR || ',' END
                                  || '"turn":' || turn || '},' ELSE '' END
        || '"call":"' || conv_id || '-' || asked || '","conv":' || conv_id || ',"faults":' || to_json(faults)::VARCHAR
        || CASE WHEN is_call AND role IS NOT NULL THEN ',"name":' || to_json(role)::VARCHAR ELSE '' END
        || CASE WHEN answer IS NOT NULL THEN ',"result":' || to_json(answer)::VARCHAR ELSE '' END
        || ',"status":"' || status || '","turn":' || turn || '}' AS line
FROM f
"""

_oracles["op2_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
u AS (SELECT doc_id, text, row_number() OVER () AS u FROM (SELECT DISTINCT doc_id, text FROM d WHERE text IS NOT NULL)),
s AS (SELECT u, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM u),
m AS (SELECT u, place, regexp_replace(trim(regexp_replace(line, '[ \t\r\v\f]+', ' ', 'g')), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS masked FROM s),
l AS (SELECT *, string_split(masked, ' ') AS w FROM m WHERE masked <> ''),
k AS (SELECT *, len(w) AS n, w[1:3] AS head FROM l),
v AS (SELECT DISTINCT n, head, masked, w[4:] AS tail FROM k WHERE n >= 5),
p AS (SELECT n, head, unnest(tail) AS token, generate_subscripts(tail, 1) AS pos FROM v),
o AS (SELECT n, head, pos, token FROM (SELECT n, head, pos, token, count(*) AS c FROM p GROUP BY ALL)
      QUALIFY row_number() OVER (PARTITION BY n, head, pos ORDER BY c DESC, token) = 1),
h AS (SELECT n, head, list(token ORDER BY pos) AS shape FROM o GROUP BY n, head),
a AS (SELECT n, head, count(*) AS lines FROM (SELECT DISTINCT n, head, masked FROM k) GROUP BY n, head),
b AS (SELECT v.masked FROM v JOIN h USING (n, head) JOIN a USING (n, head)
      WHERE lines > 1 AND 2 * len(list_filter(list_zip(tail, shape), lambda x: x[1] = x[2])) >= len(tail)),
t AS (SELECT k.u, k.place, CASE WHEN b.masked IS NULL THEN {n: 0::BIGINT, head: [k.masked]} ELSE {n: k.n, head: k.head} END AS template
      FROM k LEFT JOIN b ON k.masked = b.masked),
q AS (SELECT template FROM t GROUP BY template HAVING count(DISTINCT u) >= 5),
x AS (SELECT u, list(DISTINCT place) AS drops FROM t JOIN q USING (template) GROUP BY u),
y AS (SELECT u.doc_id, u.text, coalesce(drops, []) AS drops, string_split(u.text, chr(10)) AS cut FROM u LEFT JOIN x USING (u)),
z AS (SELECT *, [length(c) FOR c IN cut] AS letters, [c FOR c IN cut IF regexp_replace(c, '[ \t\r\v\f]+', '', 'g') <> ''] AS shown FROM y),
e AS (SELECT *, coalesce(2 * list_sum([letters[i] FOR i IN drops]) > list_sum(letters), false) AS whole FROM z)
SELECT d.doc_id, coalesce(len(shown), 0)::BIGINT AS n_lines,
    CASE WHEN whole THEN 0 ELSE coalesce(len(drops), 0) END::BIGINT AS n_dropped, coalesce(whole, false) AS left_whole,
    sha256(CASE WHEN whole OR len(drops) = 0 THEN e.text
           ELSE array_to_string([cut[i] FOR i IN range(1, len(cut) + 1) IF NOT list_contains(drops, i)], chr(10)) END) AS text_sha256
FROM d LEFT JOIN e ON d.doc_id IS NOT DISTINCT FROM e.doc_id AND d.text = e.text
"""


@query
def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the word vocabulary and decoded again, as digests."""
    tokenizer = prefix_bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    encoded = prefix_bpe.encode(table(spark, sf_dir, "documents"), tokenizer)
    return prefix_bpe.decode(encoded, tokenizer).select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language, in every order."""
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Each document meets each order here, and the first of its failures in that order removes it.
_oracles["op12_filter_audit"] = r"""
WITH m AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(words) < 200 THEN ['A'] ELSE [] END
        || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN ['B'] ELSE [] END
        || CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) THEN ['C'] ELSE [] END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN ['D'] ELSE [] END
        || CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN ['E'] ELSE [] END AS fails
      FROM t LEFT JOIN m ON t.doc_id = m.doc_id),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT f.*, filter_order, coalesce(list_min([instr(filter_order, y) FOR y IN fails]), 6) AS gone FROM f, o),
k AS (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM s),
c AS (SELECT part, filter_order, step::INT AS step, substr(filter_order, step, 1) AS letter,
        count(*) FILTER (gone > step) AS kept, count(*) FILTER (gone = step) AS removed,
        count(*) FILTER (gone < step AND list_contains(fails, substr(filter_order, step, 1))) AS redundant,
        count(*) FILTER (fails = [substr(filter_order, step, 1)]) AS unique_fails,
        count(*) FILTER (gone = step AND good = 1) AS good_lost, count(*) FILTER (gone = step AND toxic = 1) AS toxic_lost
      FROM k GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM c
"""


@query
def op13_bitplane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole vector's cluster after ten rounds."""
    found = bitplanes.cluster(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
                        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"))


def _rounds_sql(rounds: int) -> str:
    """The rounds written out one after the other, by differences of components."""
    near = """a{at} AS MATERIALIZED (SELECT r, vec_id, v, k, d FROM (
    SELECT r, vec_id, v, k, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v, c)])::BIGINT AS d FROM v, c{at})
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)"""
    move = """s{at} AS (SELECT k, i, sum(x) AS s, count(*) AS n
    FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{at}) GROUP BY k, i),
m{at} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{at} GROUP BY k),
c{to} AS MATERIALIZED (SELECT k, coalesce(m{at}.c, c{at}.c) AS c FROM c{at} LEFT JOIN m{at} USING (k))"""
    steps = [f"{near.format(at=at)},\n{move.format(at=at, to=at + 1)}" for at in range(rounds)]
    return """WITH w AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings WHERE len(embedding) = 64),
v AS MATERIALIZED (SELECT r, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM w
    WHERE len([1 FOR x IN embedding IF coalesce(isfinite(x), false)]) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) AS k, v AS c FROM v
    QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), v) <= 8),
""" + ",\n".join([*steps, near.format(at=rounds)]) + f"""
SELECT vec_id, (k - 1)::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (k)
"""


_oracles["op13_bitplane_clusters"] = _rounds_sql(10)
