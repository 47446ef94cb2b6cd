"""The registered queries against SQL or brute force, on the smallest tables."""

import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import bpe, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries.all_queries(), queries.all_oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert {name.split("_")[0] for name in set(QUERIES) - set(ORACLES)} == {"op1", "op3", "op4", "op5", "op6", "op8", "op10", "op11"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    actual = sorted(tuple(repr(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert actual == sorted(tuple(repr(row[names.index(c)]) for c in columns) for row in cursor.fetchall())


def test_op1_equals_the_library(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op1_byte_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        digests = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), texts[r["doc_id"]].encode())]
        assert [r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]] == [len(ids), *digests]


def test_op11_equals_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op11_prefix_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        packed = hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest()
        assert [r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]] == [len(ids), packed, decoded]


def test_op5_equals_brute_force(spark):
    from test_minhash import brute_force
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op5_minhash_near_dedup"](spark, SF_DIR).collect()), key=repr) == brute_force(rows)


def test_op10_equals_brute_force(spark):
    from test_vectors import brute_force
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in QUERIES["op10_embedding_near_dedup"](spark, SF_DIR).collect()}
    assert got == brute_force(rows)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    kept = {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        if at < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == list(spark.read.parquet(f"{SF_DIR}/documents.parquet").columns)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    assert set(kept["language_id"]) == {k for k, r in rows.items() if any(c.isalpha() for c in r["text"] or "")}
    assert set(kept["line_dedup"]) == set(kept["language_id"])
    for r in kept["line_dedup"].values():
        assert r["n_chars"] == len(r["text"]) and set(r["text"].split("\n")) <= {*rows[r["doc_id"]]["text"].split("\n"), ""}
    from test_minhash import brute_force
    groups = brute_force([(k, r["text"]) for k, r in kept["line_dedup"].items()])
    assert set(kept["near_dedup"]) == {k for k, *_, stays in groups if stays}
    assert set(kept["mix"]) == set(kept["near_dedup"]) == set(kept["encode"])
    for k, r in kept["encode"].items():
        assert r["decoded_sha256"] == hashlib.sha256(kept["mix"][k]["text"].encode()).hexdigest() and len(r["ids"]) == r["n_tokens"]


def test_pipeline_of_odd_rows(spark, tmp_path):
    from helpers import CASES, documents
    documents(spark, [*CASES, (5, "twice the same row")], extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == [1, 5, 6, 7, None]
    documents(spark, [], extra=False).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_leave_other_columns_alone(spark, tmp_path):
    from helpers import CASES, documents
    names = ("row", "score", "rejected", "lang_pred", "n_lines", "n_dropped", "left_whole", "mix_slot", "mix_notes", "id", "kept", "component")
    docs = documents(spark, CASES, extra=False).selectExpr("*", *(f"concat('{n} of ', coalesce(doc_id, 0)) AS {n}" for n in names))
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        rows = docs.collect()
        assert docs.columns[5:] == list(names) and len(rows) > 3, name
        assert all(r[n] == f"{n} of {r['doc_id'] or 0}" for r in rows for n in names), name


def test_near_dedup_decides_by_row(spark):
    from helpers import documents
    text = lambda word: " ".join(f"{word}{i}" for i in range(40))
    rows = [*((1, text(word)) for word in "abcd"), (1, text("a")), (2, text("a") + " more"), (None, text("e")), (None, text("e")),
            (None, text("b")), (0, text("d"))]
    docs = documents(spark, rows, extra=False)
    got = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(
        [(1, text("a")), (1, text("b")), (1, text("c")), (0, text("d")), (None, text("e"))], key=repr)


def test_the_mix_shows_in_the_result(spark, tmp_path):
    from helpers import documents
    # Three sources of 1600, 400 and 100 rows: targets by the roots, 4 to 2 to 1.
    sources = {i: "a" if i < 1600 else "b" if i < 2000 else "c" for i in range(2100)}
    rows = [(i, f"text {i}", "en", s, None) for i, s in sources.items()]
    docs = documents(spark, [*rows, rows[0], (7, "another text of seven", "en", "a", None)], extra=False)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got = corpus_pipeline.encode_tokens(spark, docs, SF_DIR).collect()
    assert len(got) == 2102 and len({(r["mix_slot"], r["mix_place"]) for r in got}) == 2102
    order = [sources[r["doc_id"]] for r in sorted(got, key=lambda r: (r["mix_slot"], r["mix_place"]))]
    # Blocks hold 64 rows, and every source is less than one block away from its share.
    for size in (64 * 4, 64 * 7):
        for source, share in (("a", 4 / 7), ("b", 2 / 7), ("c", 1 / 7)):
            if source != "c" or size * share <= 64:
                assert abs(order[:size].count(source) - size * share) <= 64
    digests = {hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.collect()}
    assert {r["decoded_sha256"] for r in got} == digests
