import random

import public_tokenizers
import pytest
import tiktoken
from helpers import CASES, documents

from tidemark.llm import bpe, wordblocks


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(spark, ranks, rows, **options):
    found = bpe.decode(bpe.encode(documents(spark, rows), ranks, public_tokenizers.PATTERN, **options), ranks)
    return sorted(((r["id"], r["ids"], bytes(r["decoded"])) for r in found.collect()), key=repr)


def expected(library, rows):
    return sorted(((key, library.encode_ordinary(text or ""), (text or "").encode()) for key, text in rows), key=repr)


def test_cases(spark, ranks, library):
    assert encoded(spark, ranks, CASES) == expected(library, CASES)


def test_white_space_and_signs_in_small_blocks(spark, ranks, library):
    draw = random.Random(1)
    signs = [*"ab é'  \n\t\x1c\x85\xa0　²½٣,!世", "'s", "'ll", "  ", "\n\n", " \n"]
    rows = [(i, "".join(draw.choices(signs, k=draw.randrange(50)))) for i in range(300)]
    assert encoded(spark, ranks, rows, block_bytes=200) == expected(library, rows)


def test_long_words_are_merged_alike(ranks, library):
    draw = random.Random(2)
    for _ in range(50):
        word = "".join(draw.choices("abcdeinthers", k=draw.randrange(49, 300)))
        assert bpe.encode_word(word.encode(), ranks) == library.encode_ordinary(word)


def test_empty_table(spark, ranks):
    assert encoded(spark, ranks, []) == []


def test_null_ids_decode_to_null(spark, ranks):
    table = spark.createDataFrame([(1, None, "old"), (2, [], "old"), (3, [256], "old")], "id long, ids array<int>, decoded string")
    assert {r["id"]: r["decoded"] for r in bpe.decode(table, ranks).collect()} == {1: None, 2: b"", 3: library_bytes(ranks, 256)}


def library_bytes(ranks, number):
    return next(token for token, rank in ranks.items() if rank == number)


def test_runs_of_lists():
    import numpy as np
    flat, sizes = np.arange(6), np.array([2, 0, 3, 1])
    assert wordblocks.gathered(flat, sizes, np.array([2, 1, 0, 2])).tolist() == [2, 3, 4, 0, 1, 2, 3, 4]
    assert wordblocks.sums(np.array([1, 2, 3]), np.array([0, 2, 1, 0])).tolist() == [0, 3, 3, 0]
