import random

import public_tokenizers
import pytest
from helpers import CASES, documents
from tokenizers import Tokenizer

from tidemark.llm import prefix_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.TextEncoder(prefix_bpe.load(PATH))


def test_cases(spark, library):
    tokenizer = prefix_bpe.load(PATH)
    found = prefix_bpe.decode(prefix_bpe.encode(documents(spark, CASES), tokenizer), tokenizer)
    expected = []
    for key, text in CASES:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((key, len(ids), prefix_bpe.digest_of(ids), library.decode(ids, skip_special_tokens=False)))
    got = [(r["id"], r["n_tokens"], prefix_bpe.digest_of(prefix_bpe.unpacked(bytes(r["ids"]))), r["decoded"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert prefix_bpe.encode(documents(spark, []), tokenizer).collect() == []


def test_nulls_and_clashing_columns_in_decoding(spark):
    tokenizer = prefix_bpe.load(PATH)
    rows = spark.createDataFrame([(1, None, "old"), (2, b"", "old"), (3, b"\x00\x01\x00\x00" * 2, "old")], "n int, ids binary, decoded string")
    found = prefix_bpe.decode(rows, tokenizer)
    assert found.columns == ["n", "ids", "decoded"]
    text = Tokenizer.from_file(PATH).decode([256, 256], skip_special_tokens=False)
    assert {r["n"]: r["decoded"] for r in found.collect()} == {1: None, 2: "", 3: text}


def test_random_texts_equal_the_library(library, encoder):
    draw = random.Random(4)
    signs = [*"abcdeiorstnlABÉßẞΣς'’  \n\t\x1c\x85\xa0　²½٣,!世😀👍́İ‍<|>/w", "'s", "'LL", "the", "ing", "tion", "</w>",
             "<|endoftext|>", "<|startoftext|>", "<|END", "Ɤ", "\U00016eb4", "﷐", ""]
    for _ in range(3000):
        text = "".join(draw.choices(signs, k=draw.randrange(40)))
        assert prefix_bpe.unpacked(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_repeats_and_long_words_equal_the_library(library, encoder):
    draw = random.Random(5)
    words = ["a" * n for n in range(1, 70)] + ["ha" * n for n in range(1, 40)] + ["😂" * n for n in range(1, 30)] + ["!" * n for n in range(1, 80)]
    words += ["".join(draw.choices("abehilnorst", k=n)) for n in (100, 1000, 5000) for _ in range(5)]
    for word in words:
        assert prefix_bpe.unpacked(encoder.encode(word)) == library.encode(word, add_special_tokens=False).ids, word[:50]


def test_every_token_is_told_from_those_never_reached(library, encoder):
    vocabulary = encoder.vocabulary
    for token, at in random.Random(6).sample(sorted(vocabulary.number.items()), 4000):
        if token.endswith(vocabulary.end) and vocabulary.parts[at] is not None:
            word = token[:-len(vocabulary.end)]
            merged = library.model.tokenize(word)
            assert vocabulary.encode_word(word) == [t.id for t in merged]


def test_long_texts_are_cut_between_words(library, encoder, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(prefix_bpe, "REMEMBERED", 10)
    encoder.words.clear()
    text = "It's Peter’s idea  of\n1.5 million words é é " * 50 + "x" * 300 + " y z"
    assert len(list(prefix_bpe._parts(text))) > 5 and "".join(prefix_bpe._parts(text)) == text
    assert prefix_bpe.unpacked(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
