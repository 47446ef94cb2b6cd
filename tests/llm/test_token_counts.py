from functools import cache
from itertools import product

import public_tokenizers
from helpers import CASES, documents

from tidemark.llm import token_counts

SCORES = {"▁": -1.0, "a": -2.0, "b": -2.0, "ab": -2.5, "▁a": -1.5, "▁ab": -4.5, "ba": -3.0, "aba": -9.0}


def best(word, scores):
    """The best cut over all cuts, by trying them."""
    unknown = min(scores.values()) - token_counts.UNKNOWN_PENALTY

    @cache
    def after(at):
        if at == len(word):
            return 0.0, 0
        score, few = after(at + 1)
        found = [(score + unknown, few - len(word[at].encode()))]
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in scores:
                score, few = after(end)
                found.append((score + scores[word[at:end]], few - 1))
        return max(found)

    return -after(0)[1]


def test_every_short_word():
    path = token_counts.TriePath(SCORES)
    words = sorted("▁" + "".join(w) for n in range(6) for w in product("abé", repeat=n))
    assert [path.terminal(word) for word in words] == [best(word, SCORES) for word in words]


def test_cases(spark):
    found = token_counts.count_tokens(documents(spark, CASES), SCORES, block_bytes=50)
    want = []
    for key, text in CASES:
        words = ["▁" + word for word in (text or "").split()]
        each = {word: token_counts.TriePath(SCORES).terminal(word) for word in set(words)}
        want.append((key, len(words), sum(each[word] for word in words)))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)
    assert token_counts.count_tokens(documents(spark, []), SCORES).collect() == []


def test_vocabulary_file(spark):
    scores = token_counts.load_scores(public_tokenizers.path("piece_bpe_32k.model"))
    assert len(scores) > 30_000 and not any(piece.startswith("<0x") for piece in scores)
    found = token_counts.count_tokens(documents(spark, [(1, "the house unbelievably été")]), scores).collect()[0]
    words = ["▁the", "▁house", "▁unbelievably", "▁été"]
    assert found["n_tokens"] == sum(best(word, scores) for word in words)
