"""Token counts under a unigram vocabulary, with the work shared along a trie of distinct words.

The distinct words of all blocks (see ``wordblocks``) are dealt out by their leading characters and
sorted, which walks the trie of a partition depth first: the best scores of a prefix stay on the
path while every word below it is visited, so each trie node is scored once and only one path is in
memory. The number of pieces at a word's end goes back to its blocks, and a document's count is the
sum over its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import wordblocks

# Words that share this many characters meet in one partition.
SHARED_PREFIX = 6
# The mark of a word's beginning, and how far an unknown character lies below the worst piece.
WORD_MARK = "▁"
UNKNOWN_PENALTY = 10.0


def load_scores(path: str) -> dict[str, float]:
    """Pieces and their scores; control and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))}


def marked_words(unit: str) -> list[str]:
    """The runs without white space, each headed by the word mark."""
    return [WORD_MARK + word for word in unit.split()]


class TriePath:
    """Best score and number of pieces for every prefix of the current word.

    A character that no piece covers counts as many pieces as it has UTF-8 bytes. Of equal scores
    the one of fewer pieces is taken.
    """

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.word, self.best = "", [(0.0, 0)]

    def terminal(self, word: str) -> int:
        """Number of pieces of ``word``; prefixes shared with the word before are not scored again."""
        shared = 0
        for a, b in zip(self.word, word):
            if a != b:
                break
            shared += 1
        best, scores = self.best, self.scores
        del best[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            score, pieces = best[end - 1]
            top = (score + self.unknown, -pieces - len(word[end - 1].encode()))
            for start in range(max(0, end - self.longest), end):
                found = scores.get(word[start:end])
                if found is not None:
                    score, pieces = best[start]
                    top = max(top, (score + found, -pieces - 1))
            best.append((top[0], -top[1]))
        self.word = word
        return best[-1][1]


def count_tokens(docs: DataFrame, scores: dict[str, float], key: str = "doc_id", text: str = "text",
                 block_bytes: int = wordblocks.BLOCK_BYTES) -> DataFrame:
    """id LONG (the key column), n_words LONG, n_tokens LONG: one row per row of ``docs``.

    A null, empty or blank text has 0 of both. Repeated rows and repeated or null keys each give
    their own row. Other columns are not read.
    """
    spark = docs.sparkSession
    shared, parts = spark.sparkContext.broadcast(scores), wordblocks.part_count(spark)

    def answer(found: list[str]) -> list[list[int]]:
        path = TriePath(shared.value)
        return [[path.terminal(word)] for word in found]

    def build(texts: pa.Table, codes: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> pa.Table:
        return pa.table({"id": texts["id"], "n_words": texts["n"].cast(pa.int64()),
                         "n_tokens": pa.array(wordblocks.sums(flat[codes], texts["n"].to_numpy()))})

    found = wordblocks.words(docs, marked_words, text, parts, SHARED_PREFIX, block_bytes)
    coded = wordblocks.codes(docs, marked_words, key, text, parts, SHARED_PREFIX, block_bytes)
    known = wordblocks.answers(found, answer, parts)
    return wordblocks.assembled(coded, known, build, "id long, n_words long, n_tokens long")
