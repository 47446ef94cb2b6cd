"""Polarity of texts by the longest phrases of a lexicon.

The lexicon, a table made by people and so of bounded length, is turned into a trie whose steps are words,
and sent to every task once. A text is scored in the task that reads it: an automaton finds the words that
begin a phrase, and only from there the trie is walked. Nothing is exploded or shuffled, and the rest of a
text is never cut into words.
"""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, functions as F

# Words that turn the polarity of what follows, by how much, and words that strengthen or weaken it.
NEGATIONS, NEGATED = ("not", "no", "never", "without"), -0.5
INTENSIFIERS = {"very": 1.3, "highly": 1.3, "really": 1.2, "extremely": 1.5, "somewhat": 0.7, "slightly": 0.5}

# Phrases that a lexicon may hold; more is taken for a mistake and fails.
LEXICON_ROWS = 500_000

# Signs that end a clause.
ENDS = ".,;:!?"

LETTER = r"[\p{L}\p{N}]"


class Trie:
    """Phrases by their words. ``clauses`` lets a negation reach to the end of its clause."""

    def __init__(self, phrases: Sequence[tuple[str, float]], clauses: bool):
        # A step holds the polarity of the phrase that ends here, if one does, and the words that lead on.
        self.root: dict[str, list] = {}
        self.word, self.last_word = regex.compile(f"{LETTER}+"), regex.compile(f"(?r){LETTER}+")
        self.last_end, self.letter = regex.compile(f"(?r)[{ENDS}]"), regex.compile(LETTER)
        self.negation = regex.compile(f"(?<!{LETTER})(?:{'|'.join(NEGATIONS)})(?!{LETTER})")
        self.clauses = clauses
        for phrase, polarity in phrases:
            steps, node = self.root, None
            for word in self.word.findall(phrase):
                node = steps.setdefault(word, [None, {}])
                steps = node[1]
            if node is not None:
                node[0] = polarity
        self.first = ahocorasick.Automaton()
        for word in self.root:
            self.first.add_word(word, word)
        if self.root:
            self.first.make_automaton()

    def _whole(self, text: str, start: int, stop: int) -> bool:
        """Whether a word is not part of a longer one."""
        return not (start and self.letter.match(text[start - 1])) and not (stop < len(text) and self.letter.match(text[stop]))

    def _longest(self, text: str, word: str, stop: int) -> tuple[int, float]:
        """The end of the longest phrase that begins with ``word``, which ends at ``stop``, and its polarity; -1 if there is none."""
        end, polarity, node = -1, 0.0, self.root[word]
        while True:
            if node[0] is not None:
                end, polarity = stop, node[0]
            if not node[1] or (found := self.word.search(text, stop)) is None:
                return end, polarity
            if (node := node[1].get(found.group())) is None or self._ended(text, stop, found.start()):
                return end, polarity
            stop = found.end()

    def _ended(self, text: str, start: int, stop: int) -> bool:
        return self.clauses and self.last_end.search(text, start, stop) is not None

    def _word_before(self, text: str, start: int) -> tuple[str, int]:
        """The word in front of a place, if it stands in the same clause, and where it starts."""
        found = self.last_word.search(text, 0, start)
        return ("", 0) if found is None or self._ended(text, found.end(), start) else (found.group(), found.start())

    def score(self, text: str) -> float:
        """The mean polarity of a lower-case text's phrases, 0.0 if it has none. Phrases do not overlap, the first comes first."""
        values, free, seen, turned = [], 0, 0, False
        for last, word in self.first.iter(text) if self.root else ():
            start = last + 1 - len(word)
            if start < free or not self._whole(text, start, last + 1):
                continue
            end, polarity = self._longest(text, word, last + 1)
            if end < 0:
                continue
            free = end
            before, at = self._word_before(text, start)
            if self.clauses:
                # Only what lies between the last phrase's start and this one's is looked at again.
                if (sign := self.last_end.search(text, seen, start)) is not None:
                    turned, seen = False, sign.end()
                turned, seen = turned or self.negation.search(text, seen, start) is not None, start
            else:
                turned = before in NEGATIONS or (before in INTENSIFIERS and self._word_before(text, at)[0] in NEGATIONS)
            value = polarity * INTENSIFIERS.get(before, 1.0) * (NEGATED if turned else 1.0)
            values.append(max(-1.0, min(1.0, value)))
        return sum(values) / len(values) if values else 0.0


def polarity(text: Column, lexicon: DataFrame, clauses: bool = False, phrase: str = "word") -> Column:
    """The mean polarity of the lexicon's phrases in a text, 0.0 if it has none or is NULL.

    ``lexicon`` has a column of phrases, of one word or several, and ``polarity``; a phrase that stands
    there several times counts with the mean. At each place the longest phrase counts, and phrases do not
    overlap. A polarity is multiplied by the strength of an intensifier right before it, and by ``NEGATED``
    where it is negated: by a word before it or before that intensifier, or with ``clauses`` by any earlier
    word of its clause, which ends at a sign such as a comma. The product is kept within -1 and 1.
    """
    spark = lexicon.sparkSession
    known = lexicon.where(F.col(phrase).isNotNull() & F.col("polarity").isNotNull()).groupBy(F.lower(phrase).alias("phrase")).agg(
        F.avg("polarity").alias("polarity"))
    rows = known.limit(LEXICON_ROWS + 1).collect()
    if len(rows) > LEXICON_ROWS:
        raise ValueError(f"a lexicon of more than {LEXICON_ROWS} phrases")
    shared = spark.sparkContext.broadcast(Trie([(row["phrase"], row["polarity"]) for row in rows], clauses))

    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score).astype("float64")

    return F.pandas_udf(scored, "double")(F.lower(F.coalesce(text, F.lit(""))))
