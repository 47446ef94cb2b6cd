"""BPE by dynamic programming over a word's prefixes.

The encoding of a word is found without replaying merges. Every prefix of a word has exactly one last
token: the vocabulary token that ends there, found by an automaton over all tokens, and that stands
unmerged beside the last token of the prefix in front of it. Whether two tokens stay unmerged is read
off their merge trees (``Vocabulary.fits``). Following the last tokens back from the word's end gives
its ids, in time proportional to the word's length.

A text is encoded where it is read and nothing is shuffled: a task keeps the ids of words it has met
in a table of bounded size. What goes to the executors is the tokenizer's file.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import inf

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

# Words, and pairs of tokens, that a task remembers before it starts afresh.
REMEMBERED = 200_000
# Documents that are encoded or decoded at a time.
SLICE = 200
# Texts beyond so many characters are cut at white space before their words are listed.
LONG_TEXT = 1_000_000
# Stands for the mark of a word's end inside the automaton; no byte is written as this character.
END = "\0"


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte.

    A printable byte of Latin-1 stands for itself, the others get the characters from U+0100 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens, their merge trees, and an automaton that finds all of them in a word."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("only plain BPE vocabularies with a mark of a word's end are supported")
        if any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] for x in spec["added_tokens"]):
            raise ValueError("added tokens must match the raw text as it stands")
        self.end = model["end_of_word_suffix"]
        self.number: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        count = 1 + max([*self.number.values(), *self.special.values()])
        self.text = [""] * count
        for token, at in [*self.number.items(), *self.special.items()]:
            self.text[at] = token
        self.parts: list[tuple[int, int] | None] = [None] * count
        # When a token is merged; characters are there from the start.
        self.born = [-1] * count
        self.merged: dict[tuple[int, int], int] = {}
        for time, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (self.number[left], self.number[right]), self.number[left + right]
            if self.parts[whole] is not None or max(self.born[pair[0]], self.born[pair[1]]) >= time:
                raise ValueError("every token must come from one merge of earlier tokens")
            self.merged[pair], self.parts[whole], self.born[whole] = time, pair, time
        self._known: dict[tuple[int, int], bool] = {}
        self._automaton = ahocorasick.Automaton()
        for token, at in self.number.items():
            final = self._is_final(at)
            letters = token[:-len(self.end)] if final else token
            self._automaton.add_word(letters + END if final else letters, (at, len(letters), final))
        self._automaton.make_automaton()
        # A token that its own letters do not lead to is never the whole of a prefix.
        self.reached = [parts is None or self.fits_as_tree(at) for at, parts in enumerate(self.parts)]

    def _is_final(self, at: int) -> bool:
        while self.parts[at] is not None:
            at = self.parts[at][1]
        return len(self.text[at]) > 1 and self.text[at].endswith(self.end)

    def fits_as_tree(self, at: int) -> bool:
        """Whether the merges of the token's letters end in the token itself: its two parts stay apart until then."""
        left, right = self.parts[at]
        return self._apart(left, right, self.born[at])

    def fits(self, left: int, right: int) -> bool:
        """Whether both tokens stay as they are when one stands in front of the other."""
        known = self._known.get((left, right))
        if known is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            known = self._known[left, right] = self._apart(left, right, inf)
        return known

    def _apart(self, left: int, right: int, until: float) -> bool:
        """Whether nothing is merged across the border of two tokens before the time ``until``.

        Their merges are undone, the latest first. Of equal merges the left one comes first, so a pair
        across the border is merged before an equal one to its right, and after one to its left.
        """
        while True:
            if self.merged.get((left, right), inf) < until:
                return False
            if self.born[left] > self.born[right]:
                until, left = self.born[left], self.parts[left][1]
            elif self.parts[right] is not None:
                until, right = self.born[right] + 1, self.parts[right][0]
            else:
                return True

    def encode_word(self, letters: str) -> list[int]:
        """The ids of one word, written in the vocabulary's letters."""
        size = len(letters)
        if not size:
            return []
        whole = self.number.get(letters + self.end)
        if whole is not None and self.reached[whole]:
            return [whole]
        last, width = [-1] * (size + 1), [0] * (size + 1)
        for stop, (token, length, final) in self._automaton.iter(letters + END):
            end = size if final else stop + 1
            # The last letter carries the mark, so no prefix ends in front of the mark.
            if last[end] >= 0 or (end == size and not final):
                continue
            before = last[end - length]
            if (self.reached[token] if end == length else before >= 0 and self.fits(before, token)):
                last[end], width[end] = token, length
        ids, at = [], size
        while at:
            if last[at] < 0:
                raise ValueError(f"the vocabulary has no letters for {letters[:at]!r}")
            ids.append(last[at])
            at -= width[at]
        return ids[::-1]


class Words(dict):
    """The packed ids of words, found when first asked for."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.letters = vocabulary, byte_letters()

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        letters = "".join(map(self.letters.__getitem__, word.encode()))
        found = self[word] = np.array(self.vocabulary.encode_word(letters), "<u4").tobytes()
        return found


class TextEncoder:
    """Texts to packed ids as the tokenizer's file says: special strings, normal form, words, tokens."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        normal = [x["type"] for x in spec["normalizer"]["normalizers"]]
        split, letters = spec["pre_tokenizer"]["pretokenizers"]
        if normal != ["NFC", "Replace", "Lowercase"] or spec["normalizer"]["normalizers"][1]["pattern"] != {"Regex": r"\s+"} or (
                split["behavior"], split["invert"], letters["type"], letters["use_regex"], letters["add_prefix_space"]) != (
                "Removed", True, "ByteLevel", False, False):
            raise ValueError("the file asks for other steps than NFC, lower case, words by a pattern and byte letters")
        self.library = Tokenizer.from_str(data.decode())
        self.vocabulary = Vocabulary(data)
        self.words = Words(self.vocabulary)
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        special = self.vocabulary.special
        longest_first = sorted(special, key=len, reverse=True)
        self.cut: Callable[[str], list[str]] = regex.compile(f"({'|'.join(map(regex.escape, longest_first))})").split if special else lambda text: [text]
        self.packed = {text: np.array([at], "<u4").tobytes() for text, at in special.items()}

    def encode(self, text: str) -> bytes:
        found = []
        for piece in self.cut(text):
            if piece in self.packed:
                found.append(self.packed[piece])
            else:
                found += (b"".join(map(self.words.__getitem__, self._listed(part))) for part in _parts(piece))
        return b"".join(found)

    def _listed(self, text: str) -> list[str]:
        if text.isascii():
            return self.find(text.lower())
        if any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Whether characters are letters that this Python does not know, only the library's own tables say.
            normal = self.library.normalizer.normalize_str(text)
            return [word for word, _ in self.library.pre_tokenizer[0].pre_tokenize_str(normal)]
        # The library changes letters one by one; Python would write a sigma at a word's end in another way.
        return self.find(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())


def _parts(text: str) -> Iterator[str]:
    """A very long text in parts that end in front of a space with a plain letter behind it: no word is cut there."""
    at = 0
    while len(text) - at > LONG_TEXT:
        border = CUT.search(text, at + LONG_TEXT)
        if border is None:
            break
        yield text[at:border.start()]
        at = border.start()
    yield text[at:] if at else text


CUT = regex.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


@lru_cache(maxsize=2)
def _encoder(data: bytes) -> TextEncoder:
    return TextEncoder(data)


def load(path: str) -> bytes:
    """A tokenizer's file, as ``encode`` and ``decode`` take it."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, tokenizer: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id LONG (the key column), n_tokens LONG, ids BINARY (little-endian unsigned 32-bit numbers): one row per row.

    A null, empty or blank text has no ids. Repeated rows and repeated or null keys each give their own
    row, ties cannot occur, and an empty table gives no rows. A very long text is encoded whole, part by
    part. Other columns of ``docs`` are not read, so their names do not matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def rows(batches):
        encoder = _encoder(shared.value)
        for batch in (whole.slice(start, SLICE) for whole in batches for start in range(0, whole.num_rows, SLICE)):
            ids = [encoder.encode(text.as_py() or "") for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    read = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return read.mapInArrow(rows, "id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, tokenizer: bytes, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` STRING: the tokens as the vocabulary writes them, joined by spaces.

    That is what the library gives for a file without a decoder. Null ids give null, no ids the empty
    text. A column of that name is replaced. An id outside the vocabulary fails the job.
    """
    if json.loads(tokenizer)["decoder"] is not None:
        raise ValueError("the file names a decoder")
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(tokenizer).text)

    def decoded(batches):
        tokens = pa.array(shared.value, pa.large_string())
        for batch in (whole.slice(start, SLICE) for whole in batches for start in range(0, whole.num_rows, SLICE)):
            packed = [x.as_py() for x in batch.column(at)]
            sizes = np.array([len(x or b"") // 4 for x in packed], np.int64)
            flat = np.frombuffer(b"".join(x or b"" for x in packed), "<u4").astype(np.int64)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64())
            out = pc.binary_join(pa.LargeListArray.from_arrays(ends, tokens.take(pa.array(flat))), pa.scalar(" ", pa.large_string()))
            out = pc.if_else(batch.column(at).is_valid(), out, pa.scalar(None, pa.large_string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), out.cast(pa.string())], names)

    at, kept = encoded.columns.index(ids), [i for i, c in enumerate(encoded.columns) if c != "decoded"]
    names = [*(encoded.columns[i] for i in kept), "decoded"]
    schema = encoded.select(*(F.col(encoded.columns[i]) for i in kept)).schema.add("decoded", "string")
    return encoded.mapInArrow(decoded, schema)


def unpacked(packed: bytes) -> list[int]:
    """Packed ids as numbers."""
    return np.frombuffer(packed, "<u4").tolist()


def digest_of(ids: list[int]) -> str:
    """What sha256 of packed ids is for a list of ids."""
    return hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
