"""Byte-level BPE: every distinct word is encoded once, and its ids go back to where it stands.

The words of all blocks (see ``wordblocks``) are shuffled by word, so that equal words of all
documents meet and are encoded once; the ids return to their blocks by a second shuffle, and each
document is put together by the positions of its words. Decoding joins ids with the bytes of the
tokens. Only the vocabulary, whose size is fixed by its file, is sent to every task.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from tidemark.llm import wordblocks

# Words longer than this are merged with a heap: repeated search for the best pair is quadratic.
LONG_WORD = 48
# Documents that are decoded at a time.
SLICE = 200


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank, from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word: the adjacent pair of the lowest rank is merged until none is known."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > LONG_WORD:
        return _encode_long(word, ranks)
    parts = [word[i:i + 1] for i in range(len(word))]
    none = len(ranks)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (best := min(pairs)) < none:
        at = pairs.index(best)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return [ranks[part] for part in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap of pairs over a linked list of parts."""
    size = len(word)
    end, before, alive = list(range(1, size + 1)), list(range(-1, size - 1)), [True] * size
    heap: list[tuple[int, int, int]] = []

    def offer(at: int) -> None:
        if at >= 0 and end[at] < size:
            stop = end[end[at]]
            if (rank := ranks.get(word[at:stop])) is not None:
                heapq.heappush(heap, (rank, at, stop))

    for at in range(size):
        offer(at)
    while heap:
        _, at, stop = heapq.heappop(heap)
        if not alive[at] or end[at] == size or end[end[at]] != stop or end[at] == stop:
            continue
        alive[end[at]], end[at] = False, stop
        if stop < size:
            before[stop] = at
        offer(at)
        offer(before[at])
    return [ranks[word[at:end[at]]] for at in range(size) if alive[at]]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, key: str = "doc_id", text: str = "text",
           block_bytes: int = wordblocks.BLOCK_BYTES) -> DataFrame:
    """id LONG (the key column), ids ARRAY<INT>: one row per row of ``docs``.

    A null or empty text has no ids. Repeated rows and repeated or null keys each give their own row.
    Other columns of ``docs`` are not read, so their names do not matter.
    """
    spark = docs.sparkSession
    shared, parts = spark.sparkContext.broadcast(ranks), wordblocks.part_count(spark)
    matches = regex.compile(pattern).findall

    def pieces(unit: str) -> list[str]:
        # Letters behind at most one space are one match of the pattern; the rest is left to it.
        letters = unit[1:] if unit[:1] == " " else unit
        return [unit] if letters.isalpha() else matches(unit)

    def answer(found: list[str]) -> list[list[int]]:
        ranked = shared.value
        return [encode_word(word.encode(), ranked) for word in found]

    def build(texts: pa.Table, codes: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> pa.Table:
        lengths = wordblocks.sums(sizes[codes], texts["n"].to_numpy())
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), pa.array(wordblocks.gathered(flat, sizes, codes)))
        return pa.table({"id": texts["id"], "ids": ids})

    known = wordblocks.answers(wordblocks.words(docs, pieces, text, parts, block_bytes=block_bytes), answer, parts)
    coded = wordblocks.codes(docs, pieces, key, text, parts, block_bytes=block_bytes)
    return wordblocks.assembled(coded, known, build, "id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded`` BINARY, the bytes of its ids; null ids give null.

    A column of that name is replaced. An id outside the vocabulary fails the job.
    """
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(table)

    def decoded(batches):
        tokens = pa.array(shared.value, pa.large_binary())
        for batch in (whole.slice(start, SLICE) for whole in batches for start in range(0, whole.num_rows, SLICE)):
            lists = batch.column(at).cast(pa.large_list(pa.int32()))
            flat = tokens.take(lists.flatten())
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
            out = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), flat), pa.scalar(b"", pa.large_binary()))
            out = pc.if_else(lists.is_valid(), out, pa.scalar(None, pa.large_binary()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), out.cast(pa.binary())], names)

    at, kept = encoded.columns.index(ids), [i for i, c in enumerate(encoded.columns) if c != "decoded"]
    names = [*(encoded.columns[i] for i in kept), "decoded"]
    schema = encoded.select(*(F.col(encoded.columns[i]) for i in kept)).schema.add("decoded", "binary")
    return encoded.mapInArrow(decoded, schema)
