"""Texts as blocks of word codes, so that work on words is done once per distinct word.

A block is a run of documents of one input partition, closed after ``block_bytes``. Inside a block
every distinct word has a code, and a document is the list of its codes in text order. ``words``
gives the blocks' dictionaries, cut into parts by a hash: a shuffle by part brings equal words of
all blocks together. ``answers`` computes something once for each distinct word of a part and sends
it back to the blocks by a second shuffle, where ``codes`` has the documents. The texts themselves
are never shuffled, and a word that stands in every document costs one entry per block.

``words`` and ``codes`` both read the documents, so these must give the same rows in the same
partitions each time, as a scan of files does; store anything else first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

BLOCK_BYTES = 8_000_000
# Documents of a block that are put together at a time.
SLICE = 200

# A space before further white space or the end: there a word's split depends on its neighbours.
OPEN_SPACE = (r" (?:[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
              r"|\z)")

Pieces = Callable[[str], list[str]]


def gathered(flat: np.ndarray, sizes: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """The lists number ``picked``, one after the other, out of lists that lie in ``flat``."""
    starts, lengths = np.cumsum(sizes) - sizes, sizes[picked].astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[picked] - ends + lengths, lengths) + np.arange(total)]


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of values, of the given lengths."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def packed(values: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed bytes."""
    raw = values.astype("<u4").tobytes()
    return pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def unpacked(data: bytes, count: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True) if count else b""
    return np.frombuffer(raw, "<u4")


def _units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units of a block, each text's number of units, and the units of all texts in order.

    A unit is a run up to a space, headed by that space if it is not a text's first. A text with an
    open space is one unit.
    """
    open_space = pc.match_substring_regex(texts, OPEN_SPACE).to_numpy(zero_copy_only=False)
    closed = texts.filter(pa.array(~open_space))
    cut = pc.split_pattern(closed, " ")
    sizes = np.ones(len(texts), np.int64)
    sizes[~open_space] = pc.list_value_length(cut).to_numpy(zero_copy_only=False)
    found = cut.flatten().dictionary_encode()
    # Even numbers are units at a text's head, odd ones stand behind a space.
    number = found.indices.to_numpy().astype(np.int64) * 2 + 1
    number[np.cumsum(sizes[~open_space]) - sizes[~open_space]] -= 1
    seen = np.bincount(number) > 0
    used, order = np.flatnonzero(seen), (np.cumsum(seen) - 1)[number]
    words = found.dictionary.take(pa.array(used // 2)).to_pylist()
    units = [" " + word if odd else word for word, odd in zip(words, (used % 2).tolist())]
    if not open_space.any():
        return units, sizes, order
    at = np.empty(int(sizes.sum()), np.int64)
    whole = np.repeat(open_space, sizes)
    at[~whole], at[whole] = order, len(units) + np.arange(int(open_space.sum()))
    return units + texts.filter(pa.array(open_space)).to_pylist(), sizes, at


def _block(texts: pa.Array, pieces: Pieces, parts: int, prefix: int | None):
    """The block's words ordered by part, the parts of them, and the codes of all texts with each text's number."""
    units, sizes, order = _units(texts)
    cut = list(map(pieces, units))
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    found = pa.array(list(chain.from_iterable(cut)), pa.string()).dictionary_encode()
    words, flat = found.dictionary, found.indices.to_numpy()
    heads = words if prefix is None else pc.utf8_slice_codeunits(words, 0, prefix)
    part = (pd.util.hash_array(heads.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(parts)).astype(np.int64)
    by_part = np.argsort(part, kind="stable")
    code = np.empty(len(words), np.int64)
    code[by_part] = np.arange(len(words))
    return words.take(pa.array(by_part)), part[by_part], gathered(code[flat], lengths, order), sums(lengths[order], sizes)


def _blocks(batches, block_bytes: int) -> Iterator[tuple[str, pa.Array, pa.Array]]:
    """(block name, ids, texts) of one partition; a null text is an empty one."""
    task, number, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0
    for batch in batches:
        text = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False))
        start = 0
        while start < len(text):
            before = int(ends[start - 1]) if start else 0
            stop = min(len(text), int(np.searchsorted(ends, before + block_bytes - size)) + 1)
            ids.append(batch.column(0).slice(start, stop - start))
            texts.append(text.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= block_bytes:
                yield f"{task}-{number}", pa.concat_arrays(ids), pa.concat_arrays(texts)
                number, ids, texts, size = number + 1, [], [], 0
    if ids:
        yield f"{task}-{number}", pa.concat_arrays(ids), pa.concat_arrays(texts)
    # A worker is kept for later tasks; what Arrow holds for this one is given back.
    pa.default_memory_pool().release_unused()


def part_count(spark) -> int:
    """Parts of a block's dictionary: as many as a shuffle has partitions, which grow with the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words(docs: DataFrame, pieces: Pieces, text: str, parts: int, prefix: int | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, part, start (code of the part's first word), n, words: one row per block and part.

    With ``prefix`` words that share so many leading characters are in the same part.
    """

    def rows(batches):
        for name, _, texts in _blocks(batches, block_bytes):
            found, part, _, _ = _block(texts, pieces, parts, prefix)
            number, start, count = np.unique(part, return_index=True, return_counts=True)
            data, total = [], []
            for at, n in zip(start.tolist(), count.tolist()):
                some = found.slice(at, n)
                body = "".join(some.to_pylist()).encode()
                whole = np.concatenate([pc.binary_length(some).to_numpy(zero_copy_only=False),
                                        np.frombuffer(body.ljust(-(-len(body) // 4) * 4), "<u4")])
                data.append(packed(whole))
                total.append(len(whole))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(number), pa.string()), pa.array(number, pa.int32()), pa.array(start, pa.int32()),
                 pa.array(count, pa.int32()), pa.array(total, pa.int32()), pa.array(data, pa.binary())],
                ["block", "part", "start", "n", "size", "words"])

    read = docs.select(F.lit(None).cast("long").alias("id"), F.col(text).alias("text"))
    return read.mapInArrow(rows, "block string, part int, start int, n int, size int, words binary")


def _listed(data: bytes, n: int, size: int) -> pa.Array:
    """The words of one row of ``words``."""
    whole = unpacked(data, size)
    offsets = np.concatenate([[0], np.cumsum(whole[:n])]).astype(np.int32)
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets.tobytes()), pa.py_buffer(whole[n:].tobytes()))


def answers(found: DataFrame, answer: Callable[[list[str]], list[list[int]]], parts: int) -> DataFrame:
    """block, start, n, size, data: the answers to every word, asked once for each distinct word of a part.

    ``answer`` gets a part's distinct words in order and returns a list of numbers for each.
    """

    def rows(batches):
        known = [(row["block"], row["start"], row["n"], _listed(row["words"], row["n"], row["size"]))
                 for batch in batches for row in batch.to_pylist()]
        if not known:
            return
        coded = pa.concat_arrays([row[-1] for row in known]).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        order = sorted(range(len(distinct)), key=distinct.__getitem__)
        lists: list = [None] * len(distinct)
        for at, numbers in zip(order, answer([distinct[at] for at in order])):
            lists[at] = numbers
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((x for numbers in lists for x in numbers), np.int64, int(sizes.sum()))
        indices, at = coded.indices.to_numpy(), 0
        for block, start, n, _ in known:
            picked = indices[at:at + n]
            at += n
            whole = np.concatenate([sizes[picked], gathered(flat, sizes, picked)])
            yield pa.RecordBatch.from_pylist(
                [{"block": block, "start": start, "n": n, "size": len(whole), "data": packed(whole)}], schema)

    schema = pa.schema([("block", pa.string()), ("start", pa.int32()), ("n", pa.int32()), ("size", pa.int32()), ("data", pa.binary())])
    return found.repartition(parts, "part").mapInArrow(rows, "block string, start int, n int, size int, data binary")


def codes(docs: DataFrame, pieces: Pieces, key: str, text: str, parts: int, prefix: int | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, id (the key column), n, codes: each document's words in text order, with the arguments of ``words``."""

    def rows(batches):
        for name, ids, texts in _blocks(batches, block_bytes):
            _, _, found, counts = _block(texts, pieces, parts, prefix)
            ends = np.cumsum(counts)
            data = [packed(found[end - n:end]) for end, n in zip(ends.tolist(), counts.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(ids), pa.string()), ids, pa.array(counts, pa.int32()),
                 pa.array(data, pa.binary())], ["block", "id", "n", "codes"])

    read = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return read.mapInArrow(rows, "block string, id long, n int, codes binary")


def assembled(coded: DataFrame, known: DataFrame, build: Callable[[pa.Table, np.ndarray, np.ndarray, np.ndarray], pa.Table],
              schema: str) -> DataFrame:
    """``build`` (some documents of a block, their codes in order, and the answers as sizes and flat numbers) for all."""

    def joined(texts: pa.Table, table: pa.Table) -> pa.Table:
        sizes, flat = [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        for row in sorted(table.to_pylist(), key=lambda r: r["start"]):
            whole = unpacked(row["data"], row["size"]).view(np.int32)
            sizes.append(whole[:row["n"]])
            flat.append(whole[row["n"]:])
        sizes, flat = np.concatenate(sizes), np.concatenate(flat)

        def built(some: pa.Table) -> pa.Table:
            codes = [unpacked(data, n) for n, data in zip(some["n"].to_pylist(), some["codes"].to_pylist())]
            return build(some, np.concatenate(codes), sizes, flat)

        whole = pa.concat_tables([built(texts.slice(at, SLICE)) for at in range(0, texts.num_rows, SLICE)])
        pa.default_memory_pool().release_unused()
        return whole

    return coded.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(joined, schema)
