"""Wide tables of any number of tickers, as blocks of columns.

A wide table with one column per ticker and field outgrows a plan: 20,000 tickers of five fields are
100,000 expressions. Here tickers are dealt into blocks. A row of the table is one day of one block, with
one array per field, and a dictionary says which ticker stands where. Plans hold one expression per
field, however many tickers there are; a ticker's series reads its block only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.clean import NUMERIC
from tidemark.plans.staging import broadcast_if_small, stored

BLOCK = 500


def dictionary(bars: DataFrame, block: int = BLOCK, key: str = "company") -> DataFrame:
    """block INT and tickers ARRAY<STRING>, in the order of their places: the distinct keys, dealt by a hash."""
    found = bars.where(F.col(key).isNotNull()).select(F.col(key).alias("ticker")).distinct()
    found = stored(found, "tickers")
    blocks = max(1, -(-found.count() // block))
    dealt = found.select(F.pmod(F.xxhash64("ticker"), F.lit(blocks)).cast("int").alias("block"), "ticker")
    return stored(dealt.groupBy("block").agg(F.sort_array(F.collect_list("ticker")).alias("tickers")), "dictionary")


def _filled(cells: Column, width: Column) -> Column:
    """Cells, sorted by ``place``, with a NULL at each place that none of them holds."""
    def gap(cell: Column, at: Column) -> Column:
        before = F.when(at == 0, F.lit(-1)).otherwise(F.get(cells, at - 1)["place"])
        empty = F.array_repeat(F.when(F.lit(False), cell), (cell["place"] - before - 1).cast("int"))
        return F.concat(empty, F.array(cell))

    last = F.get(cells, F.size(cells) - 1)
    rest = F.array_repeat(F.when(F.lit(False), last), (width - last["place"] - 1).cast("int"))
    return F.concat(F.flatten(F.transform(cells, gap)), rest)


def to_blocks(bars: DataFrame, names: DataFrame, fields: Sequence[str] = NUMERIC, order: str = "dt", key: str = "company") -> DataFrame:
    """``order``, block and one array per field, with a place for every ticker of the block: one row per day and block.

    All series are aligned on the day; where a ticker has no bar its place holds NULL. ``names`` is the
    ``dictionary``. Two bars of one ticker and day fail the job, bars of unnamed tickers are left out.
    """
    places = names.select("block", F.size("tickers").alias("width"), F.posexplode("tickers").alias("place", "ticker"))
    joined = bars.join(broadcast_if_small(places), bars[key] == places["ticker"])
    cell = F.struct("place", *fields)
    days = joined.groupBy(order, "block").agg(F.sort_array(F.collect_list(cell)).alias("cells"), F.first("width").alias("width"))
    twice = F.size(F.array_distinct("cells.place")) < F.size("cells")
    message = F.concat(F.lit("two bars of one ticker on "), F.col(order).cast("string"))
    fine = F.when(twice, F.raise_error(message).cast("boolean")).otherwise(True)
    filled = days.where(fine).select(order, "block", _filled(F.col("cells"), F.col("width")).alias("cells"))
    return filled.select(order, "block", *(F.col(f"cells.{field}").alias(field) for field in fields))


def from_blocks(table: DataFrame, names: DataFrame, fields: Sequence[str] = NUMERIC, order: str = "dt", key: str = "company") -> DataFrame:
    """The long bars again: ``key``, ``order`` and the fields of every place that holds any value."""
    joined = table.join(broadcast_if_small(names, 10_000), "block")
    cells = joined.select(order, F.inline(F.arrays_zip(F.col("tickers").alias(key), *fields)))
    return cells.select(key, order, *fields).dropna(how="all", subset=list(fields))


def columns_of(table: DataFrame, names: DataFrame, tickers: Sequence[str], fields: Sequence[str] = ("close",), order: str = "dt") -> DataFrame:
    """``order`` and a column ``TICKER|Field`` for each of a few tickers, over the days on which any of them has a bar.

    Only the blocks of these tickers are read. Unknown tickers fail.
    """
    wanted = names.select("block", F.posexplode("tickers").alias("place", "ticker")).where(F.col("ticker").isin(list(tickers)))
    found = {row["ticker"]: (row["block"], row["place"]) for row in wanted.collect()}
    if missing := [name for name in tickers if name not in found]:
        raise ValueError(f"no such tickers: {missing}")
    rows = table.where(F.col("block").isin(sorted({block for block, _ in found.values()})))
    cells = [F.max(F.when(F.col("block") == found[t][0], F.get(field, F.lit(found[t][1])))).alias(f"{t}|{field.capitalize()}")
             for t in tickers for field in fields]
    return rows.groupBy(order).agg(*cells).dropna(how="all", subset=[f"`{t}|{f.capitalize()}`" for t in tickers for f in fields])

