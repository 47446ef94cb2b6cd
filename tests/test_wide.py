import datetime as dt

import pytest
from panel import make_panel, to_spark
from pyspark.sql import functions as F

from tidemark.operators import wide
from tidemark.operators.clean import NUMERIC


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block", [1, 2, 500])
def test_there_and_back(spark, block):
    bars = to_spark(spark, make_panel({"A": 30, "B": 7, "C C": 1, "D": 30, "E": 4}))
    bars = bars.withColumn("volume", F.when(F.dayofmonth("dt") > 20, F.col("volume")))
    names = wide.dictionary(bars, block)
    table = wide.to_blocks(bars, names)
    assert table.columns == ["dt", "block", *NUMERIC]
    widths = {r["block"]: len(r["tickers"]) for r in names.collect()}
    assert sum(widths.values()) == 5
    for row in table.collect():
        assert {len(row[field]) for field in NUMERIC} == {widths[row["block"]]}
    assert rows_of(wide.from_blocks(table, names)) == rows_of(bars.select("company", "dt", *NUMERIC))
    few = wide.columns_of(table, names, ["E", "A"], ["close", "high"]).collect()
    assert few[0].asDict().keys() == {"dt", "E|Close", "E|High", "A|Close", "A|High"}
    got = {(t, r["dt"]): r[f"{t}|Close"] for r in few for t in "AE" if r[f"{t}|Close"] is not None}
    assert got == {(r["company"], r["dt"]): r["close"] for r in bars.where("company IN ('A', 'E')").collect()}


def test_twenty_thousand_tickers(spark):
    days = "DATE'2024-01-01' + CAST(id % 5 AS INT)"
    bars = spark.range(100_000).selectExpr("concat('T', id DIV 5) AS company", f"{days} AS dt", *(f"id * {i + 1}.0D AS {f}" for i, f in enumerate(NUMERIC)))
    names = wide.dictionary(bars)
    table = wide.to_blocks(bars, names)
    few = wide.dictionary(bars.where("company < 'T11'"))
    size = len(wide.to_blocks(bars, few)._jdf.queryExecution().optimizedPlan().toString())
    assert abs(len(table._jdf.queryExecution().optimizedPlan().toString()) - size) < 500
    assert table.count() == 5 * names.count() and names.count() > 30
    back = wide.from_blocks(table, names)
    same = back.exceptAll(bars.select("company", "dt", *NUMERIC))
    assert back.count() == 100_000 and same.isEmpty()


def test_odd_tables(spark):
    bars = to_spark(spark, make_panel({"A": 3, "B": 2}))
    names = wide.dictionary(bars)
    with pytest.raises(Exception, match="two bars"):
        wide.to_blocks(bars.union(bars.limit(1)), names).collect()
    with pytest.raises(ValueError, match="no such"):
        wide.columns_of(wide.to_blocks(bars, names), names, ["X"])
    nothing = bars.where("false")
    assert wide.to_blocks(nothing, wide.dictionary(nothing)).collect() == []
    unnamed = bars.union(spark.createDataFrame([(None, dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0), ("Z", dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0)], bars.schema))
    assert rows_of(wide.from_blocks(wide.to_blocks(unnamed, names), names)) == rows_of(bars.select("company", "dt", *NUMERIC))
