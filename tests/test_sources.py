import datetime as dt
import json

import pytest
from panel import make_panel, to_spark
from pyspark.sql import functions as F

from tidemark.functions.cleaning import to_number
from tidemark.operators import clean, profile, reshape, sentiment, windows
from tidemark.plans.features import merge_prices_and_sentiment
from tidemark.sources import bars_csv, tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture()
def mixed_folder(tmp_path):
    folder = tmp_path / "csv"
    write(folder / "AAA.csv", "Price,Close,High,Low,Open,Volume\nTicker,AAA,AAA,AAA,AAA,AAA\nDate,,,,,\n"
          "2025-02-13,36.0,44.0,34.99,35.06,369100\n2025-02-14,37.5,38.0,36.0,36.5,1000\n")
    write(folder / "B B.csv", " Date ,Open,High,Low,Close ,Volume\n2025-02-13,1.5,2.5,0.5,2.0,10\n"
          'broken,1,1,1,1,1\n2025-02-14,"$1,275.5",₹ 12,n/a,"1,300",\n2025-02-15,1,1,1,,5\n')
    write(folder / "CC.csv", "Volume,Datetime,Close\n7,2025-02-13 00:00:00,3.25\n")
    return str(folder)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_layouts_are_read_by_name(spark, mixed_folder):
    day = dt.date
    assert rows_of(bars_csv.read_bars_csv(spark, mixed_folder)) == [
        ("AAA", day(2025, 2, 13), 35.06, 44.0, 34.99, 36.0, 369100.0),
        ("AAA", day(2025, 2, 14), 36.5, 38.0, 36.0, 37.5, 1000.0),
        ("B B", day(2025, 2, 13), 1.5, 2.5, 0.5, 2.0, 10.0),
        ("B B", day(2025, 2, 14), 1275.5, 12.0, None, 1300.0, None),
        ("CC", day(2025, 2, 13), None, None, None, 3.25, 7.0),
    ]


def test_csv_with_known_columns_needs_no_header_scan(spark, tmp_path):
    write(tmp_path / "AAA.csv", "Date,Open,High,Low,Close,Volume\n2025-02-13,1,2,0.5,1.5,9\n")
    df = bars_csv.read_bars_csv(spark, str(tmp_path), ["Date", "Open", "High", "Low", "Close", "Volume"])
    assert rows_of(df) == [("AAA", dt.date(2025, 2, 13), 1.0, 2.0, 0.5, 1.5, 9.0)]
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_csv_round_trip(spark, tmp_path):
    bars = to_spark(spark, make_panel({"A": 5, "B C": 7}))
    bars_csv.write_bars_csv(bars, str(tmp_path / "out"))
    assert rows_of(bars_csv.read_bars_csv(spark, str(tmp_path / "out"))) == rows_of(bars)


def test_clean_bars_picks_and_coerces(spark):
    raw = spark.createDataFrame(
        [("A", "2020-01-02", " $1,275,800 ", "5"), ("A", "junk", "1", "1"), ("A", "2020-01-03", "n/a", "1")],
        "` ticker ` STRING, `Price` STRING, `Close ` STRING, `Volume` STRING")
    assert rows_of(clean.clean_bars(raw)) == [("A", dt.date(2020, 1, 2), 1275800.0, 5.0)]
    with pytest.raises(ValueError, match="date"):
        clean.clean_bars(raw.drop("Price"))


def test_numbers_and_tickers(spark):
    df = spark.createDataFrame([("1,275,800",), ("$49.8",), ("₹12",), ("n/a",), ("NaN",), ("",), (None,)], "x STRING")
    assert [r[0] for r in df.select(to_number(F.col("x"))).collect()] == [1275800.0, 49.8, 12.0] + [None] * 4
    paths = {"/d/SNDK.csv": "SNDK", "/d/BRK.B.csv/part-0.csv": "BRK.B", "/d/file=A%20B.csv/part-0.csv": "A B",
             "/d/all.csv/Q.csv": "Q"}
    df = spark.createDataFrame(list(paths.items()), "path STRING, ticker STRING")
    assert df.where(bars_csv.ticker_from_path(F.col("path")) == F.col("ticker")).count() == len(paths)


def test_duplicate_keys_fail_loudly(spark):
    bars = to_spark(spark, make_panel({"A": 5}))
    assert clean.require_unique(bars).count() == 5
    with pytest.raises(Exception, match="duplicate key"):
        clean.require_unique(bars.union(bars.limit(1))).collect()


def test_wide_and_long(spark):
    bars = to_spark(spark, make_panel({"A": 6, "B.X": 8}))
    wide = reshape.to_wide(bars)
    assert set(wide.columns) > {"dt", "A|Open", "B.X|Volume"}
    long = reshape.to_long(wide)
    expected = bars.select(F.col("dt").cast("string").alias("date"), F.col("company").alias("ticker"),
                           "open", "high", "low", "close", "volume")
    assert rows_of(long) == rows_of(expected)
    assert {r[0] for r in reshape.to_long(wide.drop("A|High")).select("ticker").collect()} == {"B.X"}
    with pytest.raises(ValueError):
        reshape.to_long(wide.select("dt", "`A|High`"))
    assert reshape.flat_names([("Open", "X"), "Date"]) == ["open", "date"]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 3)], "a INT, b INT, c INT")
    assert clean.drop_empty_columns(df).columns == ["a", "c"]


def test_articles(spark, tmp_path):
    response = {"ticker": "A", "articles": [
        {"title": "Good", "publishedAt": "2024-05-01T10:00:00Z", "language": "en"},
        {"title": None, "publishedAt": None}, {"publishedAt": "bad"}]}
    write(tmp_path / "a.json", json.dumps(response) + "\n" + json.dumps({"ticker": "B", "articles": []}))
    rows = tables.read_articles(spark, str(tmp_path)).collect()
    assert sorted((r.ticker, r.title) for r in rows if r.title) == [("A", "Good")]
    assert len(rows) == 3 and sum(r.published_at is None for r in rows) == 2
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        times = {r.published_at for r in tables.read_articles(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert times == {None, dt.datetime(2024, 5, 1, 10, 0)}


def test_optional_and_small_tables(spark, tmp_path):
    assert tables.read_optional(spark, str(tmp_path / "none")) is None
    bars = to_spark(spark, make_panel({"A": 3}))
    assert set(r.sentiment for r in sentiment.join_sentiment(bars, None).collect()) == {0.0}
    write(tmp_path / "fi.csv", "feature,score,selected\nrsi,82.0,True\nbb,1.5,False\n")
    assert rows_of(tables.read_importance(spark, str(tmp_path / "fi.csv"))) == [
        ("bb", 1.5, False), ("rsi", 82.0, True)]
    write(tmp_path / "names.csv", "Symbol,Security\nBRK.B,Berkshire\n")
    assert rows_of(tables.read_companies(spark, str(tmp_path / "names.csv"))) == [("BRK-B", "Berkshire")]


def test_sinks(spark, tmp_path):
    bars = to_spark(spark, make_panel({"A": 30, "B": 20}))
    path = str(tmp_path / "new" / "bars")
    assert not tables.write_table(bars.limit(0), path, skip_empty=True)
    assert tables.write_table(bars, path, ["company"])
    assert tables.write_table(bars, path, skip_empty=True, by_range=True)
    assert rows_of(tables.read_table(spark, path, bars.columns)) == rows_of(bars)
    recent = tables.history(tables.read_table(spark, path), "5d", dt.date(2015, 2, 1))
    assert "GreaterThanOrEqual(dt,2015-01-27)" in recent._jdf.queryExecution().executedPlan().toString()


def test_periods(spark):
    bars = to_spark(spark, make_panel({"A": 900}))
    end = dt.date(2018, 1, 1)
    for period, start in {"1y": dt.date(2017, 1, 1), "6mo": dt.date(2017, 7, 1), "5d": dt.date(2017, 12, 27)}.items():
        got = tables.history(bars, period, end)
        assert rows_of(got) == rows_of(bars.where(F.col("dt") >= F.lit(start)))
    assert tables.history(bars, "max").count() == 900
    with pytest.raises(ValueError):
        tables.history(bars, "soon")


def test_trailing_windows_use_each_companys_own_end(spark):
    panel = make_panel({"A": 200, "B": 100})
    bars = to_spark(spark, panel)
    expected = sum((rows.dt >= rows.dt.max() - dt.timedelta(days=90)).sum() for _, rows in panel.groupby("company"))
    assert windows.recent_days(bars, 90).count() == expected
    newest = {r.company: r.dt for r in windows.newest_row(bars).collect()}
    assert newest == panel.groupby("company").dt.max().to_dict()


def test_merged_table_and_profile(spark):
    bars = to_spark(spark, make_panel({"A": 4}))
    daily = bars.limit(1).select(F.col("company").alias("ticker"), F.col("dt").cast("timestamp").alias("date"),
                                 F.lit(0.5).alias("sentiment"))
    merged = merge_prices_and_sentiment(bars, daily)
    assert merged.columns == ["ticker", "date", "open", "high", "low", "close", "volume", "daily_sentiment"]
    assert sorted(r.daily_sentiment for r in merged.collect()) == [0.0, 0.0, 0.0, 0.5]
    rows = {r.column_name: r for r in profile.profile_table(bars, "bars", "company", approximate=True).collect()}
    assert rows["close"].row_count == 4 and rows["close"].missing == 0 and rows["dt"].distinct_keys == 1


def test_wide_files_and_other_dates_are_read(spark, tmp_path):
    folder = tmp_path / "wide"
    folder.mkdir()
    names = ["Date", *(f"Extra{i}" for i in range(18)), "Close"]
    rows = [["12/31/2024", *["1"] * 18, '"1,000.5"'], ['"Jan 5, 2025"', *["1"] * 18, "2"], ["2025-01-06", *["1"] * 18, "1.0d"]]
    (folder / "WIDE.csv").write_text("\n".join(",".join(r) for r in [names, *rows]) + "\n")
    (folder / "THREE.csv").write_text("Price,Close,Open\nTicker,THREE,THREE\nDate,,\n2025-01-07,3,4\n")
    got = sorted((r.company, str(r.dt), r.close) for r in bars_csv.read_bars_csv(spark, str(folder)).collect())
    assert got == [("THREE", "2025-01-07", 3.0), ("WIDE", "2024-12-31", 1000.5), ("WIDE", "2025-01-05", 2.0)]
    (folder / "BAD.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="no header with a date and a close"):
        bars_csv.read_bars_csv(spark, str(folder)).collect()


def test_writing_twice_replaces_and_files_are_bounded(spark, tmp_path):
    bars = spark.range(3000).selectExpr(
        "concat('T', id % 3) AS company", "date_add(DATE'2022-01-01', cast(id div 3 as int)) AS dt", "1.0D AS open", "1.0D AS high",
        "1.0D AS low", "1.0D AS close", "1.0D AS volume").repartition(8)
    for _ in range(2):
        bars_csv.write_bars_csv(bars, str(tmp_path / "out"))
    assert bars_csv.read_bars_csv(spark, str(tmp_path / "out")).count() == 3000
    assert all(len(list(d.glob("*.csv"))) <= 3 for d in (tmp_path / "out").glob("file=*"))


def test_article_times_do_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([("A", [("t", "2024-03-10T02:30:00Z", "en"), ("u", "2024-11-03T01:30:00-05:00", "en"), ("v", None, "en")])],
                                 "ticker string, articles array<struct<title: string, publishedAt: string, language: string>>")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = {r.title: str(r.published_at) for r in tables.flatten_articles(rows).collect()}
            assert got == {"t": "2024-03-10 02:30:00", "u": "2024-11-03 06:30:00", "v": "None"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_one_field_is_named_like_many(spark):
    bars = spark.createDataFrame([("A_Close", "2024-01-01", 1.0, 2.0), ("B", "2024-01-01", 3.0, 4.0)], "company string, dt string, open double, close double")
    assert reshape.to_wide(bars, fields=["close"]).columns == ["dt", "A_Close|Close", "B|Close"]
    assert reshape.to_wide(bars, fields=["open", "close"]).columns == ["dt", "A_Close|Open", "A_Close|Close", "B|Open", "B|Close"]


def test_tables_that_cannot_be_opened_are_reported(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not parquet")
    rows = {r.table_name: r for r in profile.profile_paths(
        spark, {n: str(tmp_path / n) for n in ("good", "bad", "none")}).collect()}
    assert (rows["good"].row_count, rows["good"].error) == (3, None)
    assert rows["bad"].error and rows["none"].error == "PATH_NOT_FOUND"


def test_stored_tables_are_cleared(spark, tmp_path):
    from tidemark.plans import staging
    kept = dict(staging._written)
    staging._written.clear()
    table = staging.stored(spark.range(5), "numbers")
    (file, *_) = table.inputFiles()
    assert table.count() == 5 and staging.clear_stored(spark) == 1
    from pathlib import Path
    from urllib.parse import urlparse
    assert not Path(urlparse(file).path).exists() and staging.clear_stored(spark) == 0
    staging._written.update(kept)
