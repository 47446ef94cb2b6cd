import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import inspection


def test_only_new_files_are_read(spark, tmp_path):
    path, store = str(tmp_path / "table"), str(tmp_path / "profile")
    days = spark.range(30_000).selectExpr("concat('C', id % 700) AS company", "DATE'2020-01-01' + CAST(id % 900 AS INT) AS dt",
                                          "CASE WHEN id % 10 > 0 THEN id * 0.5D - 100 END AS close", "array(id) AS list", "id % 2 = 0 AS even")
    days.where("close IS NULL OR close < 9900").repartition(3).write.parquet(path)
    first = {r.column_name: r for r in inspection.profile_files(spark, path, store).collect()}
    assert inspection.files_to_read(spark, path, store) == 0
    exact = spark.read.parquet(path)
    assert first["close"].row_count == exact.count() and first["close"].missing == exact.where("close IS NULL").count()
    assert first["company"].file_count == 3 and first["list"].distinct_estimate in (0, None)
    # Another file: it is the only one that is read, and its bounds are in the profile.
    more = days.where("close >= 9900").coalesce(1)
    more.write.mode("append").parquet(path)
    assert inspection.files_to_read(spark, path, store) == 1
    stored = spark.read.parquet(store).count()
    grown = {r.column_name: r for r in inspection.profile_files(spark, path, store).collect()}
    assert spark.read.parquet(store).count() == stored + 5
    assert grown["close"].row_count == first["close"].row_count + more.count()
    assert float(grown["close"].high) == days.agg(F.max("close")).first()[0] and float(grown["close"].low) == -99.5
    assert (grown["dt"].low, grown["dt"].high) == ("2020-01-01", str(dt.date(2020, 1, 1) + dt.timedelta(days=899)))
    assert (grown["company"].low, grown["company"].high) == ("C0", "C99")
    for name, n in (("company", 700), ("dt", 900), ("even", 2)):
        assert abs(grown[name].distinct_estimate - n) <= 4 * inspection.STANDARD_ERROR * n + 0.5


def test_files_that_have_gone_drop_out(spark, tmp_path):
    path, store = str(tmp_path / "table"), str(tmp_path / "profile")
    for value in ("a", "b"):
        spark.createDataFrame([(value, 1), (None, 2)], "x string, y int").coalesce(1).write.mode("append").parquet(path)
    assert {r.column_name: r.row_count for r in inspection.profile_files(spark, path, store).collect()} == {"x": 4, "y": 4}
    gone = sorted((tmp_path / "table").glob("*.parquet"))[0]
    gone.unlink()
    left = {r.column_name: r for r in inspection.profile_files(spark, path, store).collect()}
    assert (left["x"].row_count, left["x"].missing, left["x"].distinct_estimate, left["y"].high) == (2, 1, 1, "2")
    with pytest.raises(Exception):
        inspection.profile_files(spark, str(tmp_path / "absent"), store)
