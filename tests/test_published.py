import datetime as dt

import pytest
from panel import make_panel, to_spark
from pyspark.sql import functions as F

from tidemark.sources import published


@pytest.fixture()
def bars(spark):
    return to_spark(spark, make_panel({"A": 40, "B": 25}))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_a_table_may_be_replaced_by_rows_read_from_itself(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    assert published.publish(bars, path) == 1
    old = published.read_published(spark, path)
    assert rows_of(old) == rows_of(bars) and old.columns == bars.columns
    assert published.publish(old.where("company = 'A'").withColumn("close", F.col("close") * 2), path) == 2
    assert {r.company for r in published.read_published(spark, path).collect()} == {"A"}
    assert rows_of(published.read_published(spark, path, 1)) == rows_of(bars) == rows_of(old)
    assert published.clear_old(spark, path) == 1 and published.versions(spark, path) == [2]
    assert published.read_published(spark, path).count() == 40
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path, 1)


def test_what_fails_leaves_the_old_rows(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)
    published.publish(bars, path)
    folders = sorted(p.name for p in (tmp_path / "bars" / "data").iterdir())
    broken = bars.withColumn("close", F.when(F.col("company") == "B", F.raise_error("killed")).otherwise(F.col("close")).cast("double"))
    for wrong, reason in ((bars.union(bars.limit(1)), "duplicate key"), (bars.where("false"), "no rows"), (broken, "killed")):
        with pytest.raises(Exception, match=reason):
            published.publish(wrong, path)
    assert rows_of(published.read_published(spark, path)) == rows_of(bars)
    assert sorted(p.name for p in (tmp_path / "bars" / "data").iterdir()) == folders
    assert published.publish(bars.where("false"), path, allow_empty=True) == 2
    assert published.read_published(spark, path).collect() == []


def test_a_job_killed_before_the_manifest(spark, bars, tmp_path, monkeypatch):
    path = str(tmp_path / "bars")
    published.publish(bars, path)
    # What is left of a killed writer: rows without a manifest.
    bars.write.parquet(f"{path}/data/orphan")
    assert rows_of(published.read_published(spark, path)) == rows_of(bars)
    assert published.clear_old(spark, path) == 1
    # Another writer publishes while this one writes.
    real = published._written

    def slow(*args):
        found = real(*args)
        monkeypatch.setattr(published, "_written", real)
        published.publish(bars.where("company = 'B'"), path)
        return found

    monkeypatch.setattr(published, "_written", slow)
    with pytest.raises(RuntimeError, match="meanwhile"):
        published.publish(bars.where("company = 'A'"), path)
    assert {r.company for r in published.read_published(spark, path).collect()} == {"B"}


def test_single_partitions_are_replaced(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    bars = bars.withColumn("name", F.when(F.col("company") == "A", "a b/c"))
    published.publish(bars, path, partition_by="name")
    before = published.manifest(spark, path)["folders"]
    assert len(before) == 2 and rows_of(published.read_published(spark, path)) == rows_of(bars)
    changed = bars.where("company = 'A'").withColumn("volume", F.lit(1.0)).limit(3)
    published.publish(changed, path, partition_by="name", replace=False)
    after = published.manifest(spark, path)["folders"]
    assert sum(before[name] != after[name] for name in before) == 1
    assert rows_of(published.read_published(spark, path)) == rows_of(changed.union(bars.where("company = 'B'")))
    assert published.clear_old(spark, path) == 1
    assert published.read_published(spark, path).count() == 3 + 25
    with pytest.raises(ValueError, match="one by one"):
        published.publish(bars, path, replace=False)
    assert isinstance(published.read_published(spark, path).first()["dt"], dt.date)
