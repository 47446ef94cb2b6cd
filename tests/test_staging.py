import time
from pathlib import Path

from panel import make_panel, to_spark

from tidemark.plans import pipeline, staging
from tidemark.sources import bars_csv, published


def test_cache_is_keyed_by_plan_and_files(spark, tmp_path):
    path, cache = str(tmp_path / "rows"), staging.StageCache(spark, str(tmp_path / "cache"))
    spark.range(10).write.parquet(path)

    def build(n=5):
        return spark.read.parquet(path).where(f"id < {n}").withColumnRenamed("id", "x")

    assert sorted(r.x for r in cache.get(build()).collect()) == list(range(5)) and cache.written == 1
    assert cache.get(build()).count() == 5 and cache.written == 1
    assert cache.get(build(7)).count() == 7 and cache.written == 2
    time.sleep(1.1)
    spark.range(3).write.mode("append").parquet(path)
    assert cache.get(build()).count() == 8 and cache.written == 3
    old = staging.StageCache(spark, str(tmp_path / "cache"), seconds=0)
    assert old.get(build()).count() == 8 and old.written == 1
    cache.clear()
    assert not (tmp_path / "cache").exists()
    assert cache.get(build()).count() == 8 and cache.written == 4


def test_a_killed_writer_leaves_nothing_to_read(spark, tmp_path):
    cache = staging.StageCache(spark, str(tmp_path / "cache"))
    rows = spark.range(5)
    cache.get(rows, "rows")
    for mark in (tmp_path / "cache").rglob("_SUCCESS"):
        mark.unlink()
    assert cache.get(rows, "rows").count() == 5 and cache.written == 2


def test_scratch_is_empty_at_the_end(spark, tmp_path):
    outside = staging.stored(spark.range(3), "outside")
    with staging.scratch(spark):
        inside = staging.stored(spark.range(4), "inside")
        path = inside.inputFiles()[0]
        assert inside.count() == 4
    assert outside.count() == 3
    assert not Path(path.removeprefix("file://")).exists()


def test_second_build_writes_nothing(spark, tmp_path):
    bars = to_spark(spark, make_panel({"A": 120, "B": 90}))
    bars_csv.write_bars_csv(bars, str(tmp_path / "csv"))
    (tmp_path / "news").mkdir()
    (tmp_path / "news" / "a.json").write_text('{"ticker": "A", "articles": [{"title": "good", "publishedAt": "2015-03-01T00:00:00Z"}]}')
    out = str(tmp_path / "out")
    pipeline.run(spark, str(tmp_path / "csv"), str(tmp_path / "news"), out, reuse=True)
    features = f"{out}/features"
    assert published.versions(spark, features) == [1] and published.read_published(spark, features).count() == 71 + 41
    pipeline.build_features(spark, f"{out}/prices", f"{out}/sentiment", features, reuse=True)
    assert published.versions(spark, features) == [1]
    pipeline.ingest_bars(spark, str(tmp_path / "csv"), f"{out}/prices")
    pipeline.build_features(spark, f"{out}/prices", f"{out}/sentiment", features, reuse=True)
    assert published.versions(spark, features) == [1, 2]
