import json

import pytest
from panel import make_panel, to_spark
from pyspark.sql import functions as F

from tidemark.plans import experiments, pipeline
from tidemark.sources import bars_csv
from tidemark.sources.tables import read_table

SIZES = {"AAA": 400, "BB-B": 260, "NEW": 44}


@pytest.fixture(scope="module")
def stored_table(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    bars = to_spark(spark, make_panel(SIZES))
    first = F.col("company") == "AAA"
    bars_csv.write_bars_csv(bars.where(first), str(root / "csv"))
    bars_csv.write_bars_csv(bars.where(~first), str(root / "csv"), "Price", ("close", "high", "low", "open", "volume"), "append")
    pipeline.ingest_bars(spark, str(root / "csv"), str(root / "prices"))
    day = str(bars.where(first).agg(F.max("dt")).first()[0])
    articles = [{"title": title, "publishedAt": f"{day}T0{i}:00:00Z"}
                for i, title in enumerate(["good", "good", "bad", None])]
    articles.append(dict(articles[0]))
    (root / "news").mkdir()
    (root / "news" / "a.json").write_text(json.dumps({"ticker": "AAA", "articles": articles}))
    pipeline.ingest_news(spark, str(root / "news"), str(root / "sentiment"))
    pipeline.build_features(spark, str(root / "prices"), str(root / "sentiment"), str(root / "master"))
    pipeline.build_features(spark, str(root / "prices"), str(root / "absent"), str(root / "plain"))
    return root


def test_pipeline_builds_the_feature_table(spark, stored_table):
    table = read_table(spark, str(stored_table / "master"))
    assert len(table.columns) == 60
    assert {r["Company"]: r["count"] for r in table.groupBy("Company").count().collect()} == {
        "AAA": 400 - 49, "BB-B": 260 - 49}
    scored = table.where("Sentiment <> 0").collect()
    # Three good articles (one of them a repeat), one bad, one without a title.
    assert [round(r["Sentiment"], 9) for r in scored] == [round((3 * 0.7 - 0.7) / 5, 9)]
    assert read_table(spark, str(stored_table / "plain")).where("Sentiment <> 0").count() == 0


def test_newest_articles_only(spark, stored_table):
    path = str(stored_table / "newest")
    pipeline.ingest_news(spark, str(stored_table / "news"), path, max_articles=1)
    assert [r.sentiment for r in read_table(spark, path).collect()] == [0.0]


def test_experiments_on_the_stored_table(spark, stored_table):
    table = experiments.canonical_names(read_table(spark, str(stored_table / "master")))
    logistic = experiments.logistic_experiment(table, ["AAA"]).toPandas()
    assert sorted(logistic["Model"]) == ["Logistic (No Sentiment)", "Logistic + Sentiment"]
    assert set(logistic["Company"]) == {"AAA"} and logistic["DA (%)"].between(0, 100).all()
    plain = experiments.sequence_experiment(table.drop("sentiment"), lookback=10, max_iter=2).toPandas()
    assert set(plain["Model"]) == {"Return Sequence (No Sentiment)"} and len(plain) == 2
    pooled = experiments.pooled_experiment(table).toPandas()
    assert pooled.columns.tolist() == ["Model", "Accuracy_%", "ROC_AUC", "F1_Score", "MCC"] and len(pooled) == 1
