"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload import oracles, registry

SF_DIR = entry_point.SMOKE_DIR
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")
QUERIES, ORACLES = registry.all_queries(), oracles.all_oracles()
WITHOUT_SQL = {"logistic_baseline", "sequence_regressor", "sequence_classifier", "score_latest"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def test_only_model_training_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    actual = sorted(tuple(text(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    expected = sorted(tuple(text(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert actual == expected


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_models_give_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert len(entry_point.entry(spark).columns) == 60
