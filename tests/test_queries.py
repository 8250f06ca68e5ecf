"""Every registered query against its SQL, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as entry
import catalog
from tests.compare import canonical

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# long training runs, checked by their own tests
ROWS_ONLY = {"train_models", "retrain_flow"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_only_training_runs_lack_sql():
    assert set(catalog.queries()) - set(catalog.oracles()) == ROWS_ONLY
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(set(catalog.queries()) - ROWS_ONLY))
def test_query_agrees_with_sql(spark, duck, key):
    result = entry.queries()[key](spark, SF)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    ours, theirs = result.toPandas(), duck.execute(entry.oracle_sql()[key]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_entry_returns_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["Season", "median", "mean", "std", "count", "premium_pct"]
    assert result.count() == 4
