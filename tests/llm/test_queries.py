"""The registered queries against their SQL, and the pipeline stage by stage."""

import duckdb
import pytest

import corpus_pipeline
from pricewright.llm import decontaminate, near_dup, queries
from pricewright.staging import staged
from tests.compare import canonical
from tests.llm.helpers import empty, messy

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, duck, key):
    ours, theirs = queries.QUERIES[key](spark, SF).toPandas(), duck.execute(queries.ORACLES[key]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, bench = docs.columns, spark.read.parquet(f"{SF}/benchmark.parquet")
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = staged(stage(spark, docs, SF), name)
        assert name == "mixing" or docs.columns == columns
    rules = {r["doc_id"] for r in queries.op5_quality_rules(spark, SF).where("kept").collect()}
    assert {r["doc_id"] for r in inputs["language_id"].collect()} == rules
    assert inputs["near_dup"].count() <= inputs["language_id"].count()
    classes = near_dup.near_duplicates(inputs["near_dup"]).where("kept")
    assert {r[0] for r in inputs["decontaminate"].select("doc_id").collect()} == {
        r[0] for r in classes.select("doc_id").collect()}
    assert decontaminate.contamination(inputs["mixing"], bench).where("contaminated").count() == 0
    assert docs.count() <= inputs["mixing"].count()
    assert docs.where("taken <= 0 OR taken > 2 * size").count() == 0


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "language_id", "near_dup", "decontaminate", "mixing"]


def test_stages_take_awkward_and_empty_tables(spark):
    for docs, rows in ((messy(spark), 11), (empty(spark), 0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert set(docs.columns) <= set(out.columns) and out.count() <= rows
