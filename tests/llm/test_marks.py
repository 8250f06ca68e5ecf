"""Marks reach rows by their place; no text is shuffled for them."""

import pytest
from pyspark.sql import functions as F

from pricewright.llm import marks, mixing, near_dup


@pytest.fixture
def without_broadcasts(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


@pytest.mark.parametrize("kept_as_files", [True, False])
def test_exactly_the_chosen_rows_are_marked(spark, tmp_path, kept_as_files):
    docs = spark.range(0, 150_000, 1, 3).select("id", F.concat(F.lit("t"), "id").alias("text"))
    docs = written(docs, tmp_path / "docs") if kept_as_files else docs
    rows = marks.placed(docs)
    chosen = rows.where("id % 7 = 3 OR id IN (0, 32767, 32768, 49999, 50000, 149999)")
    got = marks.with_mark(rows, chosen.select(*marks.PLACE), "hit")
    assert got.columns == ["id", "text", "hit"] and got.count() == 150_000
    assert got.where("hit != (id % 7 = 3 OR id IN (0, 32767, 32768, 49999, 50000, 149999))").isEmpty()
    assert marks.with_mark(rows, chosen.where("false").select(*marks.PLACE), "hit").where("hit").isEmpty()


def test_rows_of_other_plans_have_places_of_their_own(spark, tmp_path):
    docs = written(spark.range(10), tmp_path / "docs")
    for frame in (docs.crossJoin(spark.range(3).toDF("k")), docs.union(docs), docs.select("id", F.explode(F.array(F.lit(1), F.lit(2))))):
        assert marks.placed(frame).select(*marks.PLACE).distinct().count() == frame.count()


@pytest.mark.parametrize("step", [near_dup.keep_one, mixing.mixed])
def test_texts_stay_where_they_are(without_broadcasts, tmp_path, step):
    docs = written(without_broadcasts.range(400).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", *(F.pmod(F.col("id"), F.lit(200)) * k for k in range(1, 40))).alias("text"),
        F.concat(F.lit("s"), F.pmod(F.col("id"), F.lit(3))).alias("source")), tmp_path / "docs")
    done = step(docs)
    assert 100 < done.count() < 400
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
