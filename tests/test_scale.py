"""What one task holds and what is written must not outgrow the input."""

import os

import pytest
from pyspark.sql import functions as F

from catalog import base
from fixtures import views
from pricewright.session import PARTITION_BYTES, SETTINGS, input_bytes, tuned
from pricewright.staging import staged

SF = "/root/testdata/sf0.001"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def session(spark):
    yield spark
    spark.conf.unset(INITIAL)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_shuffle_begins_with_partitions_by_the_size_of_the_input(session):
    rows = session.range(10).groupBy((F.col("id") % 3).alias("k")).count()
    assert input_bytes(session, SF) > 100_000
    tuned(session, 50 * PARTITION_BYTES)
    assert ", 50)" in plan(rows.select("*"))
    tuned(session, 5000 * PARTITION_BYTES)
    assert ", 5000)" in plan(rows.select("*"))
    # a small input keeps what the session has
    tuned(session, 1)
    assert session.conf.get(INITIAL) == session.conf.get("spark.sql.shuffle.partitions")


def test_tasks_read_little_of_a_stage_table(session, tmp_path):
    rows = session.range(0, 6_000_000, 1, 1).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    assert SETTINGS["spark.sql.files.maxPartitionBytes"] == "16m"
    files = staged(rows, "little").inputFiles()
    assert len(files) == 1 and files[0].endswith(".zstd.parquet")
    held = session.read.parquet(files[0]).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held < 2_000_000


def test_line_items_are_dealt_by_order_before_customers_are_looked_up(session):
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = views._build_fares(session, SF)._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    at = next(i for i, line in enumerate(lines) if "Join" in line and "c_custkey" in line)
    under = []
    for line in lines[at + 1:]:
        if depth(line) <= depth(lines[at]):
            break
        under.append(line)
    assert under and not any("l_orderkey" in line for line in under)


def test_text_is_not_written_to_be_typed(session, tmp_path):
    path = str(tmp_path / "sf")
    os.symlink(SF, path)
    typed = base.typed_stage(session, path)
    assert (session.sparkContext.applicationId, path, "raw_fares") not in views._PATHS
    assert sorted(map(tuple, typed.collect()), key=str) == sorted(map(tuple, base.typed(session, path).collect()), key=str)
