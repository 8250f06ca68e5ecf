from types import SimpleNamespace

import pytest

from pricewright import staging


class Session:
    """Just what the folder lookup asks a session for."""

    def __init__(self, master, folder=None):
        self.conf = SimpleNamespace(get=lambda key, default=None: folder or default)
        self.sparkContext = SimpleNamespace(master=master, applicationId=f"app-{master}-{folder}")


def test_folder_is_the_named_one():
    assert staging.shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_without_a_named_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session("yarn"))


def test_local_mode_makes_its_own_folder_once():
    session = Session("local[2]")
    assert staging.shared_dir(session) == staging.shared_dir(session)


def test_stages_have_known_sizes_and_can_be_dropped(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "shared_dir", lambda _: str(tmp_path))
    small = staging.staged(spark.range(3).withColumnRenamed("id", "k"), "small")
    big = spark.range(100_000).withColumnRenamed("id", "k")
    plan = big.join(small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    staging.drop_stages(spark)
    assert not list(tmp_path.rglob("*.parquet"))


def test_spread_leaves_wide_tables_alone(spark):
    cores = spark.sparkContext.defaultParallelism
    assert staging.spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == cores
    wide = spark.range(0, 100, 1, cores * 2)
    assert staging.spread(wide) is wide
