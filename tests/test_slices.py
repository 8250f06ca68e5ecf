"""Steps that shuffle whole rows of a large table take it in slices, and leave no shuffle files behind."""

import os
import time
from pathlib import Path

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from catalog import base, cleaning
from fixtures import views
from pricewright import staging
from pricewright.operators import clean, ensembles
from pricewright.plans import clean_plan, train_plan
from pricewright.sources.tables import null_tokens
from pricewright.spec import AIRFARES as SPEC

SF = "/root/testdata/sf0.001"


@pytest.fixture
def pieces(monkeypatch):
    """The number of writes per stage table; tables of a few kB are large."""
    monkeypatch.setattr(staging, "SLICE_BYTES", 40_000)
    written, real = {}, staging.write_stage

    def counted(df, path, *mode):
        label = Path(path).name.rsplit("-", 1)[0]
        written[label] = written.get(label, 0) + 1
        real(df, path, *mode)

    monkeypatch.setattr(staging, "write_stage", counted)
    return written


def linked(tmp_path):
    path = str(tmp_path / "sf")
    os.symlink(SF, path)
    return path


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark):
    before, setting = shuffle_files(spark), spark.conf.get(staging._CLEANUP, None)
    kept = staging.staged(spark.range(100_000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert spark.conf.get(staging._CLEANUP, None) == setting
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and kept.count() == 7


def test_the_input_is_joined_in_slices(spark, tmp_path, pieces):
    path = linked(tmp_path)
    raw, typed = base.raw(spark, path), base.typed_stage(spark, path)
    assert pieces["raw_fares"] == pieces["typed"] > 1 and "fares" not in pieces
    assert rows(raw) == rows(base.raw(spark, SF))
    assert rows(typed) == rows(base.typed_stage(spark, SF))
    assert rows(base.fares(spark, path)) == rows(base.fares(spark, SF)) and pieces["fares"] > 1


def test_distinct_rows_of_a_large_table_are_found_in_slices(spark, tmp_path, pieces):
    path = linked(tmp_path)
    assert rows(base.unique(spark, path)) == rows(clean.drop_duplicates(clean.normalise_labels(base.in_range(spark, SF), SPEC)))
    assert pieces["unique"] > 1


@pytest.mark.parametrize("name, columns", [("impute_mode", 3), ("impute_fallback", 3)])
def test_imputing_a_large_table_writes_typed_and_distinct_rows_only(spark, tmp_path, pieces, name, columns):
    path = linked(tmp_path)
    found = cleaning.QUERIES[name](spark, path)
    assert set(pieces) == {"typed", "unique"} and min(pieces.values()) > 1
    assert len(found.columns) == columns and rows(found) == rows(cleaning.QUERIES[name](spark, SF))


def test_a_cleaning_run_takes_a_large_table_in_slices(spark, pieces):
    cleaned = clean_plan.clean_pipeline(null_tokens(base.raw(spark, SF)), SPEC)
    assert pieces["unique"] > 1 and cleaned.count() == cleaned.distinct().count()


def test_digests_of_a_large_table_are_compared_in_slices(spark, pieces):
    frame = staging.staged(base.in_range(spark, SF).unionByName(base.in_range(spark, SF)), "twice")
    found = clean.drop_duplicates_by_digest(frame)
    assert pieces["unique"] > 1 and rows(found) == rows(frame.dropDuplicates())
    numbers = staging.staged(spark.range(50_000).select((F.col("id") % 30_000).alias("a")), "numbers")
    assert clean.drop_duplicates_by_digest(numbers).count() == 30_000


def test_a_single_tree_shares_the_distinct_vectors(spark):
    table = spark.createDataFrame(
        [(Vectors.dense([float(i % 3)]), float(i % 5), i % 2, i) for i in range(600)], ["features", "label", "fold", "rid"])
    alone = train_plan._layout(["linear", "tree"], table, "rid")
    assert ensembles.is_folded(alone) and alone.count() == 6
    assert alone.agg(F.sum(ensembles.WEIGHT)).first()[0] == 600
    assert not ensembles.is_folded(train_plan._layout(["tree", "forest"], table, "rid"))
