import datetime as dt
from dataclasses import replace

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricewright.operators import explore, features
from pricewright.spec import AIRFARES, TableSpec

SPEC = TableSpec(categorical=("c",), numeric=("v", "k"), target="v", test_share=0.2, seed=42)


def arrays(df, model):
    return [r["f"] for r in features.encode(df, model).select(vector_to_array("features").alias("f")).collect()]


def test_derived_columns(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), " DIRECT ", "A", "B"), (dt.datetime(2024, 12, 29), None, "A", None),
         (None, "1 Stop", "A", "B")],
        "Date timestamp_ntz, Stop_Raw string, Source string, Destination string")
    rows = features.derive_features(df, AIRFARES).collect()
    assert [(r["Month"], r["Weekday"]) for r in rows] == [(1, 0), (12, 6), (None, None)]
    assert [r["Stop_Type"] for r in rows] == ["Non_Stop", "With_Stop", "With_Stop"]
    assert [r["Route"] for r in rows] == ["A→B", None, "A→B"]


def test_scaler_uses_population_deviation_of_training_rows(spark):
    train = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "v double, k double")
    out = features.standard_scale(train, spark.createDataFrame([(5.0, 7.0)], "v double, k double"), ["v", "k"]).first()
    assert (out["v_z"], out["k_z"]) == (3.0, 0.0)


def test_unseen_and_null_labels_encode_to_zeros_of_full_width(spark):
    train = spark.createDataFrame([("b", 1.0, 1.0), ("a", 2.0, 1.0)], "c string, v double, k double")
    model = features.preprocess(train, SPEC)
    assert features.feature_names(model) == ["v", "k", "c_a", "c_b"]
    other = spark.createDataFrame([("a", 1.5, 1.0), ("z", 1.5, 1.0), (None, 1.5, 1.0)], "c string, v double, k double")
    assert arrays(other, model) == [[0, 0, 1, 0], [0, 0, 0, 0], [0, 0, 0, 0]]


def test_preprocessor_is_fitted_on_training_rows_only(spark):
    train = spark.createDataFrame([("b", 1.0, 1.0), ("a", 2.0, 4.0)], "c string, v double, k double")
    tests = [spark.createDataFrame([row], "c string, v double, k double") for row in (("a", 9.0, 9.0), ("q", -5.0, 0.0))]
    probe = spark.createDataFrame([("b", 3.0, 2.0)], "c string, v double, k double")
    results = []
    for test in tests:
        frame = train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))
        results.append(arrays(probe, features.preprocess(frame.filter("NOT is_test"), SPEC)))
    assert results[0] == results[1]


def test_reduced_feature_sets_work(spark):
    train = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    model = features.preprocess(train, SPEC)
    assert features.feature_names(model) == ["v"]


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5_000)
    a = features.train_test_split(df.repartition(3), SPEC, "id").orderBy("id").collect()
    b = features.train_test_split(df.repartition(17), SPEC, "id").orderBy("id").collect()
    assert a == b
    share = sum(r["is_test"] for r in a) / len(a)
    assert abs(share - 0.2) < 0.02
    other = features.train_test_split(df, replace(SPEC, seed=7), "id").orderBy("id").collect()
    assert [r["is_test"] for r in other] != [r["is_test"] for r in a]


def test_content_key_sends_copies_to_one_side(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(2, "b")] * 50, "a int, b string")
    keyed = features.train_test_split(features.row_key(df), SPEC, "row_key")
    assert keyed.select("a", "is_test", "fold").distinct().count() == 2


def test_histogram_matches_numpy(spark):
    np = pytest.importorskip("numpy")
    values = np.random.default_rng(5).gamma(2, 3, 5_000)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    counts, edges = np.histogram(values, bins=60)
    rows = explore.histogram(df, "v").orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(counts)
    np.testing.assert_allclose([r["bin_start"] for r in rows], edges[:-1], rtol=1e-9)


def test_histogram_of_a_constant(spark):
    rows = explore.histogram(spark.createDataFrame([(4.0,)] * 3, "v double"), "v", 10).collect()
    assert sum(r["count"] for r in rows) == 3
    assert min(r["bin_start"] for r in rows) == 3.5


def test_density_matches_brute_force(spark):
    import numpy as np
    values = np.random.default_rng(6).normal(10, 2, 3_000)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = explore.density(df, "v").orderBy("point").collect()
    grid = np.linspace(values.min(), values.max(), 200)
    h = values.std(ddof=1) * len(values) ** -0.2
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (len(values) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r["density"] for r in rows], want, rtol=1e-9, atol=1e-15)


def test_box_stats_match_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(7)
    groups = {"a": rng.standard_t(2, 500), "b": rng.normal(3, 1, 40)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [(None, 1.0)],
                               "g string, v double")
    rows = {r["g"]: r for r in explore.box_stats(df, "g", "v").collect()}
    assert set(rows) == set(groups)
    for g, vs in groups.items():
        q1, m, q3 = np.quantile(vs, [0.25, 0.5, 0.75])
        inside = vs[(vs >= q1 - 1.5 * (q3 - q1)) & (vs <= q3 + 1.5 * (q3 - q1))]
        got = rows[g]
        np.testing.assert_allclose([got["q1"], got["median"], got["q3"], got["whisker_lo"], got["whisker_hi"]],
                                   [q1, m, q3, inside.min(), inside.max()], rtol=1e-12)
        assert got["n_outliers"] == len(vs) - len(inside)


def test_correlation_with_a_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, c double")
    rows = {(r["x"], r["y"]): r["corr"] for r in explore.corr_matrix(df, ["a", "c", "absent"]).collect()}
    assert abs(rows["a", "a"] - 1) < 1e-12 and rows["a", "c"] is None and rows["c", "c"] is None
    assert explore.corr_lower(df, ["a", "c"]).count() == 1


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5), ("c", 0.5)], "r string, v double")
    assert [r["r"] for r in explore.top_by_count(df, "r", 2).collect()] == ["c", "a"]
    assert [r["r"] for r in explore.top_by_mean(df, "r", "v", 2).collect()] == ["a", "b"]
    plan = explore.top_by_count(df, "r", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_scan_reads_only_what_a_summary_needs(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).selectExpr("id", "id % 2 AS g", "id * 2.0 AS v", "'x' AS unused").write.parquet(path)
    plan = explore.group_summary(spark.read.parquet(path).filter("v > 4"), "g", "v")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "unused" not in plan and "GreaterThan(v,4" in plan
