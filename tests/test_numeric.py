import pandas as pd
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pricewright.functions import numeric as num
from pricewright.operators import explore


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def one(df, expression):
    return df.agg(expression.alias("x")).first()["x"]


def test_text_to_number(spark):
    texts = ["1.5", " 12 ", "x", "1.5d", "2F", "1e3", "inf", "NaN", "", None, "-0.25", "3."]
    got = [r["x"] for r in column(spark, texts, "string").select(num.parse_double(F.col("v")).alias("x")).collect()]
    assert got == [1.5, 12.0, None, None, None, 1000.0, float("inf"), None, None, None, -0.25, 3.0]


def test_nan_is_missing_not_large(spark):
    df = column(spark, [float("nan"), 1.0])
    assert df.filter(F.col("v") > 500_000).count() == 1  # what Spark does by itself
    assert df.filter(num.drop_nan(F.col("v")) > 500_000).count() == 0


def test_skew_is_bias_adjusted(spark):
    for values in ([1.0, 2.0, 3.0, 10.0], [5.0, 1.0, 1.0, 8.0, 2.0, None]):
        assert abs(one(column(spark, values), num.unbiased_skew(F.col("v"))) - pd.Series(values).skew()) < 1e-12
    assert one(column(spark, [1.0, 2.0]), num.unbiased_skew(F.col("v"))) is None
    assert one(column(spark, [4.0] * 5), num.unbiased_skew(F.col("v"))) == 0.0


def test_correlation_is_pairwise_complete_and_null_for_a_constant(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 2.0, 7.0), (2.0, None, 7.0), (3.0, 1.0, 7.0), (None, 5.0, 7.0), (4.0, 9.0, 7.0), (nan, 3.0, 7.0), (2.0, inf, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    frame = pd.DataFrame(rows, columns=["a", "b", "c"]).replace([inf], nan)
    got = {(r["x"], r["y"]): r["corr"] for r in explore.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert len(got) == 9 and got["a", "b"] == got["b", "a"]
    assert abs(got["a", "b"] - frame["a"].corr(frame["b"])) < 1e-12
    assert got["a", "a"] == got["b", "b"] == 1.0
    assert got["a", "c"] is None and got["c", "c"] is None


def test_percent_of_nothing_is_null(spark):
    row = spark.range(1).select(num.percent(F.lit(0), F.lit(0), 2).alias("a"),
                                num.percent(F.lit(1), F.lit(8), 1).alias("b")).first()
    assert row["a"] is None and row["b"] == 12.5


def test_compact_amount(spark):
    df = column(spark, [150_000.0, 999.0, 1000.0])
    assert [r[0] for r in df.select(num.compact_amount(F.col("v"))).collect()] == ["150k", "999", "1k"]


def test_r_squared_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    assert one(df, num.r_squared(F.col("y"), F.col("p"))) is None


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-2**62, 2**62), min_size=1, max_size=30), st.integers(2, 50))
def test_bucket_is_in_range_and_matches_arithmetic(spark, keys, buckets):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r["b"] for r in df.select(num.bucket("k", buckets, 42, num.TEST_STREAM).alias("b")).collect()]
    assert got == [((k % num.MODULUS) * num.TEST_STREAM + num.seed_offset(42)) % num.MODULUS * buckets // num.MODULUS for k in keys]
    assert all(0 <= b < buckets for b in got)


def test_buckets_are_even_and_independent(spark):
    df = spark.range(100_000).select(num.bucket("id", 10, 42, num.TEST_STREAM).alias("t"),
                                     num.bucket("id", 5, 42, num.FOLD_STREAM).alias("f"))
    counts = [r["count"] for r in df.groupBy("t", "f").count().collect()]
    assert len(counts) == 50 and min(counts) > 1_700 and max(counts) < 2_300
