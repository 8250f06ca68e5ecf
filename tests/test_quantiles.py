import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.functions.quantiles import column_quantiles, exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def expected(values):
    return np.quantile(np.asarray(values, dtype=float), PROBS)


def got(row):
    return [row[f"q{i}"] for i in range(len(PROBS))]


@pytest.mark.parametrize("name,values", [
    ("heavy tail", np.exp(np.random.default_rng(1).normal(0, 4, 20_000))),
    ("a third the same", np.concatenate([np.full(7_000, 3.5), np.random.default_rng(2).normal(3.5, 1, 13_000)])),
    ("two values", np.repeat([1.0, 2.0], [10_001, 9_999])),
    ("all the same", np.full(20_000, -2.0)),
    ("negative", -np.arange(20_000.0)),
])
def test_bracketed_selection_is_exact(spark, name, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    row = exact_quantiles(df, "v", PROBS, sketch=200).first()
    np.testing.assert_allclose(got(row), expected(values), rtol=1e-12)


@pytest.mark.parametrize("small,margin", [(20, 3.0), (50_000, -1.0)])
def test_narrowing_and_missed_brackets_are_exact(spark, small, margin):
    values = np.exp(np.random.default_rng(1).normal(0, 4, 20_000))
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(7)
    row = exact_quantiles(df, "v", PROBS, sketch=200, small=small, margin=margin).first()
    np.testing.assert_allclose(got(row), expected(values), rtol=1e-12)


def test_groups_of_all_sizes_and_a_null_group(spark):
    rng = np.random.default_rng(3)
    groups = {"hot": rng.normal(0, 1, 9_000), "small": rng.normal(5, 1, 37), "one": [4.0], None: [1.0, 2.0, 7.0]}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("empty", None), ("small", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for small in (10, 50_000):
        out = {r["g"]: got(r) for r in
               exact_quantiles(df, "v", PROBS, ["g"], sketch=200, small=small).collect()}
        assert set(out) == set(groups)
        for g, values in groups.items():
            np.testing.assert_allclose(out[g], expected(values), rtol=1e-12)


def test_even_count_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 10.0)], "v double")
    assert exact_quantiles(df, "v", [0.5], names=["m"]).first()["m"] == 2.5


def test_empty_column_gives_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert exact_quantiles(df, "v", [0.5], names=["m"]).first()["m"] is None
    assert exact_quantiles(df.withColumn("g", F.lit(1)), "v", [0.5], ["g"]).count() == 0


def test_few_rows_leave_the_second_pass(spark):
    """Values outside the brackets are counted, not carried."""
    from pricewright.functions import quantiles
    df = spark.range(50_000).select(F.lit(0).alias("_k0"), F.col("id").cast("double").alias("_v0"))
    brackets = quantiles.staged(quantiles._brackets(df, ["_k0"], 1, [0.5], 4_096, 3.0))
    counted = quantiles._counted(df, brackets, None, ["_k0"], 1, 1)
    assert 0 < counted.count() < 50_000 * 0.02
    assert counted.agg(F.sum("_c")).first()[0] == 50_000


def test_no_task_orders_a_group(spark):
    """Windows run over the ranges of an interval or over the few rows left, by target rank."""
    from pricewright.functions import quantiles
    df = spark.range(5_000).select(F.lit(0).alias("_k0"), F.col("id").cast("double").alias("_low"),
                                   F.col("id").cast("double").alias("_high"), F.lit(1).cast("long").alias("_c"))
    state = spark.createDataFrame([(0, 0, 2_500, 0.0, 4_999.0, 0)],
                                  "_k0 int, _t int, _rank long, _from double, _to double, _below long")
    narrowed = quantiles._narrowed(df, state, ["_k0"]).first()
    assert narrowed["_rows"] <= 6 and narrowed["_below"] <= 2_500 < narrowed["_below"] + narrowed["_rows"]


def test_columns_of_one_scan(spark):
    rng = np.random.default_rng(8)
    values = {"a": rng.normal(0, 1, 4_000), "b": np.round(rng.exponential(5, 4_000)), "c": np.full(4_000, np.nan)}
    nan, inf = float("nan"), float("inf")
    rows = [(int(i % 3), *(None if np.isnan(v[i]) else float(v[i]) for v in values.values())) for i in range(4_000)]
    df = spark.createDataFrame(rows + [(0, nan, inf, nan), (1, None, -inf, None)], "g int, a double, b double, c double")
    for small in (30, 1_000_000):
        out = {r["column"]: got(r) for r in column_quantiles(df, ["a", "b", "c"], PROBS, sketch=200, small=small).collect()}
        assert set(out) == {"a", "b"}
        for c in out:
            np.testing.assert_allclose(out[c], expected(values[c]), rtol=1e-12)
        by = {(r["g"], r["column"]): got(r) for r in
              column_quantiles(df, ["a", "b", "c"], PROBS, ["g"], sketch=200, small=small).collect()}
        assert set(by) == {(g, c) for g in range(3) for c in "ab"}
        for g, c in by:
            np.testing.assert_allclose(by[g, c], expected(values[c][np.arange(4_000) % 3 == g]), rtol=1e-12)


def test_few_jobs_without_groups(spark):
    df = spark.range(30_000).select(F.sin("id").alias("a"), F.cos("id").alias("b")).repartition(4).cache()
    df.count()
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    column_quantiles(df, ["a", "b"], [0.25, 0.5, 0.75])
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) <= 6
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
