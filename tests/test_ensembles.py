"""Ensembles that do not depend on partitions, scores read off one fit, curves from moments."""

import logging
import uuid

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from fixtures.sql import bag_weight as bag_weight_sql
from pricewright.functions import numeric
from pricewright.operators import ensembles, models, tuning
from pricewright.plans.train_plan import train_all
from pricewright.spec import AIRFARES

RNG = np.random.default_rng(21)
N = 900
X = np.c_[RNG.normal(size=(N, 3)), RNG.integers(0, 2, N)].astype(float)
Y = 11 + np.sin(2 * X[:, 0]) + X[:, 1] * X[:, 3] + RNG.normal(size=N) * 0.2


def rows_of(spark, x, y):
    df = spark.createDataFrame([(i, i % 5, list(map(float, v)), float(t)) for i, (v, t) in enumerate(zip(x, y))],
                               "id long, fold int, x array<double>, label double")
    return df.select("id", "fold", array_to_vector("x").alias("features"), "label")


@pytest.fixture(scope="module")
def table(spark):
    return rows_of(spark, X, Y).cache()


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").select("prediction").collect()])


def test_bag_weights_are_poisson_and_equal_their_sql(spark):
    ids = spark.range(40_000)
    w = ids.select("id", *(numeric.bag_weight("id", t, 42).alias(f"w{t}") for t in range(3))).toPandas()
    for t in range(3):
        assert abs(w[f"w{t}"].mean() - 1) < 0.03 and abs(w[f"w{t}"].var() - 1) < 0.05
        theirs = duckdb.sql(f"SELECT id, {bag_weight_sql('id', t)} AS w FROM range(40000) r(id) ORDER BY id").df()
        assert (theirs["w"].to_numpy() == w.sort_values("id")[f"w{t}"].to_numpy()).all()
    assert np.abs(np.corrcoef(w[["w0", "w1", "w2"]].T) - np.eye(3)).max() < 0.02


@pytest.mark.parametrize("name,params", [
    ("forest", {"n_estimators": 6, "max_depth": 5, "max_features": 0.5}),
    ("forest", {"n_estimators": 4, "max_depth": 5, "max_features": 0.5, "bootstrap": False}),
    ("gbt_depth", {"n_estimators": 4, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.5}),
])
def test_same_model_for_any_partitioning(table, name, params):
    for key in ("id", None):
        fitted = [models.fit(name, params, table.repartition(n), key=key) for n in (2, 9)]
        np.testing.assert_allclose(predictions(fitted[0], table), predictions(fitted[1], table), atol=1e-9)
    assert not np.allclose(predictions(fitted[0], table), predictions(models.fit(name, params, table, seed=7), table))


def test_thresholds_of_a_table_that_is_sampled_for_them(spark):
    # beyond 65,536 rows MLlib takes its thresholds from a sample
    df = spark.range(70_000).select(
        "id", array_to_vector(F.array(F.sin("id") * 10, F.cos(F.col("id") * 3))).alias("features"),
        F.sin(F.col("id") / 7).alias("label"))
    fitted = [models.fit("tree", {"max_depth": 4}, df.repartition(n)) for n in (3, 11)]
    assert fitted[0].toDebugString.split("\n")[1:] == fitted[1].toDebugString.split("\n")[1:]


def test_a_bagged_forest_is_the_mean_of_its_trees_and_survives_saving(table, tmp_path):
    params = {"n_estimators": 5, "max_depth": 4}
    forest = models.fit("forest", params, table, key="id")
    trees = np.mean([predictions(t, table) for t in forest.trees], axis=0)
    np.testing.assert_allclose(predictions(forest, table), trees, atol=1e-12)
    forest.write().overwrite().save(str(tmp_path / "forest"))
    again = RandomForestRegressionModel.load(str(tmp_path / "forest"))
    np.testing.assert_allclose(predictions(again, table), trees, atol=1e-12)
    assert again.getNumTrees == 5 and abs(sum(again.featureImportances.toArray()) - 1) < 1e-9
    # a weighted tree is the tree of the repeated rows
    drawn = table.withColumn("w", numeric.bag_weight("id", 0, 42))
    repeated = drawn.select("*", F.explode(F.sequence(F.lit(1), F.col("w").cast("int")))).where("w > 0")
    single = models.fit("tree", {"max_depth": 4}, repeated.drop("col", "w"))
    np.testing.assert_allclose(predictions(forest.trees[0], table), predictions(single, table), atol=1e-9)


def counted_fits(monkeypatch):
    calls = []
    real = tuning.fit
    monkeypatch.setattr(tuning, "fit", lambda *a, **k: calls.append(a[1]) or real(*a, **k))
    return calls


@pytest.mark.parametrize("name,candidates,fits", [
    ("tree", [{"max_depth": d, "min_samples_leaf": m} for m in (1, 5) for d in (2, 6, 1, 4)], 2),
    ("forest", [{"n_estimators": n, "max_depth": 3, "max_features": 0.5} for n in (5, 1, 3)], 1),
    ("gbt_depth", [{"n_estimators": n, "max_depth": 2, "subsample": 0.7} for n in (2, 6, 1)], 1),
    ("gbt_leaf", [{"n_estimators": 3, "num_leaves": n} for n in (4, 8)], 2),
])
def test_path_scores_equal_single_fits(table, monkeypatch, name, candidates, fits):
    single = {}
    for i, params in enumerate(candidates):
        for r in tuning.cross_validate(name, [params], table, 2, fold="fold", key="id").collect():
            single[i, r["fold"]] = (r["train_r2"], r["val_r2"])
    calls = counted_fits(monkeypatch)
    found = {(r["candidate"], r["fold"]): (r["train_r2"], r["val_r2"])
             for r in tuning.cross_validate(name, candidates, table, 2, fold="fold", key="id").collect()}
    assert len(calls) == 2 * fits and found.keys() == single.keys()
    for at, scores in single.items():
        np.testing.assert_allclose(found[at], scores, atol=1e-9)


def test_rows_stay_where_they_are_beside_the_leaves_of_a_tree(table):
    """Dealt by leaf, a tree of three leaves would bring the whole table into three tasks."""
    model = models.fit("tree", {"max_depth": 2}, table, key="id")
    placed, cut = ensembles.depth_path(model, table, [1, 2])
    table.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = placed.select(*cut)._jdf.queryExecution().executedPlan().toString()
    finally:
        table.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning(number" not in plan


def test_tree_learners_of_a_training_run_share_one_layout(table, monkeypatch):
    calls = []
    real = ensembles.laid_out
    encoded = table.select("*", (F.col("id") % 7 == 0).alias("is_test"))
    chosen = {"tree": {"max_depth": 2}, "gbt_depth": {"n_estimators": 2, "max_depth": 2}}
    alone = {n: models.fit(n, p, encoded.filter("NOT is_test"), key="id") for n, p in chosen.items()}
    monkeypatch.setattr(ensembles, "laid_out", lambda *a, **k: calls.append(1) or real(*a, **k))
    trained = train_all(encoded, None, AIRFARES, "id", learners=tuple(chosen), params=chosen)
    assert len(calls) == 1
    for name, model in alone.items():
        np.testing.assert_allclose(predictions(trained.models[name], table), predictions(model, table), atol=1e-12)


def test_moments_equal_numpy(spark):
    x = np.c_[X[:, :2], (np.arange(N) % 5 == 2).astype(float), np.full(N, 3.0)]
    got = tuning.grouped_moments(rows_of(spark, x, Y + 1e6), ["fold"])
    assert sorted(got) == [(k,) for k in range(5)]
    for (k,), m in got.items():
        mine = np.c_[x, Y + 1e6][np.arange(N) % 5 == k]
        centred = mine - mine.mean(0)
        assert m.n == len(mine)
        np.testing.assert_allclose(m.mean, mine.mean(0), rtol=1e-12)
        np.testing.assert_allclose(m.cross, centred.T @ centred, atol=1e-7)
    assert tuning.grouped_moments(rows_of(spark, x[:0], Y[:0]), ["fold"]) == {}


def jobs_of(spark, run):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name,params", [("linear", {}), ("ridge", {"alpha": 3.0}), ("lasso", {"alpha": 0.05})])
def test_linear_curve_equals_fitting_every_point(spark, table, name, params):
    sizes = (0.2, 0.5, 1.0)
    got = tuning.learning_curve(name, params, table, "id", 42, sizes=sizes).collect()
    marked = table.withColumns({"part": numeric.bucket("id", 3, 42, numeric.FOLD_STREAM),
                                "rank": numeric.bucket("id", 1000, 42, numeric.SIZE_STREAM)}).cache()
    for row, size in zip(got, sizes):
        scores = []
        for k in range(3):
            train = marked.where((F.col("part") != k) & (F.col("rank") < round(size * 1000)))
            model = models.fit(name, params, train)
            scores.append([model.transform(side).agg(numeric.r_squared(F.col("label"), F.col("prediction"))).first()[0]
                           for side in (train, marked.where(F.col("part") == k))])
        mean, std = np.mean(scores, axis=0), np.std(scores, axis=0)
        np.testing.assert_allclose([row["train_mean"], row["val_mean"], row["train_std"], row["val_std"]],
                                   [*mean, *std], atol=1e-5)
    assert jobs_of(spark, lambda: tuning.learning_curve(name, params, table, "id", 42).collect()) <= 10


def test_lasso_that_does_not_come_to_rest_says_so(table, caplog):
    with caplog.at_level(logging.WARNING):
        rows = tuning.cross_validate("lasso", [{"alpha": 1e-6, "max_iter": 1}, {"alpha": 0.1}], table, 5).collect()
    assert "did not converge" in caplog.text
    assert {r["candidate"] for r in rows if "converged" in r["params"]} == {0}


def test_folds_without_rows_have_no_scores(table):
    rows = tuning.cross_validate("ridge", [{"alpha": 1.0}], table.where("fold < 4"), 5).collect()
    assert [r["val_r2"] is None for r in sorted(rows, key=lambda r: r["fold"])] == [False] * 4 + [True]
    assert all(r["train_r2"] is None and r["val_r2"] is None for r in tuning.cross_validate(
        "ridge", [{"alpha": 1.0}], table.where("fold > 9"), 5).collect())


@pytest.fixture
def repeated(spark):
    """3,000 rows of 12 feature vectors."""
    own = np.random.default_rng(5)
    x = np.c_[own.integers(0, 3, 3000), own.integers(0, 4, 3000)].astype(float)
    return rows_of(spark, x, 1e3 + x[:, 0] * x[:, 1] + own.normal(size=3000)).cache()


def rows_fitted(monkeypatch):
    seen, real = [], models.DecisionTreeRegressor.fit
    monkeypatch.setattr(models.DecisionTreeRegressor, "fit", lambda self, df: seen.append(df.count()) or real(self, df))
    return seen


@pytest.mark.parametrize("params", [{"max_depth": 3}, {"max_depth": 5, "min_samples_leaf": 300},
                                    {"max_depth": 5, "min_samples_leaf": 1600}])
def test_a_tree_is_fitted_on_the_distinct_vectors(repeated, monkeypatch, params):
    monkeypatch.setattr(ensembles, "FOLD_AT", 1e9)
    whole = models.fit("tree", params, repeated, key="id")
    monkeypatch.undo()
    seen = rows_fitted(monkeypatch)
    fitted = [models.fit("tree", params, repeated.repartition(n), key="id") for n in (2, 7)]
    assert seen == [12, 12]
    for model in fitted:
        np.testing.assert_allclose(predictions(model, repeated), predictions(whole, repeated), atol=1e-9)
        assert model.numNodes == whole.numNodes
    assert fitted[0].toDebugString.split("\n")[1:] == fitted[1].toDebugString.split("\n")[1:]


def test_scores_of_folded_rows_are_those_of_the_rows(repeated, monkeypatch):
    def scores():
        curve = tuning.learning_curve("tree", {"max_depth": 3}, repeated, "id", 42, sizes=(0.2, 1.0)).collect()
        folds = tuning.cross_validate("tree", [{"max_depth": d} for d in (1, 3)], repeated, 2, key="id")
        return [*map(tuple, curve), *(tuple(r)[3:] for r in folds.orderBy("candidate", "fold").collect())]

    monkeypatch.setattr(ensembles, "FOLD_AT", 1e9)
    whole = scores()
    monkeypatch.undo()
    seen = rows_fitted(monkeypatch)
    folded = scores()
    assert seen and max(seen) <= 12 * 3 * 2
    for mine, theirs in zip(folded, whole, strict=True):
        np.testing.assert_allclose(mine, theirs, atol=1e-9)
