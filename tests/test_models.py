import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pricewright.operators import models, tuning

RNG = np.random.default_rng(11)
X = RNG.normal(size=(600, 4)) * [1.0, 2.0, 0.5, 1.0]
X[:, 3] = (X[:, 3] > 0).astype(float)
Y = 11 + X @ [0.5, -0.2, 0.0, 1.0] + RNG.normal(size=600) * 0.3
FOLD = np.arange(600) % 5


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame([(list(map(float, x)), float(y), int(f)) for x, y, f in zip(X, Y, FOLD)],
                               "x array<double>, label double, fold int").repartition(4)
    return df.select(array_to_vector("x").alias("features"), "label", "fold").cache()


def centred(x, y):
    return x - x.mean(0), y - y.mean()


def ridge(x, y, alpha):
    a, b = centred(x, y)
    w = np.linalg.solve(a.T @ a + alpha * np.eye(x.shape[1]), a.T @ b)
    return w, y.mean() - x.mean(0) @ w


def lasso(x, y, alpha):
    a, b = centred(x, y)
    w, n = np.zeros(x.shape[1]), len(y)
    for _ in range(5_000):
        for j in range(x.shape[1]):
            rho = a[:, j] @ (b - a @ w + a[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (a[:, j] @ a[:, j] / n)
    return w, y.mean() - x.mean(0) @ w


@pytest.mark.parametrize("alpha", [0.1, 10.0, 1000.0])
def test_ridge_is_closed_form(table, alpha):
    model = models.fit("ridge", {"alpha": alpha}, table)
    w, b = ridge(X, Y, alpha)
    np.testing.assert_allclose(model.coefficients.toArray(), w, atol=1e-8)
    assert abs(model.intercept - b) < 1e-8


@pytest.mark.parametrize("alpha", [0.001, 0.05, 0.3])
def test_lasso_matches_coordinate_descent(table, alpha):
    model = models.fit("lasso", {"alpha": alpha}, table)
    w, b = lasso(X, Y, alpha)
    np.testing.assert_allclose(model.coefficients.toArray(), w, atol=1e-5)


def test_least_squares_survives_collinear_one_hot(spark):
    labels = np.array(["a", "b", "c"])[RNG.integers(0, 3, 300)]
    hot = (labels[:, None] == np.array(["a", "b", "c"])).astype(float)
    y = hot @ [1.0, 2.0, 4.0] + RNG.normal(size=300) * 0.1
    df = spark.createDataFrame([(list(map(float, x)), float(v)) for x, v in zip(hot, y)], "x array<double>, label double") \
        .select(array_to_vector("x").alias("features"), "label")
    predicted = {tuple(r["features"]): r["prediction"]
                 for r in models.fit("linear", {}, df).transform(df).select("features", "prediction").collect()}
    for i, name in enumerate("abc"):
        assert abs(predicted[tuple(np.eye(3)[i])] - y[labels == name].mean()) < 1e-6


@pytest.mark.parametrize("name,solve", [("ridge", ridge), ("lasso", lasso)])
def test_penalty_path_equals_fitting_every_fold(table, name, solve):
    alphas = [0.01, 0.1] if name == "lasso" else [0.1, 50.0]
    rows = tuning.cross_validate(name, [{"alpha": a} for a in alphas], table, 5).collect()
    assert len(rows) == 10
    for r in rows:
        out = FOLD == r["fold"]
        w, b = solve(X[~out], Y[~out], alphas[r["candidate"]])
        for rows_, got in ((~out, r["train_r2"]), (out, r["val_r2"])):
            error = Y[rows_] - X[rows_] @ w - b
            assert abs(got - (1 - (error ** 2).mean() / Y[rows_].var())) < 1e-6


def test_penalty_path_with_a_feature_that_is_constant_in_a_fold(spark):
    x = np.c_[X[:, 0], (FOLD == 2).astype(float)]
    df = spark.createDataFrame([(list(map(float, v)), float(y), int(f)) for v, y, f in zip(x, Y, FOLD)],
                               "x array<double>, label double, fold int") \
        .select(array_to_vector("x").alias("features"), "label", "fold")
    got = {r["fold"]: r["val_r2"] for r in tuning.cross_validate("ridge", [{"alpha": 1.0}], df, 5).collect()}
    for k in range(5):
        w, b = ridge(x[FOLD != k], Y[FOLD != k], 1.0)
        error = Y[FOLD == k] - x[FOLD == k] @ w - b
        assert abs(got[k] - (1 - (error ** 2).mean() / Y[FOLD == k].var())) < 1e-6


def test_search_picks_the_best_mean(table):
    found = tuning.grid_search("tree", {"max_depth": [1, 4], "min_samples_leaf": [1]}, table, 5, parallelism=4)
    assert found.best == {"max_depth": 4, "min_samples_leaf": 1}
    best = found.table.first()
    assert abs(best["gap"] - (best["mean_train_r2"] - best["mean_val_r2"])) < 1e-12


def test_scores_do_not_depend_on_partitioning(table):
    a = tuning.cross_validate("tree", [{"max_depth": 3}], table.repartition(2), 5).collect()
    b = tuning.cross_validate("tree", [{"max_depth": 3}], table.repartition(9), 5).collect()
    np.testing.assert_allclose([r["val_r2"] for r in a], [r["val_r2"] for r in b], atol=1e-9)


def test_sampling_is_seeded_and_without_replacement():
    space = models.SPACES["gbt_depth"]
    points = tuning.sampled(space, 50, 42)
    assert points == tuning.sampled(space, 50, 42) != tuning.sampled(space, 50, 43)
    assert len({str(p) for p in points}) == 50
    assert all(p[k] in space[k] for p in points for k in space)
    assert len(tuning.sampled({"a": [1, 2]}, 50)) == 2


def test_parameter_mapping():
    forest = models.estimator("forest", {"n_estimators": 7, "max_depth": None, "max_features": 0.3, "min_samples_leaf": 4})
    assert forest.getNumTrees() == 7 and forest.getMaxDepth() == models.OPEN_DEPTH
    assert forest.getFeatureSubsetStrategy() == "0.3" and forest.getMinInstancesPerNode() == 4
    leaf = models.estimator("gbt_leaf", {"num_leaves": 95, "max_depth": -1})
    assert leaf.getMaxDepth() == 7
    assert models.estimator("gbt_leaf", {"num_leaves": 255, "max_depth": 6}).getMaxDepth() == 6
    boosted = models.estimator("gbt_depth", {"learning_rate": 0.05, "subsample": 0.7, "colsample_bytree": 1.0})
    assert (boosted.getStepSize(), boosted.getSubsamplingRate(), boosted.getFeatureSubsetStrategy()) == (0.05, 0.7, "all")
    assert len(tuning.grid(models.GRIDS["tree"])) == 20


def test_importances(spark, table):
    names = ["a", "b", "c", "d"]
    tree = models.feature_importance(models.fit("tree", {"max_depth": 3}, table), spark, names)
    assert [r["feature"] for r in tree.collect()][0] in ("a", "d")
    share = models.importance_share(models.feature_importance(
        models.fit("ridge", {"alpha": 1.0}, table), spark, names, None), 2).collect()
    assert [r["rank"] for r in share] == [1, 2] and share[0]["feature"] == "d"


def test_coefficients_side_by_side(spark, table):
    out = models.coef_compare(models.fit("ridge", {"alpha": 1.0}, table), models.fit("lasso", {"alpha": 0.05}, table),
                              spark, ["a", "b", "c", "d"], top=4)
    rows = {r["feature"]: r for r in out.collect()}
    assert rows["c"]["lasso"] == 0.0 and rows["a"]["n_zero_lasso"] >= 1


def test_learning_curve_reaches_the_full_side(spark, table):
    keyed = table.withColumn("id", F.monotonically_increasing_id())
    rows = tuning.learning_curve("tree", {"max_depth": 3}, keyed, "id", 42, sizes=(0.3, 1.0)).collect()
    assert [r["share"] for r in rows] == [0.3, 1.0]
    assert rows[1]["val_mean"] > 0.5 and rows[0]["train_mean"] >= rows[1]["train_mean"] - 0.05
