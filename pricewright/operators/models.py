"""The seven learners, their search spaces and their mapping onto MLlib."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame, Window, functions as F

from pricewright.operators import ensembles
from pricewright.operators.features import feature_table

Params = Mapping[str, Any]

#: trees without a depth limit stop here; MLlib allows at most 30
OPEN_DEPTH = 30
MAX_BINS = 256
_VANISHING = 1e-10

NAMES = {
    "linear": "Linear Regression",
    "ridge": "Ridge",
    "lasso": "Lasso",
    "tree": "Decision Tree",
    "forest": "Random Forest",
    "gbt_depth": "Boosted Trees (depth-wise)",
    "gbt_leaf": "Boosted Trees (leaf-wise)",
}

# The exhaustive grids. MLlib trees have no minimum split size, so
# that axis (2, 5, 10) of the tree grid is dropped.
GRIDS: dict[str, dict[str, list]] = {
    "ridge": {"alpha": [1e-4, 1e-3, 0.01, 0.05, 0.1, 0.5, 1, 5, 10, 50, 100, 500, 1000, 5000, 10000]},
    "lasso": {"alpha": [1e-5, 1e-4, 5e-4, 1e-3, 5e-3, 0.01, 0.05, 0.1, 1.0], "max_iter": [10_000]},
    "tree": {"max_depth": [4, 5, 6, 8, 10], "min_samples_leaf": [1, 2, 5, 10]},
}

# The sampled spaces, without the axes MLlib lacks (minimum split
# size and the L1/L2 leaf penalties).
SPACES: dict[str, dict[str, list]] = {
    "forest": {
        "n_estimators": [100, 200, 300, 400, 500],
        "max_depth": [6, 8, 10, 12, None],
        "min_samples_leaf": [1, 2, 4, 5],
        "max_features": ["sqrt", "log2", 0.3, 0.5],
        "bootstrap": [True],
    },
    "gbt_depth": {
        "n_estimators": [200, 300, 400, 500, 600],
        "learning_rate": [0.005, 0.01, 0.03, 0.05, 0.1, 0.15],
        "max_depth": [3, 4, 5, 6, 7, 8],
        "subsample": [0.5, 0.6, 0.7, 0.8, 1.0],
        "colsample_bytree": [0.5, 0.6, 0.7, 0.8, 1.0],
        "min_child_weight": [1, 3, 5],
    },
    "gbt_leaf": {
        "n_estimators": [200, 300, 400, 500, 600],
        "learning_rate": [0.005, 0.01, 0.03, 0.05, 0.1],
        "num_leaves": [31, 63, 95, 127, 191, 255],
        "min_child_samples": [5, 10, 20, 30, 50],
        "subsample": [0.5, 0.6, 0.7, 0.8, 1.0],
        "colsample_bytree": [0.5, 0.6, 0.7, 0.8, 1.0],
        "max_depth": [-1, 6, 8, 10],
    },
}
N_ITER = 50


@dataclass(frozen=True)
class LabelStats:
    """What a penalty needs to know about the rows it is fitted on."""

    rows: int
    deviation: float


def label_stats(df: DataFrame, label: str = "label") -> LabelStats:
    row = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
    return LabelStats(row["n"], row["sd"] or 0.0)


def _subset(share: Any) -> str:
    """Feature subset per node: a name stays a name, a share becomes its text."""
    if share in (None, 1, 1.0):
        return "all"
    return share if isinstance(share, str) else str(float(share))


def estimator(name: str, params: Params, stats: LabelStats | None = None, *,
              seed: int = 42, label: str = "label", features: str = "features"):
    """MLlib estimator for a learner and its parameters in scikit vocabulary."""
    io = {"featuresCol": features, "labelCol": label, "predictionCol": "prediction"}
    p = dict(params)
    if name == "linear":
        # one-hot columns of one categorical sum to one, so plain least squares has no
        # single answer; a vanishing penalty picks the smallest one, in closed form
        return LinearRegression(solver="normal", regParam=_VANISHING * stats.deviation, elasticNetParam=0.0,
                                standardization=False, **io)
    if name == "ridge":
        # MLlib averages the loss and scales the penalty by the label deviation
        penalty = p.get("alpha", 1.0) * stats.deviation / stats.rows
        return LinearRegression(solver="normal", regParam=penalty, elasticNetParam=0.0,
                                standardization=False, **io)
    if name == "lasso":
        return LinearRegression(solver="normal", regParam=p.get("alpha", 1.0), elasticNetParam=1.0,
                                standardization=False, maxIter=p.get("max_iter", 10_000), tol=1e-12, **io)
    if name == "tree":
        return DecisionTreeRegressor(
            maxDepth=p.get("max_depth") or OPEN_DEPTH, maxBins=MAX_BINS, seed=seed,
            minInstancesPerNode=p.get("min_samples_leaf", 1), **io)
    if name == "forest":
        return RandomForestRegressor(
            numTrees=p.get("n_estimators", 100), maxDepth=p.get("max_depth") or OPEN_DEPTH, maxBins=MAX_BINS,
            minInstancesPerNode=p.get("min_samples_leaf", 1), bootstrap=p.get("bootstrap", True),
            featureSubsetStrategy=_subset(p.get("max_features")), seed=seed, **io)
    boosted = {"maxIter": p.get("n_estimators", 100), "maxBins": MAX_BINS, "seed": seed,
               "subsamplingRate": p.get("subsample", 1.0),
               "featureSubsetStrategy": _subset(p.get("colsample_bytree"))}
    if name == "gbt_depth":
        return GBTRegressor(stepSize=p.get("learning_rate", 0.3), maxDepth=p.get("max_depth", 6),
                            minInstancesPerNode=p.get("min_child_weight", 1), **boosted, **io)
    if name == "gbt_leaf":
        # leaf-wise growth is approximated by the depth that holds as many leaves
        depth = math.ceil(math.log2(p.get("num_leaves", 31)))
        if p.get("max_depth", -1) > 0:
            depth = min(depth, p["max_depth"])
        return GBTRegressor(stepSize=p.get("learning_rate", 0.1), maxDepth=depth,
                            minInstancesPerNode=p.get("min_child_samples", 20), **boosted, **io)
    raise ValueError(f"unknown learner {name}")


#: learners whose result would depend on partitions and row order if those were left as they come
TREES = ("tree", "forest", "gbt_depth", "gbt_leaf")


def fit(name: str, params: Params, df: DataFrame, *, key: str | None = None, arranged: bool = False, **options) -> Model:
    """Fit on a table with ``features`` and ``label``; the same model whatever the partitioning.

    ``key`` is the column that decides which bootstrap samples a row is in, by default its
    content. ``arranged`` says that ``df`` is laid out already (see ``ensembles.laid_out``), for a tree perhaps folded.
    """
    stats = label_stats(df, options.get("label", "label")) if name in ("linear", "ridge") else None
    learner = estimator(name, params, stats, **options)
    if name not in TREES:
        return learner.fit(df)
    io = {"features": learner.getFeaturesCol(), "label": learner.getLabelCol()}
    if name == "tree":
        rows = df if arranged else ensembles.laid_out_for_tree(df, key, **io)
        if not ensembles.is_folded(rows):
            return learner.fit(rows)
        kept = rows if arranged else rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return ensembles.of_folded(learner, kept).fit(kept)
        finally:
            if not arranged:
                kept.unpersist()
    rows = df if arranged else ensembles.laid_out(df, key, **io)
    if name == "forest" and learner.getBootstrap():
        return ensembles.bagged(learner, rows, learner.getNumTrees(), learner.getSeed(), key)
    return learner.fit(rows)


def feature_importance(model: Model, spark, names: Sequence[str], top: int | None = 15) -> DataFrame:
    """Tree importances, else absolute coefficients, largest first."""
    scores = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    scores = spark.createDataFrame([(i, abs(float(v))) for i, v in enumerate(scores.toArray())],
                                   "pos int, importance double")
    ranked = (scores.join(feature_table(scores, names), "pos")
              .select(F.col("name").alias("feature"), "importance")
              .orderBy(F.desc("importance"), "feature"))
    return ranked if top is None else ranked.limit(top)


def importance_share(importances: DataFrame, top: int = 10) -> DataFrame:
    """The leading features with their share of the total. One row per feature goes in."""
    order = Window.orderBy(F.desc("importance"), "feature")
    share = F.col("importance") / F.sum("importance").over(Window.partitionBy()) * 100
    return (importances.withColumn("importance_pct", F.bround(share, 2))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))


def coef_compare(ridge: Model, lasso: Model, spark, names: Sequence[str], top: int = 15) -> DataFrame:
    """Both coefficients per feature, rank by size in each, how many lasso zeroed."""
    rows = [(n, float(a), float(b)) for n, a, b in
            zip(names, ridge.coefficients.toArray(), lasso.coefficients.toArray())]
    table = spark.createDataFrame(rows, "feature string, ridge double, lasso double")
    every = Window.partitionBy()
    for c in ("ridge", "lasso"):
        table = table.withColumn(f"{c}_rank", F.row_number().over(
            Window.orderBy(F.desc(F.abs(c)), "feature")))
    return (table.withColumn("n_zero_lasso", F.count_if(F.col("lasso") == 0).over(every))
            .filter((F.col("ridge_rank") <= top) | (F.col("lasso_rank") <= top)))


def dense(df: DataFrame, column: str = "features") -> DataFrame:
    """Vector as array, for looking at it in SQL."""
    return df.withColumn(column, vector_to_array(column))
