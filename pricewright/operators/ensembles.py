"""Tree ensembles that come out the same for any partitioning, and scores along their paths.

MLlib draws bootstrap samples, subsamples and the rows its thresholds come from by partition and
position. ``laid_out`` makes both a function of the data: rows go to a number of partitions
that their count decides, by key, and are sorted there. Bootstrap samples go further:
each tree is fitted with Poisson weights that row key and tree number give, so a bag can be
written down in SQL and adding trees changes none that are there.

A regression tree sees of rows with the same features only their number and the sum of their labels. Where
vectors repeat, ``laid_out_for_tree`` leaves one weighted row of each, and no fit or score goes over the table again.

A fitted ensemble holds the scores of many candidates. A tree cut at depth k is the tree
that stops there, as MLlib splits each node by its own rows; a bagged forest's first m
trees are the forest of m trees; so are the first rounds of boosting.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark import SparkContext, StorageLevel
from pyspark.ml import Model
from pyspark.ml.regression import (
    DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, RandomForestRegressionModel,
    RandomForestRegressor)
from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.numeric import bag_weight, seed_offset
from pricewright.staging import in_parallel

#: rows of a partition, about, and partitions at least; neither looks at the cluster
ROWS, LEAST_PARTS = 100_000, 16
#: rows of a feature vector, on average, from which on a table is folded; how many they are, and their squared
#: deviations from their mean label
FOLD_AT, WEIGHT, WITHIN = 8, "__rows", "__within"
#: single-tree fits at a time; each is a distributed job of its own
TREES_AT_ONCE = 4


def content_key(features: str, label: str) -> Column:
    """Key of a row without one: equal rows share it."""
    return F.xxhash64(features, label)


def laid_out(df: DataFrame, key: str | None = None, *, features: str = "features", label: str = "label") -> DataFrame:
    """The same rows in partitions and an order that depend on the rows alone."""
    own = F.col(key) if key else content_key(features, label)
    return _laid_out(df, df.count(), own, features, label)


def _laid_out(df: DataFrame, rows: int, own: Column, features: str, label: str) -> DataFrame:
    parts = max(LEAST_PARTS, rows // ROWS + 1)
    return df.repartition(parts, own).sortWithinPartitions(own, label, F.xxhash64(features))


def laid_out_for_tree(df: DataFrame, key: str | None = None, by: Sequence[str] = (), *, features: str = "features",
                      label: str = "label") -> DataFrame:
    """``laid_out``, or one row per feature vector and ``by`` if vectors repeat ``FOLD_AT`` times on average.

    A folded row has the mean label, the number of rows (``WEIGHT``) and their squared deviations (``WITHIN``). Its
    mean comes from whole numbers, which add up to the same in any order.
    """
    own = F.col(key) if key else content_key(features, label)
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.count(label).alias("labels"), F.max(F.abs(label)).alias("top"),
                   F.approx_count_distinct(F.xxhash64(features, *by)).alias("kinds")).first()
    rows, top = found["rows"], found["top"]
    if found["labels"] < max(rows, 1) or not math.isfinite(top) or rows < FOLD_AT * found["kinds"]:
        return _laid_out(df, rows, own, features, label)
    scale = 2.0 ** min(52 - math.frexp(top)[1], 1000)
    whole = F.rint(F.col(label) * scale).cast("bigint")
    n = F.count(F.lit(1)).cast("double")
    total = (F.sum(F.shiftright(whole, 26)).cast("double") * 2.0 ** 26
             + F.sum(whole.bitwiseAND(F.lit((1 << 26) - 1))).cast("double"))
    folded = df.groupBy(features, *by).agg(
        n.alias(WEIGHT), (total / n / scale).alias(label), (F.var_pop(label) * n).alias(WITHIN))
    return _laid_out(folded, found["kinds"], content_key(features, label), features, label)


def is_folded(df: DataFrame) -> bool:
    return WEIGHT in df.columns


def of_folded(tree: DecisionTreeRegressor, rows: DataFrame) -> DecisionTreeRegressor:
    """The learner for folded rows: a leaf's least size counts the rows that were folded."""
    least = tree.getMinInstancesPerNode()
    params = {tree.weightCol: WEIGHT, tree.minInstancesPerNode: 1}
    if least > 1:
        share = (least - 0.5) / (rows.agg(F.sum(WEIGHT)).first()[0] or 1.0)
        # MLlib takes shares under a half; with a greater one no split is possible
        params |= {tree.minWeightFractionPerNode: share} if share < 0.5 else {tree.maxDepth: 0}
    return tree.copy(params)


def forest_of(trees: Sequence[DecisionTreeRegressionModel], features: str = "features",
              prediction: str = "prediction") -> RandomForestRegressionModel:
    """One MLlib forest of separately fitted trees; it predicts, saves and loads like any other."""
    context = SparkContext._active_spark_context
    package = context._jvm.org.apache.spark.ml.regression
    array = context._gateway.new_array(package.DecisionTreeRegressionModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree._java_obj
    model = RandomForestRegressionModel(package.RandomForestRegressionModel(
        f"bagged_{uuid.uuid4().hex[:12]}", array, trees[0].numFeatures))
    model._resetUid(model._java_obj.uid())
    # a forest divides by this parameter, not by the trees it has
    model._set(numTrees=len(trees), featuresCol=features, predictionCol=prediction)
    model._transfer_params_to_java()
    return model


def bagged(estimator: RandomForestRegressor, rows: DataFrame, trees: int, seed: int, key: str | None = None, *,
           at_once: int = TREES_AT_ONCE) -> RandomForestRegressionModel:
    """A forest of ``trees`` trees, each on its own bootstrap sample; ``estimator`` says how one is grown.

    ``rows`` are laid out. Rows that share a key are drawn together; without a key that is rows of equal content.
    """
    features, label = estimator.getFeaturesCol(), estimator.getLabelCol()
    own = key or "__key"
    keyed = rows.select(features, label, (F.col(key) if key else content_key(features, label)).alias(own))

    def grow(tree: int) -> DecisionTreeRegressionModel:
        one = estimator.copy({
            estimator.numTrees: 1, estimator.bootstrap: False, estimator.subsamplingRate: 1.0,
            estimator.weightCol: "__weight", estimator.seed: seed_offset(seed + tree)})
        drawn = keyed.withColumn("__weight", bag_weight(own, tree, seed)).where("__weight > 0")
        return one.fit(drawn.select(features, label, "__weight")).trees[0]

    held = keyed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = in_parallel(rows.sparkSession, [lambda t=t: grow(t) for t in range(trees)], at_once)
    finally:
        held.unpersist()
    return forest_of(fitted, features, estimator.getPredictionCol())


# -- scores along a path -----------------------------------------------------

def _depth_predictions(tree: DecisionTreeRegressionModel, depths: Sequence[int]) -> list[tuple[int, list[float]]]:
    """Per leaf, numbered in preorder as MLlib does, what the tree cut at each depth would predict."""
    out: list[tuple[int, list[float]]] = []
    stack = [(tree._call_java("rootNode"), [])]
    while stack:
        node, above = stack.pop()
        path = [*above, float(node.prediction())]
        if node.subtreeDepth() == 0:
            out.append((len(out), [path[min(d, len(path) - 1)] for d in depths]))
        else:
            stack += [(node.rightChild(), path), (node.leftChild(), path)]
    return out


def depth_path(tree: DecisionTreeRegressionModel, df: DataFrame, depths: Sequence[int]) -> tuple[DataFrame, list[Column]]:
    """``df`` with, per depth, the prediction of the tree cut there; one pass, and a table of its leaves.

    The table came off the driver's own model, so it is sent to every task. Dealt by leaf, all rows would meet in as
    many tasks as the tree has leaves.
    """
    leaf = "__leaf"
    table = df.sparkSession.createDataFrame(_depth_predictions(tree, depths), "number int, cut array<double>")
    placed = tree.copy({tree.leafCol: leaf}).transform(df).withColumn("number", F.col(leaf).cast("int")).drop(leaf)
    return placed.join(F.broadcast(table), "number"), [F.col("cut")[i] for i in range(len(depths))]


def forest_path(forest: RandomForestRegressionModel, df: DataFrame, sizes: Sequence[int]) -> tuple[DataFrame, list[Column]]:
    """``df`` with, per size, the prediction of the forest's first trees; each tree predicts once."""
    total, out, first, trees = F.lit(0.0), [], 0, forest.trees
    features = forest.getFeaturesCol()
    by_size = {}
    for size in sorted(set(sizes)):
        name = f"__block{size}"
        df = forest_of(trees[first:size], features, name).transform(df)
        total, first = total + F.col(name) * (size - first), size
        by_size[size] = total / size
    out = [by_size[size] for size in sizes]
    return df, out


def boosting_path(model: GBTRegressionModel, df: DataFrame, label: str, rounds: Sequence[int]) -> list[float | None]:
    """R2 of the model after so many rounds, from one pass of losses."""
    spread = df.agg(F.var_pop(label)).first()[0]
    losses = model.evaluateEachIteration(df, "squared") if spread else []
    return [1 - losses[r - 1] / spread if spread else None for r in rounds]
