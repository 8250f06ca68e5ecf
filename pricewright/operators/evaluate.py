"""Tables over predictions and fold scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright.functions.numeric import r_squared
from pricewright.operators.explore import histogram
from pricewright.operators.features import invert_target

# t(0.975) with four degrees of freedom, normal 97.5 % quantile,
# and the limits of a stable fold spread.
T_FOUR = 2.776
Z_95 = 1.96
STABLE_STD = 0.03
STABLE_RANGE = 0.05

#: columns of a prediction table, on the scale of the label: log1p unless ``log=False``
ACTUAL, PREDICTED = "y_true_log", "y_pred_log"


def _amounts(log: bool) -> tuple[Column, Column]:
    return invert_target(F.col(ACTUAL), log), invert_target(F.col(PREDICTED), log)


def eval_metrics(predictions: DataFrame, by: Sequence[str] = (), *, log: bool = True) -> DataFrame:
    """R2 on both scales, MAE and RMSE in currency; one aggregate for all models.

    Without a log target both R2 are the one in currency.
    """
    actual, predicted = _amounts(log)
    error = actual - predicted
    return predictions.groupBy(*by).agg(
        F.bround(r_squared(F.col(ACTUAL), F.col(PREDICTED)), 4).alias("r2_log"),
        F.bround(r_squared(actual, predicted), 4).alias("r2_currency"),
        F.bround(F.avg(F.abs(error)), 0).alias("mae"),
        F.bround(F.sqrt(F.avg(error * error)), 0).alias("rmse"))


def cv_report(scores: DataFrame, folds: int) -> DataFrame:
    """Per model: every fold, mean, spread, 95 % interval and stability; best mean first."""
    k = F.count("r2")
    half = F.lit(T_FOUR) * F.stddev_pop("r2") / F.sqrt(k)
    summary = scores.groupBy("model").agg(
        *(F.bround(F.max(F.when(F.col("fold") == i, F.col("r2"))), 4).alias(f"fold_{i + 1}")
          for i in range(folds)),
        F.bround(F.avg("r2"), 4).alias("mean"), F.bround(F.stddev_pop("r2"), 4).alias("std"),
        F.bround(F.min("r2"), 4).alias("min"), F.bround(F.max("r2"), 4).alias("max"),
        F.bround(F.max("r2") - F.min("r2"), 4).alias("range"),
        F.bround(F.avg("r2") - half, 4).alias("ci_lower"), F.bround(F.avg("r2") + half, 4).alias("ci_upper"),
        (F.stddev_pop("r2") < STABLE_STD).alias("stable"))
    return summary.orderBy(F.desc("mean"), "model")


def cv_unstable(report: DataFrame, limit: float = STABLE_RANGE) -> DataFrame:
    return report.filter(F.col("range") > limit).select("model", "mean", "std", "min", "max", "range")


def cv_summary(metrics: DataFrame, folds: int) -> DataFrame:
    """Interval, stability and error-bar half width from stored mean and deviation."""
    half = F.lit(T_FOUR) * F.col("cv_std") / F.sqrt(F.lit(float(folds)))
    return (metrics.select("model", F.col("cv_mean").alias("mean"), F.col("cv_std").alias("std"),
                           F.bround(F.col("cv_mean") - half, 4).alias("ci_lower"),
                           F.bround(F.col("cv_mean") + half, 4).alias("ci_upper"),
                           (F.col("cv_std") < STABLE_STD).alias("stable"))
            .withColumn("error_bar", F.coalesce(F.col("mean") - F.col("ci_lower"), "std")))


def model_ranking(metrics: DataFrame) -> DataFrame:
    """Best first: CV mean, then smaller deviation, smaller RMSE, name. One row per model."""
    order = Window.orderBy(F.desc("cv_mean"), F.asc("cv_std"), F.asc("rmse"), F.asc("model"))
    return metrics.withColumn("rank", F.row_number().over(order)).orderBy("rank")


def serving_metrics(metrics: DataFrame) -> DataFrame:
    """CV R2, MAE and RMSE of the winner, as shown next to a score."""
    return model_ranking(metrics).filter("rank = 1").select(
        "model", F.col("cv_mean").alias("r2"), "mae", "rmse")


def residual_table(predictions: DataFrame, *, log: bool = True) -> DataFrame:
    """Actual, predicted and residual on both scales, keyed as the predictions are."""
    actual, predicted = _amounts(log)
    return (predictions.withColumn("residual_log", F.col(ACTUAL) - F.col(PREDICTED))
            .withColumn("actual", actual).withColumn("predicted", predicted)
            .withColumn("residual", F.col("actual") - F.col("predicted")))


def pred_vs_actual(predictions: DataFrame, *keep: str, log: bool = True) -> DataFrame:
    """Every point in currency with the limits of the y = x line."""
    points = predictions.select(*keep, *(c.alias(n) for c, n in zip(_amounts(log), ("actual", "predicted"))))
    limits = points.agg(F.least(F.min("actual"), F.min("predicted")).alias("lo"),
                        F.greatest(F.max("actual"), F.max("predicted")).alias("hi"))
    return (points.withColumn("line_lo", limits.select("lo").scalar())
            .withColumn("line_hi", limits.select("hi").scalar()))


def residual_hist(predictions: DataFrame, bins: int = 60, *, log: bool = True) -> DataFrame:
    """Histogram of currency residuals with the position of the mean line."""
    residuals = residual_table(predictions, log=log).select("residual")
    mean = residuals.agg(F.avg("residual").alias("m")).scalar()
    return histogram(residuals, "residual", bins).withColumn("mean_residual", mean)


def residual_std(predictions: DataFrame, *, log: bool = True) -> DataFrame:
    """Population deviation of currency residuals and the 95 % half width. One row."""
    return (residual_table(predictions, log=log).agg(F.stddev_pop("residual").alias("residual_std"))
            .withColumn("half_width", F.col("residual_std") * Z_95))
