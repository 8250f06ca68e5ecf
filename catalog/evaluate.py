"""Evaluation over a prediction table and a fold-score table that SQL can derive as well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from catalog.base import SPEC, featured, rounded
from catalog.explore import hist_sql
from fixtures import views
from fixtures.sql import query, r
from pricewright.functions.numeric import r_squared
from pricewright.operators import evaluate
from pricewright.sources import artifacts
from pricewright.staging import new_path, staged

#: "models" of the score tables: group means by one column each
_MODELS = ("Class", "Season", "Airline", "Stop_Type")
_LIMITS = (evaluate.STABLE_RANGE, 0.002)


def predictions(spark, sf):
    """Test rows with the training mean of their cabin and season."""
    frame = featured(spark, sf)
    means = staged(frame.filter("NOT is_test").groupBy("Class", "Season")
                   .agg(F.avg("label").alias(evaluate.PREDICTED)), "means")
    return (frame.filter("is_test").join(means, ["Class", "Season"])
            .select("rid", F.col("label").alias(evaluate.ACTUAL), evaluate.PREDICTED))


def _out_of_fold(frame, column):
    """Each training row with the mean of its group over the other folds."""
    sums = frame.groupBy(column, "fold").agg(F.sum("label").alias("s"), F.count("label").alias("n"))
    group = Window.partitionBy(column)
    others = (F.sum("s").over(group) - F.col("s")) / (F.sum("n").over(group) - F.col("n"))
    # one row per group and fold, written so that its size decides the join
    means = staged(sums.select(column, "fold", others.alias(evaluate.PREDICTED)), "means")
    return frame.join(means, [column, "fold"]).select(
        F.lit(column).alias("model"), "fold", F.col("label").alias(evaluate.ACTUAL), evaluate.PREDICTED)


def _all_models(spark, sf):
    """Written once: the score tables above it are read several times."""
    frame = featured(spark, sf).filter("NOT is_test").select(*_MODELS, "fold", "label")
    return views._once(spark, sf, "all_models", lambda: reduce(
        DataFrame.unionByName, (_out_of_fold(frame, c) for c in _MODELS)))


def _fold_r2(rows):
    return rows.groupBy("model", "fold").agg(
        r_squared(F.col(evaluate.ACTUAL), F.col(evaluate.PREDICTED)).alias("r2"))


def fold_scores(spark, sf):
    return _fold_r2(_all_models(spark, sf))


def metrics(spark, sf):
    """One row per model: fold statistics and error metrics."""
    rows = _all_models(spark, sf)
    cv = _fold_r2(rows).groupBy("model").agg(
        F.bround(F.avg("r2"), 4).alias("cv_mean"), F.bround(F.stddev_pop("r2"), 4).alias("cv_std"))
    return evaluate.eval_metrics(rows, ["model"]).join(cv, "model")


def cv_report(spark, sf):
    return evaluate.cv_report(fold_scores(spark, sf), SPEC.folds)


def cv_unstable(spark, sf):
    """With the usual limit and with one that some of these models exceed."""
    report = cv_report(spark, sf)
    return reduce(DataFrame.unionByName, (
        evaluate.cv_unstable(report, limit).withColumn("limit", F.lit(limit)) for limit in _LIMITS))


def interval_store(spark, sf):
    path = new_path(spark, "interval")
    artifacts.write_interval(evaluate.residual_std(predictions(spark, sf)), path)
    return rounded(artifacts.read_interval(spark, path))


def _amounts_rounded(df):
    """Currency to one decimal, logs to six."""
    return rounded(df.withColumns({c: F.round(c, 1) for c in ("actual", "predicted", "residual")}), 6)


QUERIES = {
    "cv_report": lambda s, d: rounded(cv_report(s, d)),
    "cv_unstable": lambda s, d: rounded(cv_unstable(s, d)),
    "cv_summary": lambda s, d: rounded(evaluate.cv_summary(metrics(s, d), SPEC.folds)),
    "eval_metrics": lambda s, d: rounded(evaluate.eval_metrics(predictions(s, d))),
    "model_ranking": lambda s, d: rounded(evaluate.model_ranking(metrics(s, d))),
    "residual_table": lambda s, d: _amounts_rounded(evaluate.residual_table(predictions(s, d))),
    "pred_vs_actual": lambda s, d: rounded(evaluate.pred_vs_actual(predictions(s, d), "rid"), 1),
    "residual_hist": lambda s, d: rounded(evaluate.residual_hist(predictions(s, d))),
    "residual_std": lambda s, d: rounded(evaluate.residual_std(predictions(s, d))),
    "interval_store": interval_store,
}

PREDICTIONS = """p AS (SELECT rid, label AS t, m AS e FROM features JOIN (
    SELECT Class, Season, avg(label) AS m FROM features WHERE NOT is_test GROUP BY Class, Season)
  USING (Class, Season) WHERE is_test)"""
_RESIDUAL = "(exp(t) - exp(e))"


def _errors(t: str, e: str) -> str:
    return f"""round_even(1 - avg(({t} - {e}) * ({t} - {e})) / var_pop({t}), 4) AS r2_log,
      round_even(1 - avg((exp({t}) - exp({e})) * (exp({t}) - exp({e}))) / var_pop(exp({t})), 4) AS r2_currency,
      round_even(avg(abs(exp({t}) - exp({e}))), 0) AS mae,
      round_even(sqrt(avg((exp({t}) - exp({e})) * (exp({t}) - exp({e})))), 0) AS rmse"""


_FOLDS = "o AS (" + " UNION ALL ".join(f"""
  SELECT '{c}' AS model, fold, label AS t, (ts - s) / (tn - n) AS e
  FROM (SELECT * FROM features WHERE NOT is_test)
  JOIN (SELECT {c}, fold, sum(label) AS s, count(*) AS n FROM features WHERE NOT is_test GROUP BY ALL) USING ({c}, fold)
  JOIN (SELECT {c}, sum(label) AS ts, count(*) AS tn FROM features WHERE NOT is_test GROUP BY ALL) USING ({c})"""
    for c in _MODELS) + """),
  f AS (SELECT model, fold, 1 - avg((t - e) * (t - e)) / var_pop(t) AS r2 FROM o GROUP BY model, fold),
  m AS (SELECT * FROM (SELECT model, """ + _errors("t", "e") + """ FROM o GROUP BY model) JOIN
    (SELECT model, round_even(avg(r2), 4) AS cv_mean, round_even(stddev_pop(r2), 4) AS cv_std FROM f GROUP BY model)
    USING (model))"""

_REPORT = "SELECT model, " + ", ".join(
    f"{r(f'max(r2) FILTER (fold = {i})')} AS fold_{i + 1}" for i in range(SPEC.folds)) + f""",
  {r('avg(r2)')} AS mean, {r('stddev_pop(r2)')} AS std, {r('min(r2)')} AS min, {r('max(r2)')} AS max,
  {r('max(r2) - min(r2)')} AS range, {r('avg(r2) - 2.776 * stddev_pop(r2) / sqrt(5)')} AS ci_lower,
  {r('avg(r2) + 2.776 * stddev_pop(r2) / sqrt(5)')} AS ci_upper, stddev_pop(r2) < 0.03 AS stable
  FROM f GROUP BY model"""


def _over(ctes: str, body: str) -> str:
    return query("features", f"SELECT * FROM (WITH {ctes} {body})")


ORACLES = {
    "cv_report": _over(_FOLDS, _REPORT),
    "cv_unstable": _over(_FOLDS, " UNION ALL ".join(
        f"""SELECT model, mean, std, min, max, range, CAST({limit!r} AS DOUBLE) AS "limit"
        FROM ({_REPORT}) WHERE range > {limit!r}""" for limit in _LIMITS)),
    "cv_summary": _over(_FOLDS, f"""SELECT model, cv_mean AS mean, cv_std AS std,
      {r('cv_mean - 2.776 * cv_std / sqrt(5)')} AS ci_lower, {r('cv_mean + 2.776 * cv_std / sqrt(5)')} AS ci_upper,
      cv_std < 0.03 AS stable, {r('cv_mean - round(cv_mean - 2.776 * cv_std / sqrt(5), 4)')} AS error_bar FROM m"""),
    "eval_metrics": _over(PREDICTIONS, f"SELECT {_errors('t', 'e')} FROM p"),
    "model_ranking": _over(_FOLDS, """SELECT *, CAST(row_number() OVER (
      ORDER BY cv_mean DESC, cv_std, rmse, model) AS INTEGER) AS rank FROM m"""),
    "residual_table": _over(PREDICTIONS, f"""SELECT rid, {r('t', 6)} AS y_true_log, {r('e', 6)} AS y_pred_log,
      {r('t - e', 6)} AS residual_log, {r('exp(t) - 1', 1)} AS actual, {r('exp(e) - 1', 1)} AS predicted,
      {r(_RESIDUAL, 1)} AS residual FROM p"""),
    "pred_vs_actual": _over(PREDICTIONS, f"""SELECT rid, {r('exp(t) - 1', 1)} AS actual, {r('exp(e) - 1', 1)} AS predicted,
      {r('least(min(exp(t)) OVER (), min(exp(e)) OVER ()) - 1', 1)} AS line_lo,
      {r('greatest(max(exp(t)) OVER (), max(exp(e)) OVER ()) - 1', 1)} AS line_hi FROM p"""),
    "residual_hist": _over(PREDICTIONS, f"""SELECT *, (SELECT {r(f'avg({_RESIDUAL})')} FROM p) AS mean_residual
      FROM ({hist_sql(f'SELECT {_RESIDUAL} AS v FROM p')})"""),
    "residual_std": _over(PREDICTIONS, f"""SELECT {r(f'stddev_pop({_RESIDUAL})')} AS residual_std,
      {r(f'1.96 * stddev_pop({_RESIDUAL})')} AS half_width FROM p"""),
    "interval_store": _over(PREDICTIONS, f"SELECT {r(f'stddev_pop({_RESIDUAL})')} AS residual_std FROM p"),
}
