"""Batch and stream scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from catalog.base import SPEC, fares, rounded
from catalog.evaluate import PREDICTIONS, predictions
from catalog.models import AIRLINE, AIRLINE_RIDGE, DURATION, train_rows
from fixtures.sql import query, r
from pricewright.operators import evaluate, models, score
from pricewright.staging import new_path, staged
from pricewright.streaming.score_stream import request_stream, score_stream

_REQUEST = ("rid", "Airline", "Source", "Destination", "Class", "Aircraft_Type", "Booking_Source", "Season",
            "Stop_Raw", "Duration_hrs", "Days_Before_Departure", "Date")


def _requests(spark, sf):
    """Every ticket as an unpriced request."""
    return fares(spark, sf).select(*_REQUEST)


def _pipeline(spark, sf):
    train, prep = train_rows(spark, sf, DURATION)
    return PipelineModel(stages=[*prep.stages, models.fit("linear", {}, train)])


def score_batch(spark, sf):
    scored = score.score_batch(_requests(spark, sf), _pipeline(spark, sf), DURATION)
    return rounded(scored.select("rid", "Duration_hrs", "predicted_fare"), 2)


def score_interval(spark, sf):
    """All three cases: stored deviation, zero deviation with MAE, nothing stored."""
    scored = predictions(spark, sf).select("rid", F.expm1(evaluate.PREDICTED).alias("predicted_fare"))
    interval = evaluate.residual_std(predictions(spark, sf))
    serving = evaluate.eval_metrics(predictions(spark, sf))
    cases = {"std": (interval, serving), "mae": (interval.withColumn("residual_std", F.lit(0.0)), serving),
             "none": (None, None)}
    out = None
    for case, (i, s) in cases.items():
        part = score.score_interval(scored, i, s).withColumn("case", F.lit(case))
        out = part if out is None else out.unionByName(part)
    return rounded(out.groupBy("case", "predicted_fare", "lower", "upper").agg(F.count(F.lit(1)).alias("n")), 3)


def score_unseen(spark, sf):
    """Known airlines next to the same requests under a name no training row has."""
    train, prep = train_rows(spark, sf, AIRLINE)
    model = PipelineModel(stages=[*prep.stages, models.fit("ridge", {"alpha": 10.0}, train)])
    known = _requests(spark, sf)
    unseen = known.withColumn("Airline", F.concat(F.lit("New "), "Airline"))
    scored = score.score_batch(known.unionByName(unseen), model, AIRLINE)
    return rounded(scored.groupBy("Airline").agg(F.min("predicted_fare").alias("predicted_fare"),
                                                 F.count(F.lit(1)).alias("n")), 3)


def stream(spark, sf):
    arriving = new_path(spark, "arriving")
    _requests(spark, sf).write.parquet(arriving)
    requests = request_stream(spark, arriving, _requests(spark, sf).schema)
    target = new_path(spark, "scored")
    score_stream(requests, _pipeline(spark, sf), DURATION, target, new_path(spark, "progress")).awaitTermination()
    return rounded(spark.read.parquet(target).select("rid", "Duration_hrs", "predicted_fare"), 2)


QUERIES = {
    "score_batch": score_batch,
    "score_interval": score_interval,
    "score_unseen": score_unseen,
    "score_stream": stream,
}

_LINE = f"""SELECT rid, {r('Duration_hrs', 2)} AS Duration_hrs,
  {r('exp(a + b * Duration_hrs) - 1', 2)} AS predicted_fare FROM features,
  (SELECT regr_slope(label, Duration_hrs) AS b, regr_intercept(label, Duration_hrs) AS a
   FROM features WHERE NOT is_test)"""

ORACLES = {
    "score_batch": query("features", _LINE),
    "score_stream": query("features", _LINE),
    "score_unseen": query("features", f"""SELECT * FROM ({AIRLINE_RIDGE},
      n AS (SELECT Airline, count(*) AS n FROM features GROUP BY Airline)
      SELECT Airline, {r('exp(b + w) - 1', 3)} AS predicted_fare, n FROM w JOIN n USING (Airline)
      UNION ALL SELECT 'New ' || Airline, {r('exp(b) - 1', 3)}, n FROM w JOIN n USING (Airline))"""),
    "score_interval": query("features", f"""SELECT * FROM (WITH {PREDICTIONS},
      h AS (SELECT 1.96 * stddev_pop(exp(t) - exp(e)) AS std, round_even(avg(abs(exp(t) - exp(e))), 0) AS mae FROM p),
      c AS (SELECT 'std' AS "case", std AS half FROM h UNION ALL SELECT 'mae', mae FROM h UNION ALL SELECT 'none', NULL)
      SELECT "case", {r('exp(e) - 1', 3)} AS predicted_fare,
        {r('CASE WHEN half IS NOT NULL THEN greatest(0, exp(e) - 1 - half) END', 3)} AS lower,
        {r('exp(e) - 1 + half', 3)} AS upper, count(*) AS n FROM p, c GROUP BY "case", e, half)"""),
}
