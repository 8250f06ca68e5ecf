"""Scoring tables of requests with a fitted pipeline."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from pricewright.operators.evaluate import Z_95
from pricewright.operators.features import derive_features, invert_target
from pricewright.spec import TableSpec


def default_departure(requests: DataFrame, spec: TableSpec, lead: str = "Days_Before_Departure", *,
                      today: dt.date | None = None) -> DataFrame:
    """Requests without a departure date leave ``lead`` days from today."""
    start = F.current_date() if today is None else F.lit(today)
    assumed = F.date_add(start, F.col(lead).cast("int")).cast("timestamp_ntz")
    return requests.withColumn(spec.event_time, F.coalesce(F.col(spec.event_time), assumed))


def score_batch(requests: DataFrame, model: PipelineModel, spec: TableSpec) -> DataFrame:
    """Derive features as in training, predict on the label's scale, return currency.

    A request without one of the numeric inputs has a NULL prediction and the names of
    the absent inputs in ``missing_inputs``; it stops neither a batch nor a stream.
    Works on streams too: nothing here keeps state.
    """
    derived = derive_features(requests, spec)
    absent = F.concat_ws(",", *(F.when(F.col(c).isNull(), F.lit(c)) for c in spec.numeric if c in derived.columns))
    scored = model.transform(derived.withColumn("missing_inputs", F.nullif(absent, F.lit(""))))
    fare = F.when(F.col("missing_inputs").isNull(), invert_target(F.col("prediction"), spec.log_target))
    return scored.select(*(F.col(f"`{c}`") for c in requests.columns), fare.alias("predicted_fare"), "missing_inputs")


def score_interval(scored: DataFrame, interval: DataFrame | None = None,
                   serving: DataFrame | None = None) -> DataFrame:
    """Predicted amount with lower and upper bound, the lower one not under zero.

    Half width: 1.96 deviations of the stored residuals; without a usable
    deviation the stored MAE; without either, no bounds. Both are one-row
    tables and enter as scalar subqueries.
    """
    none = F.lit(None).cast("double")

    def stored(table: DataFrame | None, column: str):
        # an absent, missing or zero value does not count
        return none if table is None else F.nullif(
            table.agg(F.max(column).alias(column)).scalar(), F.lit(0.0))

    wide = F.coalesce(stored(interval, "residual_std") * Z_95, stored(serving, "mae"))
    half = scored.withColumn("_half", wide)
    fare = F.col("predicted_fare")
    return half.withColumns({
        "lower": F.when(F.col("_half").isNotNull(), F.greatest(F.lit(0.0), fare - F.col("_half"))),
        "upper": fare + F.col("_half"),
    }).drop("_half")
