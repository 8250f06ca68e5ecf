"""Derived columns, split, scaling, encoding."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from catalog.base import SPEC, fares, featured, raw, rounded, tickets
from fixtures.sql import query, r
from pricewright.operators import features
from pricewright.operators.clean import normalise_labels

_CATEGORICAL = SPEC.categorical
_NUMERIC = SPEC.numeric


def select_features(spark, sf):
    partial = featured(spark, sf).drop("Booking_Source", "Class")
    return features.select_features(partial, SPEC)


def log_target(spark, sf):
    logged = features.log_target(fares(spark, sf), SPEC, "y")
    return logged.select("rid", F.round("y", 9).alias("y"),
                         F.round(features.invert_target(F.col("y")) - F.col(SPEC.target), 3).alias("back_error"))


def split_summary(spark, sf):
    frame = featured(spark, sf)
    model = features.preprocess(frame.filter("NOT is_test"), SPEC)
    return features.split_summary(frame, len(features.feature_names(model)))


def standard_scale(spark, sf):
    frame = featured(spark, sf).withColumn("Constant", F.lit(7.0))
    scaled = features.standard_scale(frame.filter("NOT is_test"), frame, ["Duration_hrs", "Month", "Constant"])
    return scaled.select("rid", "Duration_hrs_z", "Month_z", "Constant_z")


def preprocess(spark, sf):
    """Mean of every encoded feature on both sides of the split, fitted on the training side."""
    frame = featured(spark, sf)
    model = features.preprocess(frame.filter("NOT is_test"), SPEC)
    means = (features.encode(frame, model, "is_test").groupBy("is_test")
             .agg(vector_to_array(Summarizer.mean(F.col("features"))).alias("m"))
             .select("is_test", F.posexplode("m").alias("pos", "mean")))
    names = features.feature_table(frame, features.feature_names(model))
    return means.join(F.broadcast(names), "pos").select("is_test", "pos", "name", "mean")


def feature_names(spark, sf):
    frame = featured(spark, sf)
    model = features.preprocess(frame.filter("NOT is_test"), SPEC)
    return features.feature_table(frame, features.feature_names(model))


def recombine_split(spark, sf):
    frame = featured(spark, sf).select("rid", "is_test", "Total_Fare")
    return features.recombine_split(frame.filter("NOT is_test"), frame.filter("is_test"))


def one_hot(spark, sf):
    frame = featured(spark, sf)
    # fitted on raw labels, applied to repaired ones: 'First' is unseen and encodes to zeros
    repaired = normalise_labels(frame, SPEC)
    return features.one_hot(frame.filter("NOT is_test"), repaired, "Class", "rid")


QUERIES = {
    "derive_features": lambda s, d: features.derive_features(fares(s, d), SPEC)
        .select("rid", "Month", "Weekday", "Stop_Type", "Route"),
    "value_counts": lambda s, d: features.value_counts(raw(s, d).withColumnRenamed("Stopovers", "Stop_Raw"), "Stop_Raw"),
    "calendar_range": lambda s, d: features.calendar_range(featured(s, d)),
    "select_features": select_features,
    "log_target": lambda s, d: rounded(log_target(s, d), 9),
    "target_skew": lambda s, d: rounded(features.target_skew(fares(s, d), SPEC)),
    "train_test_split": lambda s, d: featured(s, d).select("rid", "is_test", "fold"),
    "split_summary": split_summary,
    "standard_scale": lambda s, d: rounded(standard_scale(s, d), 9),
    "one_hot": one_hot,
    "preprocess": lambda s, d: rounded(preprocess(s, d), 6),
    "feature_names": feature_names,
    "recombine_split": recombine_split,
    "domain_values": lambda s, d: features.domain_values(
        featured(s, d), [c for c in SPEC.categorical]),
}

SKEW = "CASE WHEN min({v}) = max({v}) THEN 0 ELSE skewness({v}) END"


def _names() -> str:
    """Encoded names in order: numerics, then each categorical's training labels alphabetically."""
    parts = [f"SELECT {i} AS g, '' AS label, '{c}' AS name" for i, c in enumerate(_NUMERIC)]
    parts += [f"SELECT DISTINCT {len(_NUMERIC) + i}, {c}, '{c}_' || {c} FROM features WHERE NOT is_test"
              for i, c in enumerate(_CATEGORICAL)]
    return ("SELECT CAST(row_number() OVER (ORDER BY g, label) - 1 AS INTEGER) AS pos, name FROM ("
            + " UNION ALL ".join(parts) + ")")


def _encoded_means() -> str:
    scaled = [f"""SELECT is_test, '{c}' AS name, avg(({c} - m) / s) AS mean FROM features,
        (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM features WHERE NOT is_test) GROUP BY is_test"""
              for c in _NUMERIC]
    hot = [f"""SELECT t.is_test, '{c}_' || seen AS name, count(*) FILTER ({c} = seen) * 1.0 / count(*) AS mean
        FROM features t, (SELECT DISTINCT {c} AS seen FROM features WHERE NOT is_test) l
        GROUP BY t.is_test, seen""" for c in _CATEGORICAL]
    return " UNION ALL ".join(scaled + hot)


ORACLES = {
    "derive_features": query("features", "SELECT rid, Month, Weekday, Stop_Type, Route FROM features"),
    "value_counts": query("dirty", "SELECT Stop_Raw, count(*) AS count FROM dirty WHERE Stop_Raw IS NOT NULL GROUP BY 1"),
    "calendar_range": query("features", """SELECT min(Month) AS min_month, max(Month) AS max_month,
      min(Weekday) AS min_weekday, max(Weekday) AS max_weekday FROM features"""),
    "select_features": query("features", """SELECT Airline, Source, Destination, Season, Stop_Type, Aircraft_Type,
      Duration_hrs, Days_Before_Departure, Month, Weekday FROM features"""),
    "log_target": query("features", f"""SELECT rid, {r('label', 9)} AS y,
      {r('exp(label) - 1 - Total_Fare', 3)} AS back_error FROM features"""),
    "target_skew": query("features", " UNION ALL ".join(
        f"SELECT '{s}' AS scale, {r(f'min({v})')} AS min, {r(f'max({v})')} AS max, {r(f'avg({v})')} AS mean, "
        f"{r(SKEW.format(v=v))} AS skew FROM features" for s, v in (("raw", "Total_Fare"), ("log1p", "label")))),
    "train_test_split": query("features", "SELECT rid, is_test, fold FROM features"),
    "split_summary": query("features", f"""SELECT is_test, count(*) AS rows,
      (SELECT CAST(count(*) AS INTEGER) FROM ({_names()})) AS encoded_width FROM features GROUP BY is_test"""),
    "standard_scale": query("features", f"""
      SELECT rid, {r('(Duration_hrs - md) / sd', 9)} AS Duration_hrs_z, {r('(Month - mm) / sm', 9)} AS Month_z,
        CAST(0.0 AS DOUBLE) AS Constant_z FROM features, (SELECT avg(Duration_hrs) AS md, stddev_pop(Duration_hrs) AS sd,
        avg(Month) AS mm, stddev_pop(Month) AS sm FROM features WHERE NOT is_test)"""),
    "one_hot": query("features", """SELECT rid, 'Class_' || seen AS feature,
      CAST(1 AS INTEGER) AS value FROM features JOIN (SELECT DISTINCT Class AS seen FROM features WHERE NOT is_test)
      ON seen = CASE Class WHEN 'First Class' THEN 'First' ELSE Class END"""),
    "preprocess": query("features", f"""SELECT is_test, pos, name, {r('mean', 6)} AS mean
      FROM ({_encoded_means()}) JOIN ({_names()}) USING (name)"""),
    "feature_names": query("features", _names()),
    "recombine_split": query("features", "SELECT rid, is_test, Total_Fare FROM features"),
    "domain_values": query("features", " UNION ALL ".join(
        f"""SELECT DISTINCT '{c}' AS "column", {c} AS value FROM features""" for c in _CATEGORICAL)),
}
