"""Inputs and output shaping shared by the sections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fixtures import views
from pricewright.operators import clean, features
from pricewright.sources.tables import null_tokens
from pricewright.spec import AIRFARES as SPEC

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles to ``digits`` decimals, without negative zero."""
    return df.select(*(
        (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema.fields))


def dated(df: DataFrame) -> DataFrame:
    """Timestamps as text, which every engine prints alike."""
    return df.select(*(F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
                       if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
                       for f in df.schema.fields))


def fares(spark: SparkSession, sf: str) -> DataFrame:
    return views.fares(spark, sf)


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    """The fare table as it would arrive, without the row key."""
    return fares(spark, sf).drop("rid")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return views.raw_fares(spark, sf)


def typed(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(raw(spark, sf))


def _typed(rows: DataFrame) -> DataFrame:
    return clean.coerce_types(clean.rename_columns(null_tokens(rows), SPEC), SPEC)


def typed_stage(spark: SparkSession, sf: str) -> DataFrame:
    """The typed table as the cleaning run stages it: multi-pass operators read columns, not text.

    Typing passes over the text once, so the text is not written for it.
    """
    return views.once_from_raw(spark, sf, "typed", _typed)


def in_range(spark: SparkSession, sf: str) -> DataFrame:
    return clean.range_filter(typed_stage(spark, sf), SPEC)


def unique(spark: SparkSession, sf: str) -> DataFrame:
    """The deduplicated stage of the cleaning run."""
    return views._once(spark, sf, "unique", lambda: clean.distinct_pieces(
        clean.normalise_labels(in_range(spark, sf), SPEC)))


def featured(spark: SparkSession, sf: str) -> DataFrame:
    """Fares with derived features, split, folds and the log target."""
    derived = features.derive_features(fares(spark, sf), SPEC)
    return features.log_target(features.train_test_split(derived, SPEC, "rid"), SPEC)
