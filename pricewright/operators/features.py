"""Derived columns, target transform, split, scaling and one-hot encoding."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from pricewright.functions.numeric import FOLD_STREAM, TEST_STREAM, bucket, unbiased_skew
from pricewright.spec import TableSpec

log = logging.getLogger(__name__)

_SPLIT_UNITS = 10_000


def derive_features(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Month, Weekday (Monday = 0), Stop_Type and the Route label."""
    direct = F.lower(F.trim(F.col(spec.stops))) == spec.direct
    return (df.withColumn("Month", F.month(spec.event_time))
              .withColumn("Weekday", F.weekday(spec.event_time))
              # a missing label counts as a stop
              .withColumn("Stop_Type", F.when(direct, "Non_Stop").otherwise("With_Stop"))
              .withColumn("Route", F.concat(spec.origin, F.lit("→"), spec.destination)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency per present value, most frequent first, ties by value."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column))


def calendar_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min("Month").alias("min_month"), F.max("Month").alias("max_month"),
                  F.min("Weekday").alias("min_weekday"), F.max("Weekday").alias("max_weekday"))


def present_features(df: DataFrame, spec: TableSpec) -> tuple[list[str], list[str]]:
    """Configured categorical and numeric features the table has; warns about the others."""
    have = set(df.columns)
    missing = [c for c in spec.categorical + spec.numeric if c not in have]
    if missing:
        log.warning("configured features missing: %s", missing)
    return [c for c in spec.categorical if c in have], [c for c in spec.numeric if c in have]


def select_features(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    categorical, numeric = present_features(df, spec)
    return df.select(*keep, *categorical, *numeric)


def log_target(df: DataFrame, spec: TableSpec, name: str = "label") -> DataFrame:
    """The learners' label: log1p of the target, or the target itself if the spec says so."""
    y = F.col(spec.target).cast("double")
    return df.withColumn(name, F.log1p(y) if spec.log_target else y)


def invert_target(column: Column, log: bool = True) -> Column:
    """Back to currency."""
    return F.expm1(column) if log else column


def target_skew(df: DataFrame, spec: TableSpec) -> DataFrame:
    """min, max, mean and adjusted skew of the target before and after log1p."""
    raw = F.col(spec.target).cast("double")
    out = []
    for scale, y in (("raw", raw), ("log1p", F.log1p(raw))):
        out += [F.min(y).alias(f"{scale}_min"), F.max(y).alias(f"{scale}_max"),
                F.avg(y).alias(f"{scale}_mean"), unbiased_skew(y).alias(f"{scale}_skew")]
    wide = df.agg(*out)
    return wide.select(F.inline(F.array(*(
        F.struct(F.lit(s).alias("scale"), *(F.col(f"{s}_{m}").alias(m) for m in ("min", "max", "mean", "skew")))
        for s in ("raw", "log1p")))))


def row_key(df: DataFrame) -> DataFrame:
    """Content key for tables without one: equal rows share a key and thus a side of the split."""
    return df.withColumn("row_key", F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))


def train_test_split(df: DataFrame, spec: TableSpec, key: str) -> DataFrame:
    """Mark each row as test or train and give it a fold, by its key alone."""
    return (df.withColumn("is_test", bucket(key, _SPLIT_UNITS, spec.seed, TEST_STREAM)
                          < round(spec.test_share * _SPLIT_UNITS))
              .withColumn("fold", bucket(key, spec.folds, spec.seed, FOLD_STREAM)))


def split_summary(df: DataFrame, width: int) -> DataFrame:
    """Rows per side and the encoded width."""
    return (df.groupBy("is_test").agg(F.count(F.lit(1)).alias("rows"))
              .withColumn("encoded_width", F.lit(width)))


def recombine_split(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.unionByName(test)


def domain_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct present values per categorical, long form."""
    return (df.select(*columns).unpivot([], list(columns), "column", "value")
              .filter("value IS NOT NULL").distinct())


# -- fitted stages -----------------------------------------------------------

def scale_statistics(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column scales by one."""
    row = train.agg(*(F.avg(c).alias(f"m_{c}") for c in columns),
                    *(F.stddev_pop(c).alias(f"s_{c}") for c in columns)).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in columns}


def scaler(train: DataFrame, columns: Sequence[str]) -> SQLTransformer:
    """Standardisation as a projection with the training statistics as literals.

    MLlib's own scaler divides by the sample deviation; this one by the
    population deviation. The stage saves and loads with its pipeline.
    """
    scaled = "".join(f", (CAST(`{c}` AS DOUBLE) - {m!r}D) / {s!r}D AS `{c}_z`"
                     for c, (m, s) in scale_statistics(train, columns).items())
    return SQLTransformer(statement=f"SELECT *{scaled} FROM __THIS__")


def standard_scale(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return scaler(train, columns).transform(df)


def one_hot_stages(columns: Sequence[str]) -> list:
    """Alphabetical 0/1 columns; NULL and unseen labels encode to all zeros.

    The indexer sends them to one extra index and the encoder drops that last slot.
    """
    if not columns:
        return []
    return [StringIndexer(inputCols=list(columns), outputCols=[f"{c}_ix" for c in columns],
                          handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=[f"{c}_ix" for c in columns],
                          outputCols=[f"{c}_hot" for c in columns],
                          dropLast=True, handleInvalid="error")]


def one_hot(train: DataFrame, df: DataFrame, column: str, key: str) -> DataFrame:
    """Long form (key, feature, value): the ones only. A label not seen in training has no row, a zero neither."""
    seen = train.select(F.col(column).alias("category")).distinct()
    return (df.select(key, F.col(column).alias("category")).join(seen, "category", "left_semi")
              .select(key, F.concat(F.lit(f"{column}_"), "category").alias("feature"), F.lit(1).alias("value")))


def preprocess(train: DataFrame, spec: TableSpec) -> PipelineModel:
    """Scaled numerics, then one-hot categoricals, in ``features``; fitted on ``train`` only.

    Works with whichever configured features the table has.
    """
    categorical, numeric = present_features(train, spec)
    stages = [scaler(train, numeric)] if numeric else []
    stages += one_hot_stages(categorical)
    stages.append(VectorAssembler(
        inputCols=[f"{c}_z" for c in numeric] + [f"{c}_hot" for c in categorical],
        outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def feature_names(model: PipelineModel) -> list[str]:
    """Names in vector order: numerics as they are, then ``Column_label``."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    names = [c[:-2] for c in assembler.getInputCols() if c.endswith("_z")]
    for stage in model.stages:
        if hasattr(stage, "labelsArray"):
            for column, labels in zip(stage.getInputCols(), stage.labelsArray):
                names += [f"{column}_{label}" for label in labels]
    return names


def feature_table(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.sparkSession.createDataFrame(list(enumerate(names)), T.StructType([
        T.StructField("pos", T.IntegerType()), T.StructField("name", T.StringType())]))


def encode(df: DataFrame, model: PipelineModel, *keep: str) -> DataFrame:
    """Only the vector and the named columns: everything else is dropped."""
    return model.transform(df).select(*keep, "features")
