"""First look at a table: shape, types, missing values, spread, repeats."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pricewright.functions.numeric import finite, percent
from pricewright.functions.quantiles import column_quantiles


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def quoted(name: str) -> str:
    return f"`{name}`"


def profile_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _cells(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Long form (column, value) of columns of one type."""
    names = [F.col(quoted(f.name)) for f in fields]
    return df.select(*names).unpivot([], names, "column", "value")


def _by_type(df: DataFrame) -> list[list[T.StructField]]:
    groups: dict[str, list[T.StructField]] = {}
    for field in df.schema.fields:
        groups.setdefault(field.dataType.simpleString(), []).append(field)
    return list(groups.values())


def profile_columns(df: DataFrame, *, approximate: bool = False) -> DataFrame:
    """Type, nulls, null percentage and distinct values of every column.

    Exact distinct counts group cells by (column, value) first, which spreads a
    wide column over all tasks and folds repeated values before the shuffle.
    ``approximate`` keeps one sketch per column and shuffles only those.
    """
    def counted(fields: Sequence[T.StructField]) -> DataFrame:
        cells = _cells(df, fields)
        if approximate:
            return cells.groupBy("column").agg(
                F.count(F.lit(1)).alias("rows"), F.count("value").alias("seen"),
                F.approx_count_distinct("value").alias("unique"))
        per_value = cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        return per_value.groupBy("column").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("seen"),
            F.count("value").alias("unique"))

    per_column = reduce(DataFrame.unionByName, (counted(fields) for fields in _by_type(df)))
    types = df.sparkSession.createDataFrame([(i, f.name, f.dataType.simpleString())
                                             for i, f in enumerate(df.schema.fields)],
                                            "position int, column string, dtype string")
    nulls = F.coalesce(F.col("rows") - F.col("seen"), F.lit(0))
    return (types.join(per_column, "column", "left")
            .select("position", "column", "dtype", nulls.alias("null_count"),
                    percent(nulls, F.col("rows"), 2).alias("null_pct"),
                    F.coalesce("unique", F.lit(0)).alias("unique")))


def sample_rows(df: DataFrame, n: int = 5, order: Sequence[str] | None = None) -> DataFrame:
    """The first rows in a stated order, so that the sample is the same on every run."""
    return df.orderBy(*(F.col(quoted(c)) for c in order or df.columns)).limit(n)


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, sample std, min, quartiles, max; one row per numeric column. NaN and infinite values are missing."""
    columns = list(columns or numeric_columns(df))
    values = df.select(*(finite(F.col(quoted(c)).cast("double")).alias(c) for c in columns))
    wide = values.agg(*(agg.alias(f"{name}{i}") for i, c in enumerate(columns) for name, agg in _moments(F.col(quoted(c)))))
    moments = wide.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), *(
        F.col(f"{name}{i}").alias(name) for name in ("count", "mean", "std", "min", "max")))
        for i, c in enumerate(columns)))))
    quartiles = column_quantiles(values, columns, [0.25, 0.5, 0.75], names=["p25", "p50", "p75"])
    return (moments.join(F.broadcast(quartiles), "column", "left")
            .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def _moments(value: Column) -> list[tuple[str, Column]]:
    return [("count", F.count(value)), ("mean", F.avg(value)), ("std", F.stddev_samp(value)),
            ("min", F.min(value)), ("max", F.max(value))]


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row; NULLs count as equal."""
    copies = df.groupBy(*(F.col(quoted(c)) for c in df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, null_count, rows) from one aggregate over the table."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                     *(F.count(quoted(c)).alias(f"_{i}") for i, c in enumerate(df.columns)))
    return counted.select(F.inline(F.array(*(
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                 (F.col("_rows") - F.col(f"_{i}")).alias("null_count"), F.col("_rows").alias("rows"))
        for i, c in enumerate(df.columns)))))


def null_columns(df: DataFrame) -> DataFrame:
    return null_counts(df).filter("null_count > 0").select("column", "null_count")


def value_range(df: DataFrame, *candidates: str) -> DataFrame:
    """min/max of the first candidate column the table has (raw or renamed name)."""
    column = next((c for c in candidates if c in df.columns), None)
    if column is None:
        raise ValueError(f"none of {candidates} in the table")
    value = F.col(quoted(column)).cast("double")
    return df.agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))
