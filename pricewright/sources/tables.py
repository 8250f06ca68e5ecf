"""Header CSV in, reports and stage tables out, and the gates in front of a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pricewright.functions.numeric import parse_double

# The texts pandas.read_csv takes as missing by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def scan_csv(spark: SparkSession, path: str, *, hint: str = "", multi_line: bool = False) -> DataFrame:
    """Header CSV as text columns with the null tokens already NULL.

    Types are never inferred (that would be one more pass over the file);
    ``coerce_types`` gives the columns their contract types. Nothing is lost silently:
    reading fails on a row with more or fewer cells than the header, and on a file of a
    folder whose header differs. ``multi_line`` allows line breaks inside quotes, at
    the price of one task per file.
    """
    try:
        raw = (spark.read.option("columnPruning", False)
               .csv(path, header=True, inferSchema=False, quote='"', escape='"', enforceSchema=False,
                    multiLine=multi_line, mode="FAILFAST"))
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no data at '{path}'. {hint}".strip()) from error
        raise
    return null_tokens(raw)


#: columns of the table of refused rows
REFUSED = ("file", "reason", "raw")
_RAW = "__refused_row"


class TooManyRefused(ValueError):
    """More rows were refused than the gate allows; they have been written."""


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files by header line. The first line of a file is the first of the piece that starts at its beginning."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    first = lines.where("file_block_start = 0").withColumn("n", F.monotonically_increasing_id()).groupBy(
        "file_path").agg(F.min_by("value", "n").alias("header"))
    return {r["header"]: r["files"] for r in first.groupBy("header").agg(
        F.sort_array(F.collect_list("file_path")).alias("files")).collect()}


def _refusal(raw: Column, width: int) -> Column:
    """Why a line is no row: an open quote, or more or fewer cells than its header."""
    cells = F.length(F.regexp_replace(F.regexp_replace(raw, '"[^"]*"', ""), "[^,]", "")) + 1
    odd = F.length(F.regexp_replace(raw, '[^"]', "")) % 2 == 1
    return F.when(odd, "open quote").when(cells > width, "too many cells").when(
        cells < width, "too few cells").otherwise("malformed")


def scan_quarantined(spark: SparkSession, path: str, refused: str, *, limit: float = 0.05, hint: str = "") -> DataFrame:
    """Header CSV as text columns, by name; rows that are none go to the table ``refused`` instead of stopping the job.

    Files of a folder may order their columns differently or lack some, which are then NULL. ``refused`` gets
    file, reason and the line as it stands (Parquet, overwritten). More than ``limit`` refused
    of all rows raise ``TooManyRefused`` once they are written. Line breaks inside quotes are not read here,
    see ``scan_csv``. One pass reads the headers, one writes the refused rows and counts them.
    """
    try:
        headers = _headers(spark, path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no data at '{path}'. {hint}".strip()) from error
        raise
    parts = []
    for header, files in sorted(headers.items()):
        # Spark splits the header line itself: quotes, blanks and repeated names are as in any other file
        names = spark.read.csv(files[0], header=True, quote='"', escape='"').columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _RAW]])
        # all cells are parsed whatever is asked for, or a ragged row would pass; and Spark refuses a plan that
        # asks for nothing but the refused line, so it takes an empty piece of a cell along
        rows = spark.read.schema(schema).option("columnPruning", False).csv(
            files, header=True, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=_RAW)
        line = F.concat(F.col(_RAW), F.left(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), F.lit(0)))
        parts.append(rows.select(*(F.col(f"`{c}`") for c in names), line.alias(_RAW), F.col("_metadata.file_path").alias("__file"),
                                 F.lit(len(names)).alias("__width")))
    if not parts:
        raise ValueError(f"'{path}' holds no file with a header")
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    bad = whole.where(F.col(_RAW).isNotNull()).select(
        F.col("__file").alias("file"), _refusal(F.col(_RAW), F.col("__width")).alias("reason"), F.col(_RAW).alias("raw"))
    bad.write.mode("overwrite").parquet(refused)
    total, lost = whole.agg(F.count(F.lit(1)), F.count(_RAW)).first()
    if lost > limit * total:
        raise TooManyRefused(f"{lost} of {total} rows of '{path}' are no rows; see '{refused}'")
    return null_tokens(whole.where(F.col(_RAW).isNull()).drop(_RAW, "__file", "__width"))


def refused_counts(refused: DataFrame) -> DataFrame:
    """Refused rows per reason."""
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "reason")


def null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Replace the missing-value texts of every text column by NULL."""
    def clean(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            column = F.when(~column.isin(*tokens), column)
        return column.alias(field.name)

    return df.select(*(clean(f) for f in df.schema.fields))


def presence(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: is it in the table, and in how many rows does it have a value. One aggregate."""
    have = set(df.columns)
    counted = df.agg(*(F.count(F.col(f"`{c}`") if c in have else F.lit(None)).alias(f"_{i}")
                       for i, c in enumerate(columns)), F.count(F.lit(1)).alias("_rows"))
    cells = [F.struct(F.lit(c).alias("column"), F.lit(c in have).alias("present"), F.col(f"_{i}").alias("rows"))
             for i, c in enumerate(columns)]
    kind = "array<struct<column:string,present:boolean,rows:bigint>>"
    return counted.select(F.inline(F.array(*cells).cast(kind)))


def header_gate(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Which required raw columns the table has, and how many rows fill them."""
    return presence(df, required)


def require_header(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in set(df.columns)]
    if missing:
        raise ValueError(f"source is missing columns: {missing}")
    return df


def min_value_gate(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """How many rows reach the minimum; scans that one column."""
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.StringType):
        value = parse_double(value)
    return df.select(value.alias("v")).agg(F.count_if(F.col("v") >= minimum).alias("valid_rows"))


def require_min_value(df: DataFrame, column: str, minimum: float) -> int:
    valid = min_value_gate(df, column, minimum).first()["valid_rows"]
    if valid == 0:
        raise ValueError(f"no row has {column} >= {minimum}")
    return valid


def write_reports(reports: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> list[str]:
    """One table per report under ``folder``; array columns are joined to text for CSV."""
    paths = []
    for name, report in reports.items():
        if fmt == "csv":
            report = report.select(*(
                F.concat_ws("|", f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType)
                else F.col(f"`{f.name}`") for f in report.schema.fields))
        path = f"{folder}/{name}"
        # the CSV writer trims text unless told otherwise
        report.write.mode("overwrite").format(fmt).options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).save(path)
        paths.append(path)
    return paths


def hand_off(df: DataFrame, path: str) -> DataFrame:
    """Write a stage's table and continue from the written copy."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("stage", T.StringType()),
    T.StructField("metric", T.StringType()), T.StructField("value", T.DoubleType())])


def log_run(path: str, run_id: str, stage: str, metrics: DataFrame) -> None:
    """Append a one-row metrics table to the run log as (run_id, stage, metric, value)."""
    values = metrics.select(*(F.col(c).cast("double").alias(c) for c in metrics.columns))
    (values.unpivot([], values.columns, "metric", "value")
           .select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), "metric", "value")
           .write.mode("append").parquet(path))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)
