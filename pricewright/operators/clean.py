"""Contract checks and row-level repair, in the order a cleaning run applies them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pricewright.functions.numeric import drop_nan, parse_double, percent
from pricewright.operators.profile import describe_numeric, null_counts
from pricewright.sources.tables import presence
from pricewright.staging import read_bytes, slices, staged, staged_pieces
from pricewright.spec import DOUBLE, LONG, STRING, TIME, TableSpec


def rename_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumnsRenamed(dict(spec.rename))


def missing_columns(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Contract columns the table lacks."""
    spark = df.sparkSession
    contract = spark.createDataFrame([(c, d) for c, (_, d) in spec.contract.items()],
                                     "column string, description string")
    present = spark.createDataFrame([(c,) for c in df.columns], "column string")
    return contract.join(present, "column", "left_anti")


def contract_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Every contract column: described, present or not, and the rows that have a value."""
    described = df.sparkSession.createDataFrame([(c, d) for c, (_, d) in spec.contract.items()],
                                                "column string, description string")
    return presence(df, list(spec.contract)).join(described, "column")


def validate_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Pass the table through, or raise naming what is missing."""
    missing = sorted(set(spec.contract) - set(df.columns))
    if missing:
        listed = ", ".join(f"{c} ({spec.contract[c][1]})" for c in missing)
        raise ValueError(f"{len(missing)} required column(s) missing: {listed}")
    return df


def _type_name(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _time(text: Column, layouts: tuple[str, ...]) -> Column:
    """ISO first, then the spec's layouts in order; the first that fits wins."""
    return F.coalesce(text.try_cast(TIME), *(F.try_to_timestamp(text, F.lit(x)).cast(TIME) for x in layouts))


def _coerced(column: Column, actual: T.DataType, expected: str, layouts: tuple[str, ...] = ()) -> Column:
    text = isinstance(actual, T.StringType)
    if actual.simpleString() == expected:
        return drop_nan(column) if expected == DOUBLE else column
    if expected == TIME:
        return _time(column if text else column.cast("string"), layouts)
    if expected in (DOUBLE, LONG):
        # lead times stay double until imputation: a fraction must not turn into NULL
        return parse_double(column) if text else drop_nan(column.try_cast("double"))
    if expected == STRING:
        return column.cast("string")
    raise ValueError(f"unsupported contract type {expected}")


def coerce_types(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Give contract columns their types; what does not parse becomes NULL."""
    def typed(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name in spec.contract:
            expected = spec.contract[field.name][0]
            column = _coerced(column, field.dataType, expected, spec.time_layouts)
        return column.alias(field.name)

    return df.select(*(typed(f) for f in df.schema.fields))


def unparsed_times(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Of the event times present in the renamed table, how many have no known layout."""
    given = df.select(F.col(spec.event_time).alias("given"))
    time = _coerced(F.col("given"), given.schema["given"].dataType, TIME, spec.time_layouts)
    return given.agg(F.count("given").alias("given"), F.count_if(F.col("given").isNotNull() & time.isNull()).alias("unparsed"))


def require_times(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows without a time are dropped later; refuse a table that would lose too many of them."""
    row = unparsed_times(df, spec).first()
    if row["unparsed"] > spec.unparsed_share * row["given"]:
        raise ValueError(f"{row['unparsed']} of {row['given']} values of {spec.event_time} have no known layout")
    return df


# Status and action labels of the type report.
_ACTIONS = {TIME: "to_datetime", DOUBLE: "to_numeric", LONG: "to_numeric", STRING: "to_string"}


def dtype_report(before: DataFrame, after: DataFrame, spec: TableSpec) -> DataFrame:
    """Contract against actual types before coercion, with the nulls found after it."""
    rows = []
    for column, (expected, description) in spec.contract.items():
        if column not in before.columns:
            rows.append((column, expected, "MISSING", "SKIP", "column absent", description))
            continue
        ok = _type_name(before, column) == expected
        rows.append((column, expected, _type_name(after, column), "OK" if ok else "FIXED",
                     "none" if ok else _ACTIONS[expected], description))
    contract = before.sparkSession.createDataFrame(
        rows, "column string, expected string, actual string, status string, action string, "
              "description string")
    present = [c for c in spec.contract if c in after.columns]
    nulls = null_counts(after.select(*present)).select("column", F.col("null_count").alias("nulls_after"))
    return contract.join(nulls, "column", "left")


def _bounded(df: DataFrame, spec: TableSpec) -> list[tuple[str, float, float]]:
    return [(c, lo, hi) for c, (lo, hi) in spec.bounds.items() if c in df.columns]


def _outside(column: str, lo: float, hi: float) -> Column:
    """True only for a present value out of range; missing values are not outside."""
    value = F.col(column)
    return F.coalesce((value < lo) | (value > hi), F.lit(False))


def range_filter(df: DataFrame, spec: TableSpec) -> DataFrame:
    for column, lo, hi in _bounded(df, spec):
        df = df.filter(~_outside(column, lo, hi))
    return df


def _with_range_flags(df: DataFrame, spec: TableSpec) -> DataFrame:
    """First bound each row fails (NULL if none): later bounds see only the rows left over."""
    failed = F.coalesce(*(F.when(_outside(c, lo, hi), F.lit(i))
                          for i, (c, lo, hi) in enumerate(_bounded(df, spec))), F.lit(None).cast("int"))
    return df.withColumn("_failed", failed)


def range_report(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per bound: rows below and above, as a share of the rows still there. One aggregate."""
    bounds = _bounded(df, spec)
    if not bounds:
        return df.sparkSession.createDataFrame([], "column string, bound_lo double, bound_hi double, n_below bigint, "
                                                   "n_above bigint, n_removed bigint, pct_removed double")
    flagged = _with_range_flags(df.select(*(c for c, _, _ in bounds)), spec)
    aggregates = []
    for i, (column, lo, hi) in enumerate(bounds):
        here = F.col("_failed") == i
        aggregates += [
            F.count_if(here & (F.col(column) < lo)).alias(f"_below{i}"),
            F.count_if(here & (F.col(column) > hi)).alias(f"_above{i}"),
            F.count_if(F.coalesce(F.col("_failed") >= i, F.lit(True))).alias(f"_rows{i}")]
    removed = [F.col(f"_below{i}") + F.col(f"_above{i}") for i in range(len(bounds))]
    return flagged.agg(*aggregates).select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.lit(float(lo)).alias("bound_lo"),
                 F.lit(float(hi)).alias("bound_hi"), F.col(f"_below{i}").alias("n_below"),
                 F.col(f"_above{i}").alias("n_above"), removed[i].alias("n_removed"),
                 percent(removed[i], F.col(f"_rows{i}"), 3).alias("pct_removed"))
        for i, (c, lo, hi) in enumerate(bounds)))))


def bad_row_stats(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``describe`` of the removed values, per bound that removed any."""
    bounds = _bounded(df, spec)
    flagged = _with_range_flags(df.select(*(c for c, _, _ in bounds)), spec).filter("_failed IS NOT NULL")
    # a removed row counts for the bound it failed, so each column keeps the values its own bound removed
    removed = flagged.select(*(F.when(F.col("_failed") == i, F.col(c).cast("double")).alias(c)
                               for i, (c, _, _) in enumerate(bounds)))
    stats = describe_numeric(removed, [c for c, _, _ in bounds]).where("count > 0")
    return stats.select("column", "count", *(F.bround(c, 2).alias(c) for c in stats.columns[2:]))


def category_audit(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Labels outside the allowed sets, with count and share of all rows. Removes nothing."""
    spark = df.sparkSession
    audited = {c: labels for c, labels in spec.allowed.items()
               if labels is not None and c in df.columns}
    schema = "column string, unexpected_val string, count bigint, pct double, expected_set string"
    if not audited:
        return spark.createDataFrame([], schema)
    allowed = spark.createDataFrame([(c, v) for c, labels in audited.items() for v in labels],
                                    "column string, unexpected_val string")
    expected = spark.createDataFrame([(c, "|".join(labels)) for c, labels in audited.items()],
                                     "column string, expected_set string")
    labels = df.select(*audited).unpivot([], list(audited), "column", "unexpected_val")
    # every column has one cell per row, NULL cells included, so the sum is the row count;
    # the window sees one row per label, after the only scan
    counted = (labels.groupBy("column", "unexpected_val").agg(F.count(F.lit(1)).alias("count"))
               .withColumn("rows", F.sum("count").over(Window.partitionBy("column"))))
    return (counted.filter("unexpected_val IS NOT NULL")
            # both come from the spec
            .join(F.broadcast(allowed), ["column", "unexpected_val"], "left_anti")
            .join(F.broadcast(expected), "column")
            .select("column", "unexpected_val", "count",
                    percent(F.col("count"), F.col("rows"), 2).alias("pct"), "expected_set"))


def normalise_labels(df: DataFrame, spec: TableSpec) -> DataFrame:
    for column, fixes in spec.label_fixes.items():
        if column in df.columns:
            df = df.replace(dict(fixes), subset=[column])
    return df


def relabelled_counts(df: DataFrame, spec: TableSpec) -> DataFrame:
    """How many cells each label fix changes."""
    fixes = [(c, old, new) for c, m in spec.label_fixes.items() if c in df.columns
             for old, new in m.items()]
    if not fixes:
        return df.sparkSession.createDataFrame(
            [], "column string, old_label string, new_label string, n_changed bigint")
    counted = df.agg(*(F.count_if(F.col(c) == old).alias(f"_{i}")
                       for i, (c, old, _) in enumerate(fixes)))
    return counted.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("column"), F.lit(old).alias("old_label"), F.lit(new).alias("new_label"),
                 F.col(f"_{i}").alias("n_changed")) for i, (c, old, new) in enumerate(fixes)))))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row distinct. Copies fold in the map-side aggregate, so a hot row is one row per task."""
    return df.dropDuplicates()


def distinct_pieces(df: DataFrame, distinct: Callable[[DataFrame], DataFrame] = drop_duplicates) -> Iterator[DataFrame]:
    """The whole-row distinct of a table in frames to be written one after the other.

    Equal rows are in the same slice. Texts decide which, as they need no parsing: other cells are then only typed in
    their own slice. A table without texts goes by all its cells.
    """
    n = slices(read_bytes(df))
    if n == 1:
        yield distinct(df)
        return
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    place = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in texts or df.columns)), F.lit(n))
    for i in range(n):
        yield distinct(df.where(place == i))


_DIGEST = ("__digest_a", "__digest_b")


def _digested(df: DataFrame) -> DataFrame:
    """The rows with 128 bits over all cells; which cells are NULL counts too, as the hash passes over them."""
    cells = [F.col(f"`{c}`") for c in df.columns]
    nulls = [c.isNull() for c in cells]
    return df.withColumns({name: F.xxhash64(F.lit(i), *cells, *nulls) for i, name in enumerate(_DIGEST)})


def _repeated(rows: DataFrame) -> DataFrame:
    """Digests that stand in several rows, written so that their size decides how they are joined."""
    return staged(rows.groupBy(*_DIGEST).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*_DIGEST), "repeated")


def drop_duplicates_by_digest(df: DataFrame) -> DataFrame:
    """Whole-row distinct for wide tables of mostly different rows that are cheap to read again.

    Sixteen bytes a row are shuffled to find digests that repeat; only rows with such a digest move, and
    are told apart by value. All others stay where they are. Of a large table nearly all rows may move: it is
    taken in slices, each written before the next.
    """
    if slices(read_bytes(df)) == 1:
        return distinct_by_digest(df)
    return staged_pieces(distinct_pieces(df, distinct_by_digest), "unique", df)


def distinct_by_digest(df: DataFrame) -> DataFrame:
    """``drop_duplicates_by_digest`` of one slice."""
    rows = _digested(df)
    repeated = _repeated(rows)
    alone = rows.join(repeated, list(_DIGEST), "left_anti").drop(*_DIGEST)
    return alone.unionByName(rows.join(repeated, list(_DIGEST), "left_semi").drop(*_DIGEST).dropDuplicates())


def duplicate_count_by_digest(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier row; cells of rows whose digest does not repeat are not shuffled."""
    rows = _digested(df)
    suspects = rows.join(_repeated(rows), list(_DIGEST), "left_semi").drop(*_DIGEST)
    copies = suspects.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def min_base_filter(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop rows priced under the minimum and recompute the total.

    Runs after imputation, when no price is missing; a missing one does not pass.
    """
    return recompute_total(df.filter(F.col(spec.base) >= spec.min_base), spec)


def recompute_total(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn(spec.target, F.col(spec.base) + F.col(spec.surcharge))


def total_summary(df: DataFrame, spec: TableSpec) -> DataFrame:
    total = F.col(spec.target)
    return df.agg(F.min(total).alias("min_total"), F.max(total).alias("max_total"),
                  F.avg(total).alias("mean_total"))
