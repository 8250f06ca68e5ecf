"""Cleaning, validation and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SPEC, dated, in_range, raw, rounded, tickets, typed, typed_stage, unique
from catalog.profiling import _TYPES, _each, describe_sql
from catalog.sources import _AUDIT, _DATED
from fixtures.sql import COLUMNS, filled_columns, mode_of, query, r
from pricewright.operators import clean, impute
from pricewright.plans.clean_plan import clean_pipeline
from pricewright.sources.tables import null_tokens


def dtype_report(spark, sf):
    before = clean.rename_columns(raw(spark, sf), SPEC)
    return clean.dtype_report(before, typed_stage(spark, sf), SPEC)


def validate_schema(spark, sf):
    partial = tickets(spark, sf).drop("Season", "Booking_Source")
    return clean.contract_report(partial, SPEC)


def normalise_labels(spark, sf):
    frame = in_range(spark, sf)
    return (clean.normalise_labels(frame, SPEC).groupBy("Class").agg(F.count(F.lit(1)).alias("rows"))
            .join(clean.relabelled_counts(frame, SPEC).select(F.col("new_label").alias("Class"), "n_changed"),
                  "Class", "left").fillna(0, ["n_changed"]))


def impute_mean(spark, sf):
    filled = impute.impute_mean(unique(spark, sf).select("Season", "Duration_hrs", "Tax_Surcharge"),
                                "Duration_hrs", "Tax_Surcharge")
    return filled.groupBy("Season").agg(
        F.count("Tax_Surcharge").alias("n"), F.avg("Tax_Surcharge").alias("mean_tax"),
        F.avg("Duration_hrs").alias("mean_duration"), F.max("Tax_Surcharge").alias("max_tax"))


def assert_no_nulls(spark, sf):
    return impute.remaining_nulls(impute.impute_config(unique(spark, sf), SPEC))


def clean_run(spark, sf):
    return dated(clean_pipeline(null_tokens(raw(spark, sf)), SPEC))


def min_fare_filter(spark, sf):
    return dated(clean.min_base_filter(typed_stage(spark, sf), SPEC))


QUERIES = {
    "rename_columns": lambda s, d: clean.rename_columns(raw(s, d), SPEC).groupBy("Stop_Raw", "Season")
        .agg(F.count(F.lit(1)).alias("rows")),
    "validate_schema": validate_schema,
    "coerce_types": lambda s, d: dated(typed(s, d)),
    "dtype_report": dtype_report,
    "range_filter": lambda s, d: dated(in_range(s, d)),
    "range_report": lambda s, d: clean.range_report(typed_stage(s, d), SPEC),
    "bad_row_stats": lambda s, d: clean.bad_row_stats(typed_stage(s, d), SPEC),
    "category_audit": lambda s, d: clean.category_audit(in_range(s, d), SPEC),
    "normalise_labels": normalise_labels,
    "drop_duplicates": lambda s, d: dated(clean.drop_duplicates(
        clean.normalise_labels(in_range(s, d), SPEC))),
    "drop_duplicates_digest": lambda s, d: dated(clean.drop_duplicates_by_digest(
        clean.normalise_labels(in_range(s, d), SPEC))),
    "missing_audit": lambda s, d: impute.missing_audit(unique(s, d), SPEC),
    "impute_median": lambda s, d: impute.impute_median(
        unique(s, d).select("Tax_Surcharge", "Duration_hrs", "Base_Fare"), "Tax_Surcharge", "Duration_hrs"),
    "impute_mean": lambda s, d: rounded(impute_mean(s, d)),
    "impute_mode": lambda s, d: impute.impute_mode(
        unique(s, d).select("Airline", "Source_Name", "Season"), "Airline", "Source_Name"),
    "impute_literal": lambda s, d: impute.impute_literal(
        unique(s, d).select("Aircraft_Type", "Total_Fare"), "Aircraft_Type", "Unknown"),
    "impute_drop": lambda s, d: dated(impute.impute_drop(unique(s, d).select("Date", "Total_Fare"), "Date")),
    "impute_fallback": lambda s, d: impute.impute_fallback(
        unique(s, d).select("Source_Name", "Tax_Surcharge", "Season")),
    "impute_config": lambda s, d: dated(impute.impute_config(unique(s, d), SPEC)),
    "recompute_total": lambda s, d: clean.recompute_total(
        unique(s, d).select("Base_Fare", "Tax_Surcharge", "Total_Fare"), SPEC),
    "assert_no_nulls": assert_no_nulls,
    "total_summary": lambda s, d: rounded(clean.total_summary(
        clean.min_base_filter(typed_stage(s, d), SPEC), SPEC)),
    "min_fare_filter": min_fare_filter,
    "clean_pipeline": clean_run,
}


def _range_report() -> str:
    parts, before = [], "TRUE"
    for c, (lo, hi) in SPEC.bounds.items():
        below, above = f"count(*) FILTER ({before} AND {c} < {lo})", f"count(*) FILTER ({before} AND {c} > {hi})"
        parts.append(f"""SELECT '{c}' AS "column", CAST({lo} AS DOUBLE) AS bound_lo, CAST({hi} AS DOUBLE) AS bound_hi,
          {below} AS n_below, {above} AS n_above, {below} + {above} AS n_removed,
          round_even(100.0 * ({below} + {above}) / count(*) FILTER ({before}), 3) AS pct_removed FROM typed""")
        before += f" AND ({c} IS NULL OR ({c} >= {lo} AND {c} <= {hi}))"
    return " UNION ALL ".join(parts)


def _bad_rows() -> str:
    parts, before = [], "TRUE"
    for c, (lo, hi) in SPEC.bounds.items():
        parts.append(f"""SELECT '{c}' AS "column", {c} AS v FROM typed
                         WHERE {before} AND ({c} < {lo} OR {c} > {hi})""")
        before += f" AND ({c} IS NULL OR ({c} >= {lo} AND {c} <= {hi}))"
    return " UNION ALL ".join(parts)


def _dtype_report() -> str:
    action = {"timestamp_ntz": "to_datetime", "double": "to_numeric", "bigint": "to_numeric"}
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS expected, '{_TYPES.get(c, 'string')}' AS actual,
        '{'OK' if t == 'string' else 'FIXED'}' AS status, '{action.get(t, 'none')}' AS action,
        '{text}' AS description, count(*) - count({c}) AS nulls_after FROM typed"""
        for c, (t, text) in SPEC.contract.items())


_FILL = filled_columns("uniq")
_CLEAN_COLUMNS = _DATED

ORACLES = {
    "rename_columns": query("dirty", "SELECT Stop_Raw, Season, count(*) AS rows FROM dirty GROUP BY ALL"),
    "validate_schema": query("fares", " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{text}' AS description, {c not in ('Season', 'Booking_Source')} AS present,
        {'count(NULL)' if c in ('Season', 'Booking_Source') else f'count({c})'} AS rows FROM fares"""
        for c, (_, text) in SPEC.contract.items())),
    "coerce_types": query("typed", f"SELECT {_DATED} FROM typed"),
    "dtype_report": query("typed", _dtype_report()),
    "range_filter": query("in_range", f"SELECT {_DATED} FROM in_range"),
    "range_report": query("typed", _range_report()),
    "bad_row_stats": query("typed", describe_sql(_bad_rows(), digits=2)),
    "category_audit": query("in_range", _AUDIT),
    "normalise_labels": query("in_range", """
      SELECT CASE Class WHEN 'First Class' THEN 'First' ELSE Class END AS Class, count(*) AS rows,
        count(*) FILTER (Class = 'First Class') AS n_changed FROM in_range GROUP BY 1"""),
    "drop_duplicates": query("uniq", f"SELECT {_DATED} FROM uniq"),
    "drop_duplicates_digest": query("uniq", f"SELECT {_DATED} FROM uniq"),
    "missing_audit": query("uniq", " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{_TYPES.get(c, 'string')}' AS dtype, count(*) - count({c}) AS null_count,
        round_even(100.0 * (count(*) - count({c})) / count(*), 3) AS null_pct,
        '{SPEC.imputation.get(c, 'none')}' AS strategy, {c in SPEC.model_columns} AS is_feature FROM uniq"""
        for c in COLUMNS)),
    "impute_median": query("uniq", f"SELECT {_FILL['Tax_Surcharge']} AS Tax_Surcharge, "
                           f"{_FILL['Duration_hrs']} AS Duration_hrs, Base_Fare FROM uniq"),
    "impute_mean": query("uniq", f"""
      SELECT Season, count(*) AS n,
        {r('avg(coalesce(Tax_Surcharge, (SELECT avg(Tax_Surcharge) FROM uniq)))')} AS mean_tax,
        {r('avg(coalesce(Duration_hrs, (SELECT avg(Duration_hrs) FROM uniq)))')} AS mean_duration,
        {r('max(Tax_Surcharge)')} AS max_tax FROM uniq GROUP BY Season"""),
    "impute_mode": query("uniq", f"""SELECT {_FILL['Airline']} AS Airline,
      coalesce(Source_Name, {mode_of('Source_Name', 'uniq')}) AS Source_Name, Season FROM uniq"""),
    "impute_literal": query("uniq", "SELECT coalesce(Aircraft_Type, 'Unknown') AS Aircraft_Type, Total_Fare FROM uniq"),
    "impute_drop": query("uniq", "SELECT strftime(Date, '%Y-%m-%d %H:%M:%S') AS Date, Total_Fare FROM uniq "
                         "WHERE Date IS NOT NULL"),
    "impute_fallback": query("uniq", f"""
      SELECT coalesce(Source_Name, {mode_of('Source_Name', 'uniq')}) AS Source_Name,
        {_FILL['Tax_Surcharge']} AS Tax_Surcharge, Season FROM uniq"""),
    "impute_config": query("clean", f"SELECT {_CLEAN_COLUMNS} FROM clean"),
    "recompute_total": query("uniq", "SELECT Base_Fare, Tax_Surcharge, Base_Fare + Tax_Surcharge AS Total_Fare FROM uniq"),
    "assert_no_nulls": query("clean", " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count FROM clean""" for c in COLUMNS)),
    "total_summary": query("typed", f"""
      SELECT {r('min(Base_Fare + Tax_Surcharge)')} AS min_total, {r('max(Base_Fare + Tax_Surcharge)')} AS max_total,
        {r('avg(Base_Fare + Tax_Surcharge)')} AS mean_total FROM typed WHERE Base_Fare >= 500"""),
    "min_fare_filter": query("typed", "SELECT * REPLACE (strftime(Date, '%Y-%m-%d %H:%M:%S') AS Date, "
                             "Base_Fare + Tax_Surcharge AS Total_Fare) FROM typed WHERE Base_Fare >= 500"),
    "clean_pipeline": query("clean", f"SELECT {_CLEAN_COLUMNS} FROM clean"),
}
