"""First-look operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import dated, raw, rounded, tickets, typed_stage
from fixtures.sql import COLUMNS, query, r
from pricewright.operators import profile

_TYPES = {"Date": "timestamp_ntz", "Duration_hrs": "double", "Base_Fare": "double", "Tax_Surcharge": "double",
          "Total_Fare": "double", "Days_Before_Departure": "double"}
_NUMERIC = ("Duration_hrs", "Base_Fare", "Tax_Surcharge", "Total_Fare", "Days_Before_Departure")


def sample_rows(spark, sf):
    return dated(profile.sample_rows(tickets(spark, sf).select(*COLUMNS), 5))


QUERIES = {
    "profile_shape": lambda s, d: profile.profile_shape(raw(s, d)),
    "profile_columns": lambda s, d: profile.profile_columns(typed_stage(s, d)),
    "sample_rows": sample_rows,
    "describe_numeric": lambda s, d: rounded(profile.describe_numeric(typed_stage(s, d))),
    "duplicate_count": lambda s, d: profile.duplicate_count(raw(s, d)),
    "null_columns": lambda s, d: profile.null_columns(typed_stage(s, d)),
    "fare_range": lambda s, d: profile.value_range(raw(s, d), "Base Fare (BDT)", "Base_Fare"),
}


def _each(columns, select: str) -> str:
    return " UNION ALL ".join(select.format(c=c, i=i, t=_TYPES.get(c, "string")) for i, c in enumerate(columns))


def describe_sql(cells: str, by: str = '"column"', digits: int = 4) -> str:
    return f"""SELECT {by}, count(v) AS count, {r('avg(v)', digits)} AS mean, {r('stddev_samp(v)', digits)} AS std,
      {r('min(v)', digits)} AS min, {r('quantile_cont(v, 0.25)', digits)} AS p25,
      {r('quantile_cont(v, 0.5)', digits)} AS p50, {r('quantile_cont(v, 0.75)', digits)} AS p75,
      {r('max(v)', digits)} AS max FROM ({cells}) GROUP BY {by}"""


ORACLES = {
    "profile_shape": query("dirty", "SELECT count(*) AS rows, 17 AS columns FROM dirty"),
    "profile_columns": query("typed", _each(COLUMNS, """
      SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype, count(*) - count({c}) AS null_count,
        round_even(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct,
        count(DISTINCT {c}) AS "unique" FROM typed""")),
    "sample_rows": query("fares", "SELECT * REPLACE (strftime(Date, '%Y-%m-%d %H:%M:%S') AS Date) FROM (SELECT "
                         + ", ".join(COLUMNS) + " FROM fares ORDER BY " + ", ".join(COLUMNS) + " LIMIT 5)"),
    "describe_numeric": query("typed", describe_sql(
        _each(_NUMERIC, """SELECT '{c}' AS "column", {c} AS v FROM typed"""))),
    "duplicate_count": query("dirty", "SELECT (SELECT count(*) FROM dirty) - "
                             "(SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicates"),
    "null_columns": query("typed", "SELECT * FROM (" + _each(
        COLUMNS, """SELECT '{c}' AS "column", count(*) - count({c}) AS null_count FROM typed""")
        + ") WHERE null_count > 0"),
    "fare_range": query("typed", "SELECT min(Base_Fare) AS min_value, max(Base_Fare) AS max_value FROM typed"),
}
